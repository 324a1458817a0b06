"""Running values in key order by a segmented prefix scan (W5, W6, ST9).

One range shuffle puts the rows in the order (keys, order); a partition is a *cell*,
and a key with any share of the rows spreads over as many cells as it fills. Each cell
is scanned on its own in Arrow batches (running count, running sums, value of the row
before), its first and last rows are marked, and the scanned rows are written once.
Only the marked rows, two for each cell, are read for the second half: the totals of
earlier cells that end in the key a cell begins with are that cell's carry. The carry
is one row a cell and reaches the rows of a cell's first key alone.

The rows are written, not checkpointed or recomputed: a second run of the range
exchange would sample other bounds and disagree with the carries.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import hand_off
from .ranks import range_partitions


def _equal(a, b) -> bool:
    return a == b or (a != a and b != b)  # a NaN key is one key


class _Cell:
    """The scan of one cell: what the rows so far carry into the next batch."""

    def __init__(self, keys: Sequence[str], sums: Sequence[str], previous: Sequence[str]):
        self.keys, self.sums, self.previous = list(keys), list(sums), list(previous)
        self.last, self.edge = None, True
        self.n = 0
        self.total = dict.fromkeys(sums, 0.0)
        self.valid = dict.fromkeys(sums, 0)
        self.before: dict[str, pa.Array] = {}

    def scan(self, batch: pa.RecordBatch) -> dict[str, pa.Array]:
        n = batch.num_rows
        at = np.arange(n)
        change = np.zeros(n, dtype=bool)
        for k in self.keys:
            code = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            change[1:] |= code[1:] != code[:-1]
        first = tuple(batch.column(k)[0].as_py() for k in self.keys)
        begun = self.last is not None
        change[0] = not begun or not all(map(_equal, first, self.last))
        run = np.cumsum(change)  # 0: the run that the last batch ended in
        start = np.maximum.accumulate(np.where(change, at, -1))
        place = np.where(start >= 0, at - start, self.n + at)
        out = {"_pos": pa.array(place)}
        # the cell's first run goes on until the first change after its first row
        edge = run == (0 if begun else 1) if self.edge else np.zeros(n, dtype=bool)
        out["_edge"] = pa.array(edge)
        self.edge = bool(edge[-1])
        for c in self.sums:
            column = batch.column(c)
            valid = column.is_valid().to_numpy(zero_copy_only=False)
            value = pd.Series(pc.fill_null(column, 0).to_numpy(zero_copy_only=False).astype(np.float64))
            total = value.groupby(run).cumsum().to_numpy() + np.where(run == 0, self.total[c], 0.0)
            count = pd.Series(valid.astype(np.int64)).groupby(run).cumsum().to_numpy() + np.where(run == 0, self.valid[c], 0)
            out[f"_sum_{c}"], out[f"_cnt_{c}"] = pa.array(total), pa.array(count)
            self.total[c], self.valid[c] = float(total[-1]), int(count[-1])
        for c in self.previous:
            column = batch.column(c)
            ahead = self.before.get(c, pa.nulls(1, column.type))
            shifted = pa.concat_arrays([ahead, column.slice(0, n - 1)])
            out[f"_prev_{c}"] = pc.if_else(pa.array(change), pa.scalar(None, column.type), shifted)
            self.before[c] = column.slice(n - 1, 1)
        self.last, self.n = tuple(batch.column(k)[n - 1].as_py() for k in self.keys), int(place[-1]) + 1
        return out


def _scan_cells(names: Sequence[str], keys: Sequence[str], sums: Sequence[str], previous: Sequence[str]):
    extra = ["_pos", "_edge", *(f"_{x}_{c}" for c in sums for x in ("sum", "cnt")), *(f"_prev_{c}" for c in previous)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, part = _Cell(keys, sums, previous), TaskContext.get().partitionId()
        held = None  # one batch back: the last row of the cell is known only at its end

        def ready(batch: pa.RecordBatch, new: dict[str, pa.Array], is_first: bool, is_last: bool) -> pa.RecordBatch:
            n = batch.num_rows
            first, last = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
            first[0], last[-1] = is_first, is_last
            arrays = [*(batch.column(c) for c in names), *(new[c] for c in extra), pa.array(np.full(n, part, np.int32)), pa.array(first), pa.array(last)]
            return pa.RecordBatch.from_arrays(arrays, [*names, *extra, "_cell", "_first", "_last"])

        fresh = True
        for batch in batches:
            if batch.num_rows:
                if held is not None:
                    yield ready(*held, fresh, False)
                    fresh = False
                held = (batch, cell.scan(batch))
        if held is not None:
            yield ready(*held, fresh, True)

    return run


def scan_in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    sums: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    position: str = "_position",
    parts: int | None = None,
) -> DataFrame:
    """``df`` with running values of each row's key in ``order`` (a total order).

    ``sums``: output name -> numeric column, the sum up to and with the row (NULLs add
    nothing; NULL before the first value). ``previous``: output name -> column, its
    value in the row before (NULL in a key's first row). ``position``: 0-based place
    of the row in its key. NULL keys are one key. An empty table gives an empty result.
    """
    sums, previous = dict(sums or {}), dict(previous or {})
    summed, shifted = sorted(set(sums.values())), sorted(set(previous.values()))
    names = df.columns
    fields = [*df.schema.fields, T.StructField("_pos", T.LongType()), T.StructField("_edge", T.BooleanType())]
    fields += [T.StructField(f"_{x}_{c}", k) for c in summed for x, k in (("sum", T.DoubleType()), ("cnt", T.LongType()))]
    fields += [T.StructField(f"_prev_{c}", df.schema[c].dataType) for c in shifted]
    fields += [T.StructField("_cell", T.IntegerType()), T.StructField("_first", T.BooleanType()), T.StructField("_last", T.BooleanType())]
    ranged = df.repartitionByRange(range_partitions(df, parts), *keys, *order).sortWithinPartitions(*keys, *order)
    scanned = hand_off(ranged.mapInArrow(_scan_cells(names, keys, summed, shifted), T.StructType(fields)), "scanned-cells")

    held = {f"_c_{x}_{c}": F.col(f"_{x}_{c}") for c in summed for x in ("sum", "cnt")}
    values = F.struct(F.lit(True).alias("_is"), *[F.col(c).alias(f"_v_{c}") for c in shifted])
    lasts = scanned.where("_last").select("_cell", *keys, F.lit(1).alias("_side"), (F.col("_pos") + 1).alias("_c_n"), *[v.alias(k) for k, v in held.items()], values.alias("_c_prev"))
    nothing = [F.lit(0).cast("long").alias("_c_n"), *[F.lit(0).cast("double" if "_sum_" in k else "long").alias(k) for k in held]]
    firsts = scanned.where("_first").select("_cell", *keys, F.lit(0).alias("_side"), *nothing, F.lit(None).cast(lasts.schema["_c_prev"].dataType).alias("_c_prev"))
    # two rows a cell
    earlier = Window.partitionBy(*keys).orderBy("_cell", "_side").rowsBetween(Window.unboundedPreceding, -1)
    edges = firsts.unionByName(lasts)
    carry = edges.select(
        "_cell", "_side", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("_c_n", *held)], F.last("_c_prev", ignorenulls=True).over(earlier).alias("_c_prev")
    )
    carry = hand_off(carry.where("_side = 0").drop("_side"), "cell-carries")

    joined = scanned.join(carry, "_cell")
    new = {position: F.col("_pos") + F.when(F.col("_edge"), F.col("_c_n")).otherwise(0)}
    for out, c in sums.items():
        total = F.col(f"_sum_{c}") + F.when(F.col("_edge"), F.col(f"_c_sum_{c}")).otherwise(0.0)
        seen = F.col(f"_cnt_{c}") + F.when(F.col("_edge"), F.col(f"_c_cnt_{c}")).otherwise(0)
        new[out] = F.when(seen > 0, total)
    for out, c in previous.items():
        new[out] = F.when(F.col("_edge") & (F.col("_pos") == 0), F.col(f"_c_prev._v_{c}")).otherwise(F.col(f"_prev_{c}"))
    return joined.select(*names, *[v.alias(k) for k, v in new.items()])
