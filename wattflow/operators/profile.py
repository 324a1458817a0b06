"""Data profiling in one pass over all columns.

Each report is a single aggregate over every column at once, unpivoted with
``stack`` on the one-row result (the reference scanned once per column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import round_half_up
from .quantiles import exact_quantiles, pivot_quantiles


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


def _is_string(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def _unpivot(row: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One-row frame with ``{field}__{col}`` columns -> one row per column."""
    n = len(cols)
    parts = []
    for c in cols:
        parts.append(f"'{c}'")
        parts.extend(f"`{f}__{c}`" for f in fields)
    expr = f"stack({n}, {', '.join(parts)}) AS (`column`, {', '.join('`' + f + '`' for f in fields)})"
    return row.selectExpr(expr)


def nulls_zeros(df: DataFrame) -> DataFrame:
    """Per column, NULL count and zero count (zeros only for numerics, else NULL)."""
    aggs = []
    for c in df.columns:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"nulls__{c}"))
        z = F.count_if(F.col(c) == 0) if _is_numeric(df, c) else F.lit(None).cast("bigint")
        aggs.append(z.alias(f"zeros__{c}"))
    return _unpivot(df.agg(*aggs), df.columns, ["nulls", "zeros"])


def combined_missing(df: DataFrame) -> DataFrame:
    """Per column, NULLs + zeros (zeros only for numerics)."""
    aggs = []
    for c in df.columns:
        z = F.count_if(F.col(c) == 0) if _is_numeric(df, c) else F.lit(0).cast("bigint")
        aggs.append((F.count_if(F.col(c).isNull()) + z).alias(f"missing_total__{c}"))
    return _unpivot(df.agg(*aggs), df.columns, ["missing_total"])


def missing_after(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column, missing and non-missing counts and whether it is fully missing."""
    aggs = []
    for c in cols:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"missing__{c}"))
        aggs.append(F.count(F.col(c)).alias(f"non_null__{c}"))
    out = _unpivot(df.agg(*aggs), cols, ["missing", "non_null"])
    return out.withColumn("fully_missing", F.col("non_null") == 0)


def inspection_table(df: DataFrame, cols: Sequence[str], constant_fill: dict | None = None) -> DataFrame:
    """count/mean/stddev/min/max per column, rounded to 3 places.

    Columns filled with a constant report (n, c, 0, c, c), as in the reference.
    """
    constant_fill = constant_fill or {}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"count__{c}"),
            F.avg(x).alias(f"mean__{c}"),
            F.stddev(x).alias(f"stddev__{c}"),
            F.min(x).alias(f"min__{c}"),
            F.max(x).alias(f"max__{c}"),
        ]
    row = df.agg(*aggs)
    for c, v in constant_fill.items():
        row = (
            row.withColumn(f"count__{c}", F.col("_n"))
            .withColumn(f"mean__{c}", F.lit(float(v)))
            .withColumn(f"stddev__{c}", F.lit(0.0))
            .withColumn(f"min__{c}", F.lit(float(v)))
            .withColumn(f"max__{c}", F.lit(float(v)))
        )
    out = _unpivot(row, cols, ["count", "mean", "stddev", "min", "max"])
    return out.select(
        "column", "count", *[round_half_up(c, 3).alias(c) for c in ("mean", "stddev", "min", "max")]
    )


def numeric_summary(
    df: DataFrame, cols: Sequence[str] | None = None, probs=(0.25, 0.5, 0.75), relative_error: float | None = None
) -> DataFrame:
    """A10: count, mean, stddev, min, max and quartiles per numeric column.

    Exact (default): moments of all columns are one aggregate; quartiles are selected
    by radix over the columns unpivoted to (column, value). ``df`` is read three or
    four times: pass a stored table if it is dear to compute.

    ``relative_error`` set: one aggregate with ``percentile_approx`` sketches
    (map-side partial aggregation, a few KB per task and column; the reference
    used a 1 % error). The cheap path for very large inputs.
    """
    cols = list(cols) if cols else [c for c in df.columns if _is_numeric(df, c)]
    if relative_error is not None:
        return _approx_summary(df, cols, probs, relative_error)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [
            F.count(x).cast("double").alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"), F.stddev(x).alias(f"stddev__{c}"),
            F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}"),
        ]
    # every requested column appears, also one without any value (count 0)
    moments = _unpivot(df.agg(*aggs), cols, ["count", "mean", "stddev", "min", "max"])
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])
        ).alias("_kv")
    ).select("_kv.*")
    names = [f"p{int(round(p * 100))}" for p in probs]
    qs = pivot_quantiles(exact_quantiles(long, "v", probs, ["column"]), probs, ["column"], names)
    return moments.join(qs, "column", "left").select("column", "count", "mean", "stddev", "min", "max", *names)


def _approx_summary(df: DataFrame, cols: Sequence[str], probs, relative_error: float) -> DataFrame:
    accuracy = max(int(round(1.0 / relative_error)), 1)
    names = [f"p{int(round(p * 100))}" for p in probs]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).cast("double").alias(f"count__{c}"),
            F.avg(x).alias(f"mean__{c}"),
            F.stddev(x).alias(f"stddev__{c}"),
            F.min(x).alias(f"min__{c}"),
            F.max(x).alias(f"max__{c}"),
            F.percentile_approx(x, list(probs), accuracy).alias(f"q__{c}"),
        ]
    long = _unpivot(df.agg(*aggs), cols, ["count", "mean", "stddev", "min", "max", "q"])
    return long.select(
        "column", "count", "mean", "stddev", "min", "max", *[F.col("q")[i].alias(n) for i, n in enumerate(names)]
    )


def _top_per_group(counts: DataFrame, group: str, n: int, order) -> DataFrame:
    from .windows import top_n_per_key

    # salted two-stage: a column with very many distinct values never ranks in one task
    return top_n_per_key(counts, [group], order, n, rank_col="rank")


def top_values(df: DataFrame, cols: Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """Top ``n`` values by count for each string column (ties by value).

    Values are counted with a partial aggregate first; the per-column ranking
    is a salted two-stage top-n over the distinct values.
    """
    cols = list(cols) if cols else [c for c in df.columns if _is_string(df, c)]
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])).alias("_kv")
    ).select("_kv.*")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return _top_per_group(counts, "column", n, [F.desc("count"), F.asc_nulls_last("value")])


def boolean_like(df: DataFrame) -> DataFrame:
    """Columns that are boolean, numeric within {0,1} with <= 2 values, or 2-valued strings."""
    cols = [c for c in df.columns if _is_numeric(df, c) or _is_string(df, c) or isinstance(df.schema[c].dataType, T.BooleanType)]
    aggs = []
    for c in cols:
        numeric = _is_numeric(df, c)
        text = F.col(c).cast("string")
        odd = F.count_if(~F.col(c).cast("double").isin(0.0, 1.0)) == 0
        # at most two texts: none but the smallest and the largest
        aggs += [(odd if numeric else F.lit(False)).alias(f"bits__{c}"), F.min(text).alias(f"lo__{c}"), F.max(text).alias(f"hi__{c}")]
    ends = df.agg(*aggs)
    strings = [c for c in cols if _is_string(df, c)]
    if strings:
        edge = ends.select(F.struct(*[F.col(f"{e}__{c}") for c in strings for e in ("lo", "hi")])).scalar()
        marked = df.withColumn("_edge", edge)
        other = [F.count_if((F.col(c) != F.col(f"_edge.lo__{c}")) & (F.col(c) != F.col(f"_edge.hi__{c}"))).alias(f"more__{c}") for c in strings]
        more = marked.agg(*other).select(F.struct("*")).scalar()
    ends = ends.withColumns({f"two__{c}": (more.getField(f"more__{c}") == 0) if c in strings else F.lit(False) for c in cols}) if strings else ends.withColumns(
        {f"two__{c}": F.lit(False) for c in cols}
    )
    long = _unpivot(ends, cols, ["bits", "two"])
    kinds = {c: ("boolean" if isinstance(df.schema[c].dataType, T.BooleanType) else "numeric" if _is_numeric(df, c) else "string") for c in cols}
    kind = F.create_map(*[x for c, k in kinds.items() for x in (F.lit(c), F.lit(k))])[F.col("column")]
    flag = F.when(kind == "boolean", F.lit(True)).when(kind == "numeric", F.col("bits")).otherwise(F.col("two"))
    return long.select("column", kind.alias("kind"), flag.alias("boolean_like"))


def detected_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """The set union of the columns detected in several tables: rows (column, detected_as, tables).

    A column is detected as ``boolean_like`` (A12), ``incomplete`` (it holds NULLs or, as a
    number, zeros: A7) or by its kind (``numeric`` / ``string``, at least one value). Each
    table is profiled by its own aggregates; the union is a distinct over their rows.
    """
    parts = []
    for name, df in tables.items():
        found = [boolean_like(df).where("boolean_like").select("column", F.lit("boolean_like").alias("detected_as"))]
        found.append(combined_missing(df).where("missing_total > 0").select("column", F.lit("incomplete").alias("detected_as")))
        kinds = {c: "numeric" if _is_numeric(df, c) else "string" if _is_string(df, c) else None for c in df.columns}
        cols = [c for c, k in kinds.items() if k]
        kind = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(kinds[c]))])[F.col("column")]
        found.append(missing_after(df, cols).where("non_null > 0").select("column", kind.alias("detected_as")))
        parts += [f.withColumn("table", F.lit(name)) for f in found]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("column", "detected_as").agg(F.array_join(F.array_sort(F.collect_set("table")), ",").alias("tables"))


def value_counts_with_null(df: DataFrame, col: str) -> DataFrame:
    """Value counts, NULL shown as the text ``NULL``."""
    v = F.when(F.col(col).isNull(), F.lit("NULL")).otherwise(F.col(col).cast("string"))
    return df.groupBy(v.alias("value")).agg(F.count(F.lit(1)).alias("count"))
