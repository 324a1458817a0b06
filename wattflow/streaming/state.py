"""Custom stream state (W4/W5/A26 stream form).

The dashboard kept, per building, the newest N values in a bounded deque and
plotted them against an arrival index. As a Structured Streaming operator the
rows of a key are dealt over SALTS parts by a hash of their order columns, and the
(key, salt) pairs over BUCKETS states by a hash of the pair. A state holds the row
count and the newest N rows of each of its pairs as one Arrow table, so Python is
called once a bucket and batch, however many keys there are, and merges all pairs of
the bucket at once; every micro-batch emits the pairs it touched. The newest N rows
of the key are among the newest N of its pairs: ``merge_last_n`` reads them back
together. A key with any share of the rows spreads over the state partitions, and it
holds at most salts * N rows; a state grows with the number of keys in its bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.windows import top_n_per_key

SALTS = 16
BUCKETS = 1024  # more than the state partitions; raise it with them, before the first start


def last_n_states(
    stream: DataFrame, key: str, value_col: str, order_cols: Sequence[str], n: int, salts: int = SALTS, buckets: int = BUCKETS
) -> DataFrame:
    """Update-mode rows ``(key, salt, n_seen, order columns..., value)`` of each touched pair, the kept rows as arrays.

    The kept rows are the newest ``n`` by ``order_cols`` over all rows of the pair so
    far: they are merged with each Arrow chunk of the bucket, so neither the chunks' nor
    the batches' order matters and a task holds one chunk and one bucket's kept rows at
    a time. Rows without a key have buckets of their own.
    """
    order = list(order_cols)
    fields = [*order, *([value_col] if value_col not in order else [])]
    kinds = {c: stream.schema[c].dataType.simpleString() for c in [key, *fields]} | ({} if value_col in order else {value_col: "double"})
    own = [c for c in fields if c != key]
    out_schema = f"`{key}` {kinds[key]}, salt int, n_seen long, " + ", ".join(f"`{c}` array<{kinds[c]}>" for c in fields)

    def update(_, batches, state):
        import pyarrow as pa

        pair = [key, "salt"]
        kept = pa.ipc.open_stream(state.get[0]).read_pandas().assign(_new=0, _hit=0) if state.exists else None
        for pdf in batches:
            new = pdf[[*pair, *own]].astype({value_col: "float64"} if value_col not in order else {}).assign(_seen=0, _new=1, _hit=1)
            both = new if kept is None else pd.concat([kept, new], ignore_index=True)
            both = both.sort_values(order, kind="mergesort", ignore_index=True)
            pairs = both.groupby(pair, dropna=False, sort=False)
            both["_seen"] = pairs["_seen"].transform("max") + pairs["_new"].transform("sum")
            both["_hit"] = pairs["_hit"].transform("max")
            kept = pairs.tail(n).assign(_new=0)
        table = pa.Table.from_pandas(kept.drop(columns=["_new", "_hit"]), preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        state.update((sink.getvalue().to_pybytes(),))
        touched = kept[kept["_hit"] == 1]
        touched = touched.assign(_at=touched.groupby(pair, dropna=False, sort=False).ngroup()).sort_values("_at", kind="mergesort")
        ends = touched["_at"].value_counts(sort=False).sort_index().cumsum().tolist()
        spans = list(zip([0, *ends[:-1]], ends, strict=True))
        first = touched.iloc[[lo for lo, _ in spans]]
        lists = {c: touched[c].tolist() for c in fields}
        yield pd.DataFrame(
            {key: first[key].to_numpy(), "salt": first["salt"].to_numpy(), "n_seen": first["_seen"].to_numpy(), **{c: [v[lo:hi] for lo, hi in spans] for c, v in lists.items()}}
        )

    salt = F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int")
    rows = stream.select(key, salt.alias("salt"), *own)
    bucket = F.pmod(F.xxhash64(key, "salt"), F.lit(buckets)).cast("int")
    dealt = rows.withColumn("_bucket", F.when(F.col(key).isNull(), -1 - F.col("salt")).otherwise(bucket))
    return dealt.groupBy("_bucket").applyInPandasWithState(update, out_schema, "kept binary", "update", GroupStateTimeout.NoTimeout)


def merge_last_n(written: DataFrame, key: str, value_col: str, order_cols: Sequence[str], n: int) -> DataFrame:
    """``(key, n_seen, kept_count, kept_total)`` from the written states of ``last_n_states``: the last emission of each
    (key, salt), then the newest ``n`` of each key among them."""
    fields = [*order_cols, *([value_col] if value_col not in order_cols else [])]
    last = written.groupBy(key, "salt").agg(F.max_by(F.struct("n_seen", *fields), "n_seen").alias("r")).select(key, "r.*")
    seen = last.groupBy(key).agg(F.sum("n_seen").alias("n_seen"))
    rows = last.select(key, F.explode(F.arrays_zip(*fields)).alias("x")).select(key, *[F.col(f"x.{c}").alias(c) for c in fields])
    kept = top_n_per_key(rows, [key], [F.desc(c) for c in order_cols], n)
    totals = kept.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("kept_count"), F.sum(value_col).alias("kept_total"))
    return seen.join(totals, key)
