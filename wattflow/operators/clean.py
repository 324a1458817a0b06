"""Projections, filters, sampling, splits and missing-value cleaning."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import CATEGORY_INPUTS, LABEL, NUMERIC_INPUTS, SEED, TRACE, ZERO_IS_VALID
from ..functions.scalar import is_missing_text
from .quantiles import kth_smallest


def model_columns(df: DataFrame, trace: Sequence[str] = TRACE, strict: bool = False) -> DataFrame:
    """The model's inputs, the label and the trace columns, as far as ``df`` has them.

    ``strict`` raises if an input is missing.
    """
    have = set(df.columns)
    absent = [c for c in (*NUMERIC_INPUTS, *CATEGORY_INPUTS) if c not in have]
    if strict and absent:
        raise ValueError(f"missing model inputs: {absent}")
    order = dict.fromkeys([*NUMERIC_INPUTS, *CATEGORY_INPUTS, LABEL, *trace])
    return df.select([c for c in order if c in have])


def align_time(df: DataFrame, src: str, dst: str = "ts") -> DataFrame:
    """Rename the time column so two frames share one join key name."""
    return df.withColumnRenamed(src, dst) if src != dst else df


def drop_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in ``cols`` (all columns when None)."""
    return df.na.drop(subset=list(cols)) if cols else df.na.drop()


def where_not_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Not-null predicates (pushed to the Parquet scan)."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond) if cond is not None else df


def sample_rows(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """P5: seeded Bernoulli sample without replacement (per-partition, no shuffle)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_unit(cols: Sequence[str | Column], seed: int = SEED) -> Column:
    """A value in [0, 1) from the MD5 of the key's text: the same in every engine, order and partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("double") / float(1 << 28)


def unit_sql(cols: Sequence[str], seed: int = SEED) -> str:
    """The SQL twin of :func:`hash_unit`."""
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"(CAST(('0x' || substr(md5(concat_ws('|', '{seed}', {text})), 1, 7)) AS INTEGER) / {float(1 << 28)!r})"


def split_sql(cols: Sequence[str], lo: float, hi: float, seed: int = SEED) -> str:
    """SQL condition of the part [lo, hi) of :func:`hash_split`."""
    u = unit_sql(cols, seed)
    return f"{u} >= {lo!r}" + (f" AND {u} < {hi!r}" if hi < 1 else "")


def hash_sample(df: DataFrame, key_cols: Sequence[str], fraction: float, seed: int = SEED) -> DataFrame:
    """P5 (repeatable): keep rows whose key hash falls below ``fraction``."""
    return df.where(hash_unit(key_cols, seed) < fraction)


def stratified_sample(df: DataFrame, col: str, fractions: Mapping, key_cols: Sequence[str], seed: int = SEED) -> DataFrame:
    """Exactly floor(fraction * rows) rows of each stratum: those of smallest key hash.

    The hash that closes a stratum's quota is selected by radix (``kth_smallest``), so a
    stratum of any size is filtered, not sorted; only rows that tie with it are ordered,
    by their keys. Strata without a fraction give no row. ``df`` is read several times.
    """
    share = F.coalesce(F.create_map(*[F.lit(x) for k, v in fractions.items() for x in (k, float(v))])[F.col(col)], F.lit(0.0))
    marked = df.withColumn("_u", hash_unit(key_cols, seed))
    quota = F.floor(share * F.col("_all"))
    last = kth_smallest(marked.where(F.col(col).isNotNull()), "_u", quota, [col]).select(F.col(col).alias("_s"), F.col("value").alias("_last"), "before")
    near = marked.join(last, (F.col(col) == F.col("_s")) & (F.col("_u") <= F.col("_last")))
    tied = Window.partitionBy(col).orderBy(*key_cols)
    sure = near.where("_u < _last").select(*df.columns)
    rest = near.where("_u = _last").withColumn("_k", F.row_number().over(tied)).where("_k <= before + 1").select(*df.columns)
    return sure.unionByName(rest)


def hash_split(
    df: DataFrame, key_cols: Sequence[str], weights: Sequence[float] = (0.8, 0.2), seed: int = SEED
) -> list[DataFrame]:
    """Split by key hash; the same row always lands in the same part."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        bounds.append((acc / total, (acc + w) / total))
        acc += w
    u = hash_unit(key_cols, seed)
    out = []
    for i, (lo, hi) in enumerate(bounds):
        cond = (u >= lo) & ((u < hi) if i < len(bounds) - 1 else F.lit(True))
        out.append(df.where(cond))
    return out


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop ambiguous columns before a re-join."""
    return df.drop(*cols)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One deterministic survivor per key: the first row in ``order``.

    Implemented as ``min_by`` over a struct of the ordering columns, a partial
    (map-side) aggregate, so a hot key never sorts in one task.
    """
    others = [c for c in df.columns if c not in keys]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ordkey = F.struct(*order_cols) if len(order_cols) > 1 else order_cols[0]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), ordkey).alias("_r"))
    return picked.select(*keys, "_r.*")


def normalise_missing(
    df: DataFrame, columns: Sequence[str], zero_valid: Sequence[str] = ZERO_IS_VALID
) -> DataFrame:
    """P10: NULL, blank, ``null`` (any case) and 0 (outside ``zero_valid``) -> NULL; else double.

    One projection over all columns; text that is not a number becomes NULL
    (``try_cast``) instead of failing under ANSI mode.
    """
    exprs = []
    for c in df.columns:
        if c not in columns:
            exprs.append(F.col(c))
            continue
        num = F.trim(F.col(c).cast("string")).try_cast("double")
        cleaned = F.when(is_missing_text(c), F.lit(None).cast("double"))
        if c not in zero_valid:
            cleaned = cleaned.when(num == 0.0, F.lit(None).cast("double"))
        exprs.append(cleaned.otherwise(num).alias(c))
    return df.select(*exprs)


def cast_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast declared numerics to double once."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def fill_constants(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Fill NULL with constants (casting to double first so 3.9 stays 3.9)."""
    return df.select(
        *[
            F.coalesce(F.col(c).cast("double"), F.lit(float(values[c]))).alias(c) if c in values else F.col(c)
            for c in df.columns
        ]
    )


def fill_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill NULL with each column's mean, all means from one aggregate.

    The one-row aggregate enters as a single struct-valued scalar subquery.
    """
    means = df.agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])).scalar()
    return df.select(
        *[
            F.coalesce(F.col(c).cast("double"), means.getField(c)).alias(c) if c in cols else F.col(c)
            for c in df.columns
        ]
    )


def repartition_for_fit(df: DataFrame, n: int | None = None, *keys: str) -> DataFrame:
    """Explicit repartition before a heavy fit, in even shares.

    ``keys`` put equal keys near each other: rows are dealt by range of (keys, row
    hash), so that a large key fills several partitions instead of one task.
    """
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys, F.xxhash64(*df.columns)) if keys else df.repartition(n)


def add_label(df: DataFrame, src: str = "agg_value", label: str = "label") -> DataFrame:
    """The label column as double."""
    return df.withColumn(label, F.col(src).cast(T.DoubleType()))


def in_set(col: str | Column, values: Iterable) -> Column:
    """Set-membership predicate."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isin(*list(values))
