"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contract import APE_EPSILON


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_missing_text(col: str | Column) -> Column:
    """NULL, blank after trim, or the word ``null`` in any case."""
    s = F.trim(_c(col).cast("string"))
    return _c(col).isNull() | (s == "") | (F.lower(s) == "null")


def clip_at_zero(col: str | Column) -> Column:
    """greatest(x, 0). NULL stays NULL (unlike a bare ``greatest``)."""
    x = _c(col).cast("double")
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))


def round3(col: str | Column) -> Column:
    """round to 3 places, half away from zero on the printed decimal (no negative zero)."""
    return round_half_up(col, 3)


def first_present(json_col: str | Column, fields: Sequence[str], cast: str | None = None) -> Column:
    """first non-NULL of alternative JSON field names, optionally try-cast."""
    parts = [F.get_json_object(_c(json_col), f"$.{f}") for f in fields]
    val = F.coalesce(*parts)
    return val.try_cast(cast) if cast else val


def nan_to_null(col: str | Column) -> Column:
    """NaN -> NULL so JSON carries a real null."""
    x = _c(col)
    return F.when(~F.isnan(x), x)


def abs_pct_error(label: str | Column, pred: str | Column, eps: float = APE_EPSILON) -> Column:
    """|y - p| / (y + eps)."""
    y, p = _c(label).cast("double"), _c(pred).cast("double")
    return F.abs(y - p) / (y + F.lit(eps))


def squared_log_error(label: str | Column, pred: str | Column, clip: bool = True) -> Column:
    """(log1p(p) - log1p(y))^2, both sides clipped at 0 when ``clip``."""
    y, p = _c(label).cast("double"), _c(pred).cast("double")
    if clip:
        y, p = clip_at_zero(y), clip_at_zero(p)
    return F.pow(F.log1p(p) - F.log1p(y), 2)


def sign_class(col: str | Column) -> Column:
    """below zero = shortfall, else excess (NULL stays NULL)."""
    x = _c(col)
    return F.when(x < 0, F.lit("shortfall")).when(x.isNotNull(), F.lit("excess"))


def row_json(*cols: str | Column, keep_nulls: bool = True) -> Column:
    """the row as JSON; NULL fields kept as explicit ``null`` by default."""
    struct = F.struct(*cols) if cols else F.struct("*")
    return F.to_json(struct, {"ignoreNullFields": "false"} if keep_nulls else {})


def round_half_up(col: str | Column, places: int) -> Column:
    """Round the decimal value a number prints as, half away from zero (via DECIMAL).

    Plain ``round`` on a double may land either side of an exact decimal tie
    (x.xx5) depending on its binary value; going through DECIMAL rounds what
    the number shows, the same way in every engine.
    """
    # the first cast (places + 3 digits) absorbs binary noise, the round is half-up
    return F.round(_c(col).cast(f"decimal(38,{places + 3})"), places).cast("double")
