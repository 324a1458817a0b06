"""Normal tail probabilities as SQL text that Spark and other engines evaluate alike."""

from __future__ import annotations

SERIES_TERMS, FRACTION_TERMS, TURN = 60, 60, 2.5


def two_sided_p_sql(z: str) -> str:
    """SQL for the two-sided normal p-value of the number ``z`` (a column name or expression): erfc(|z| / sqrt(2)).

    Up to TURN, one minus the series exp(-x^2) * sum of x (2x^2)^k / (2k + 1)!! (all terms
    positive); beyond, the continued fraction of erfc, whose value also stands for tails
    that one minus a series would lose. Relative error below 1e-12 down to 1e-300, then
    0. NULL stays NULL.
    """
    x = f"(abs({z}) / sqrt(CAST(2 AS DOUBLE)))"
    y = f"(({z}) * ({z}))"  # 2 x^2
    series = "CAST(1 AS DOUBLE)"
    for k in range(SERIES_TERMS, 0, -1):
        series = f"(1 + {y} / {2 * k + 1} * {series})"
    fraction = "CAST(1 AS DOUBLE)"
    for k in range(FRACTION_TERMS, 0, -1):
        fraction = f"(1 + {k} / {y} / {fraction})"
    bell = f"exp(-{y} / 2)"
    near = f"(1 - 2 / sqrt(pi()) * {bell} * {x} * {series})"
    far = f"({bell} / ({x} * sqrt(pi())) / {fraction})"
    return f"CASE WHEN {x} < {TURN} THEN {near} WHEN {x} >= {TURN} THEN {far} END"
