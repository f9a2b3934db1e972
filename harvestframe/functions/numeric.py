"""Null-safe scalar helpers that keep pandas' missing-value semantics (rules N1-N16).

All are plain Column expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div(a, b) -> Column:
    """a / b with NULL for a zero or NULL divisor (ANSI division would raise)."""
    return F.try_divide(col(a), col(b))


def nullif0(c) -> Column:
    """pandas ``.replace(0, nan)``."""
    return F.nullif(col(c), F.lit(0.0))


def ln_pos(c) -> Column:
    """Natural log, NULL for x <= 0 or NULL (numpy gives NaN/-inf there)."""
    c = col(c)
    return F.when(c > 0, F.ln(c))


def clip_lower(c, lo: float = 0.0) -> Column:
    """pandas ``clip(lower=lo)``: NULL stays NULL (``greatest`` would turn it into lo)."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(lo)))


def clip_upper(c, hi: float = 0.0) -> Column:
    c = col(c)
    return F.when(c.isNotNull(), F.least(c, F.lit(hi)))


def flag(cond: Column) -> Column:
    """pandas ``(a > b).astype(int)``: a NULL comparison is 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


# The rounding grid is shifted by this fraction of a unit so that values with few
# decimals (sums and means of 2-decimal prices) never sit on a half-way point.
GRID_SHIFT = 0.3183098861837907


def sround(c, digits: int = 8, max_decimals: int = 6) -> Column:
    """Round to ``digits`` significant digits but at most ``max_decimals`` decimals.

    Used only on the outputs compared against the SQL oracle; the arithmetic
    is mirrored exactly by ``checks.sql.sround`` so both engines give the same double.
    """
    c = col(c)
    e = F.floor(F.log10(F.abs(c)))
    d = F.least(F.lit(max_decimals).cast("bigint"), F.lit(digits - 1) - e)
    phi = F.lit(GRID_SHIFT)
    up, dn = F.pow(F.lit(10.0), d.cast("double")), F.pow(F.lit(10.0), (-d).cast("double"))
    pos = (F.round(c * up + phi, 0) - phi) / up
    neg = (F.round(c / dn + phi, 0) - phi) * dn
    return (F.when(c.isNull(), F.lit(None).cast("double"))
            .when(c == 0, F.lit(0.0))
            .when(d >= 0, pos)
            .otherwise(neg))


TWO_PI = 2.0 * math.pi
SQRT_252 = math.sqrt(252.0)
