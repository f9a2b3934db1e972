"""Window primitives W1-W10 over ``partitionBy(keys).orderBy(order)`` with pandas null rules.

Every series window shares one partitioning (the series key) and one sort, so
a chain of ``withColumns`` stages compiles to one shuffle and one sort; frames
differ only inside the WindowExec.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from harvestframe.functions.numeric import col, div

KEY = ("symbol",)
ORDER = "date"


def series(keys: Sequence[str] = KEY, order: str | Sequence[str] = ORDER) -> WindowSpec:
    """``wo``: the ordered series window (no frame); ``order`` is a column or a tuple of columns."""
    return Window.partitionBy(*keys).orderBy(*([order] if isinstance(order, str) else order))


def trailing(n: int, keys: Sequence[str] = KEY, order: str | Sequence[str] = ORDER) -> WindowSpec:
    """``w(n)``: the current row and the n-1 rows before it."""
    return series(keys, order).rowsBetween(-(n - 1), Window.currentRow)


def running(keys: Sequence[str] = KEY, order: str | Sequence[str] = ORDER) -> WindowSpec:
    """``wr``: from the first row of the series to the current row."""
    return series(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole(keys: Sequence[str] = KEY, order: str | Sequence[str] = ORDER) -> WindowSpec:
    return series(keys, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


# W1 / W3
def lag(c, n: int = 1, keys=KEY, order=ORDER) -> Column:
    return F.lag(col(c), n).over(series(keys, order))


def lead(c, n: int = 1, keys=KEY, order=ORDER) -> Column:
    return F.lead(col(c), n).over(series(keys, order))


def diff(c, n: int = 1, keys=KEY, order=ORDER) -> Column:
    return col(c) - lag(c, n, keys, order)


# W2 (two stages: pad, then ratio to the lagged padded value)
def pad(c, keys=KEY, order=ORDER) -> Column:
    """Forward fill (pandas ``ffill``): last non-null value up to the current row."""
    return F.last(col(c), ignorenulls=True).over(running(keys, order))


def pct_change_of_padded(padded, n: int = 1, keys=KEY, order=ORDER) -> Column:
    """pandas ``pct_change(n)`` given the already forward-filled column (rule N7)."""
    return div(col(padded), lag(padded, n, keys, order)) - F.lit(1.0)


# W4 rolling aggregates with pandas min_periods (rule N2)
def _guard(c: Column, frame: WindowSpec, min_periods: int, value: Column) -> Column:
    return F.when(F.count(c).over(frame) >= min_periods, value)


def rolling_mean(c, n: int, min_periods: int | None = None, keys=KEY, order=ORDER) -> Column:
    c, fr = col(c), trailing(n, keys, order)
    return _guard(c, fr, n if min_periods is None else min_periods, F.avg(c).over(fr))


def rolling_sum(c, n: int, min_periods: int | None = None, keys=KEY, order=ORDER) -> Column:
    c, fr = col(c), trailing(n, keys, order)
    return _guard(c, fr, n if min_periods is None else min_periods,
                  F.sum(c.cast("double")).over(fr))


def rolling_std(c, n: int, min_periods: int | None = None, keys=KEY, order=ORDER) -> Column:
    """Sample std (ddof=1, rule N3); one value gives NULL like pandas."""
    c, fr = col(c), trailing(n, keys, order)
    return _guard(c, fr, n if min_periods is None else min_periods, F.stddev_samp(c).over(fr))


# W5
def rolling_corr(x, y, n: int, min_periods: int | None = None, keys=KEY, order=ORDER) -> Column:
    """Pearson correlation over the complete pairs of the frame (rule N12).

    ``corr`` raises on a constant column under ANSI, so it is the covariance
    over the product of the masked standard deviations, NULL when that is 0.
    """
    x, y = col(x), col(y)
    xm = F.when(y.isNotNull(), x)
    ym = F.when(x.isNotNull(), y)
    fr = trailing(n, keys, order)
    value = div(F.covar_samp(xm, ym).over(fr), F.stddev_samp(xm).over(fr) * F.stddev_samp(ym).over(fr))
    return _guard(xm, fr, n if min_periods is None else min_periods, value)


# W6
def running_sum_keep_null(c, keys=KEY, order=ORDER) -> Column:
    """pandas ``cumsum``: NULL rows stay NULL, the sum continues after them (rule N6)."""
    c = col(c)
    return F.when(c.isNotNull(), F.sum(c).over(running(keys, order)))


def running_sum(c, keys=KEY, order=ORDER) -> Column:
    return F.sum(col(c)).over(running(keys, order))


# W9
def row_index(keys=KEY, order=ORDER) -> Column:
    """0-based position in the series."""
    return F.row_number().over(series(keys, order)) - 1


def series_length(keys=KEY) -> Column:
    return F.count(F.lit(1)).over(Window.partitionBy(*keys))


# W10
def day_gap(date_col: str = ORDER, keys=KEY) -> Column:
    return F.datediff(F.col(date_col), F.lag(F.col(date_col)).over(series(keys, date_col)))


# W4 for long frames: Spark re-scans a sliding frame for every row (O(n*w)), so for
# long windows the count and the mean come from differences of running sums (O(1) per
# row, same sort).  Values are offset by the series' first value so the running sums
# stay small; the sample std is left in-frame (cancellation, see rolling_std).
def running_parts(c, name: str, keys=KEY, order=ORDER) -> dict:
    c = col(c)
    x0 = F.first(c, ignorenulls=True).over(whole(keys, order))
    return {f"{name}__x0": x0,
            f"{name}__s": F.sum(c - x0).over(running(keys, order)),
            f"{name}__n": F.count(c).over(running(keys, order))}


def rolling_mean_from_parts(name: str, n: int, min_periods: int | None = None, keys=KEY, order=ORDER) -> Column:
    """Rolling mean over ``n`` rows from the columns of ``running_parts(..., name)``."""
    s, cnt = F.col(f"{name}__s"), F.col(f"{name}__n")
    ws = s - F.coalesce(lag(s, n, keys, order), F.lit(0.0))
    wn = cnt - F.coalesce(lag(cnt, n, keys, order), F.lit(0))
    mp = n if min_periods is None else min_periods
    return F.when(wn >= mp, F.col(f"{name}__x0") + ws / wn)


def count_from_parts(name: str, n: int, keys=KEY, order=ORDER) -> Column:
    cnt = F.col(f"{name}__n")
    return cnt - F.coalesce(lag(cnt, n, keys, order), F.lit(0))


def add_long_moments(df, cols, n: int, names=None, keys=KEY, blk: str = "__blk", rn: str = "__rn",
                     block: int = 0):
    """Rolling count, mean and sample std over ``n`` rows in O(1) per row (W4, long windows).

    Needs the 0-based row ``rn`` and ``blk = rn div block`` with ``block >= n``; every
    window here is ordered by ``(blk, rn)`` or partitioned by ``(keys, blk)``, so it
    shares the caller's sort.  The frame ending at row t is the current block's prefix
    plus (when it reaches back) the previous block's suffix = that block's total minus
    its prefix at row t-n.  Sums are taken of ``x - anchor`` with the block's first
    value as anchor, so a difference never spans more than one block, and the two parts
    are merged with the parallel-variance formula (Chan et al.).  For each column ``c``
    (output name ``name``) adds ``{name}_n``, ``{name}_mean``, ``{name}_std``; several
    columns share the same window stages.
    """
    if block < n:
        raise ValueError("block must be at least the window length")
    cols = [cols] if isinstance(cols, str) else list(cols)
    names = [names] if isinstance(names, str) else list(names or cols)
    keys = list(keys)
    wblk_all = Window.partitionBy(*keys, blk).orderBy(rn).rowsBetween(Window.unboundedPreceding,
                                                                      Window.unboundedFollowing)
    wblk_run = Window.partitionBy(*keys, blk).orderBy(rn).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wser = Window.partitionBy(*keys).orderBy(blk, rn)
    wprev = Window.partitionBy(*keys).orderBy(blk).rangeBetween(-1, -1)
    end = F.col(rn) - F.col(blk) * F.lit(block) == F.lit(block - 1)
    ps = [f"__{nm}" for nm in names]
    df = df.withColumns({f"{p}_a": F.first(F.col(c), ignorenulls=True).over(wblk_all) for c, p in zip(cols, ps)})
    stage = {}
    for c, p in zip(cols, ps):
        d = F.col(c) - F.col(f"{p}_a")
        stage.update({f"{p}_N": F.count(F.col(c)).over(wblk_run),
                      f"{p}_S1": F.coalesce(F.sum(d).over(wblk_run), F.lit(0.0)),
                      f"{p}_S2": F.coalesce(F.sum(d * d).over(wblk_run), F.lit(0.0))})
    df = df.withColumns(stage)
    stage = {}
    for p in ps:
        stage.update({f"{p}_T{v}": F.max(F.when(end, F.col(f"{p}_{v}"))).over(wprev) for v in ("N", "S1", "S2")})
        stage.update({f"{p}_L{v}": F.lag(f"{p}_{v}", n).over(wser) for v in ("N", "S1", "S2", "a")})
    stage["__lm_Lb"] = F.lag(blk, n).over(wser)
    df = df.withColumns(stage)
    inside = F.coalesce(F.col("__lm_Lb") == F.col(blk), F.lit(False))
    prev = F.coalesce(F.col("__lm_Lb") == F.col(blk) - 1, F.lit(False))
    for nm, p in zip(names, ps):
        def part_a(v, p=p):
            return F.when(inside, F.col(f"{p}_{v}") - F.col(f"{p}_L{v}")).otherwise(F.col(f"{p}_{v}"))

        def part_b(v, p=p):
            return F.when(prev, F.col(f"{p}_T{v}") - F.col(f"{p}_L{v}")).otherwise(F.lit(0.0))

        df = df.withColumns({f"{p}_nA": part_a("N").cast("double"), f"{p}_s1A": part_a("S1"),
                             f"{p}_s2A": part_a("S2"), f"{p}_nB": part_b("N").cast("double"),
                             f"{p}_s1B": part_b("S1"), f"{p}_s2B": part_b("S2")})
        nA, nB = F.col(f"{p}_nA"), F.col(f"{p}_nB")
        df = df.withColumns({
            f"{p}_mA": F.when(nA > 0, F.col(f"{p}_a") + F.col(f"{p}_s1A") / nA),
            f"{p}_mB": F.when(nB > 0, F.col(f"{p}_La") + F.col(f"{p}_s1B") / nB),
            f"{p}_qA": F.when(nA > 0, F.col(f"{p}_s2A") - F.col(f"{p}_s1A") * F.col(f"{p}_s1A") / nA),
            f"{p}_qB": F.when(nB > 0, F.col(f"{p}_s2B") - F.col(f"{p}_s1B") * F.col(f"{p}_s1B") / nB)})
        tot = nA + nB
        mA, mB = F.col(f"{p}_mA"), F.col(f"{p}_mB")
        mean = (F.coalesce(nA * mA, F.lit(0.0)) + F.coalesce(nB * mB, F.lit(0.0))) / tot
        delta = mB - mA
        m2 = (F.coalesce(F.col(f"{p}_qA"), F.lit(0.0)) + F.coalesce(F.col(f"{p}_qB"), F.lit(0.0))
              + F.coalesce(delta * delta * nA * nB / tot, F.lit(0.0)))
        df = df.withColumns({
            f"{nm}_n": tot,
            f"{nm}_mean": F.when(tot > 0, mean),
            f"{nm}_std": F.when(tot > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (tot - 1))),
        })
    return df.drop("__lm_Lb", *[c2 for c2 in df.columns if any(c2.startswith(p + "_") for p in ps)])
