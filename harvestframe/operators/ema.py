"""Exponential moving averages (pandas ``ewm(adjust=False).mean()``) as a parallel block scan.

The recurrence ``y_0 = x_0, y_t = (1-a) y_{t-1} + a x_t`` has the closed form

    y_t = sum_{i<=t} w_i x_i b^(t-i),   b = 1-a,   w_0 = 1, w_i = a.

Rows are cut into blocks of B rows (``blk = rn div B``, ``j = rn mod B``).  Inside a block

    loc_t = b^j * sum_{i in block, i<=t} w_i x_i b^(-i)          (a running sum)

and ``y_t = loc_t + b^(j+1) * y_end(previous block)``.  B is chosen so that
``b^B < 1e-18``; then ``y_end(previous block) = loc_end(previous block)`` up to a
relative 1e-18, i.e. exactly in double precision, and it is read with a RANGE
frame over the block number (one value, recomputed once per block).  Inputs are
shifted by their series minimum so every term is non-negative (no cancellation;
the EMA is shift-equivariant), and B is also capped so ``b^(-B)`` cannot overflow.

All of it is window functions on the series partitioning: no shuffle beyond the
one the series windows already need, no Python, no collect.

``ema_over_gaps`` also takes NULLs between values.  A value g rows after the last one meets
an average that has decayed g times, and the weights are scaled to sum to one again:

    y_t = (b^g y_prev + a x_t) / (b^g + a),    y stays in the rows between

which is an affine map of its own for each value, with decay d_t = ln(1 + a b^-g).  Blocks are
then cut by decay instead of rows: ``blk = floor(sum of d / L)``, L = -ln 1e-18.  Inside a block
the weights span at most e^L, however long a gap is, and whatever lies before the previous
block weighs under 1e-18.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestframe.session import written

TRUNC_LOG = math.log(1e-18)   # target relative size of the dropped tail
MAX_LOG_SCALE = 575.0         # b^(-j) stays below e^575 (about 1e250)
SPAN = -TRUNC_LOG             # decay that a block of values with gaps spans
SEGMENT = 10_000              # rows of a segment in the plan without whole-series windows


def alpha_from_span(span: float) -> float:
    return 2.0 / (span + 1.0)


def alpha_from_com(com: float) -> float:
    return 1.0 / (com + 1.0)


def ema_memory(alpha: float) -> int:
    """Rows after which a start value weighs less than 1e-18 (the scan's block size)."""
    return max(1, math.ceil(-TRUNC_LOG / -math.log(1.0 - alpha))) if alpha < 1.0 else 1


@dataclass(frozen=True)
class EmaSpec:
    out: str
    src: str
    alpha: float


def _groups(specs: Sequence[EmaSpec]) -> list[tuple[int, list[EmaSpec]]]:
    """Group specs that can share one block size (one extra sort per group)."""
    todo = sorted(specs, key=lambda s: s.alpha)  # slowest decay first
    groups: list[tuple[int, list[EmaSpec]]] = []
    for s in todo:
        lb = -math.log(1.0 - s.alpha) if s.alpha < 1.0 else math.inf
        for g in groups:
            if g[0] * lb <= MAX_LOG_SCALE:
                g[1].append(s)
                break
        else:
            block = max(1, math.ceil(-TRUNC_LOG / lb)) if lb != math.inf else 1
            groups.append((block, [s]))
    return groups


def shared_block(specs: Sequence[EmaSpec]) -> int | None:
    """One block size valid for every spec (None if the decays are too far apart)."""
    groups = _groups(specs)
    return groups[0][0] if len(groups) == 1 else None


def with_ema(df: DataFrame, specs: Sequence[EmaSpec], keys: Sequence[str] = ("symbol",),
             order: str = "date", rn: str | None = None, blk: str | None = None,
             block: int | None = None) -> DataFrame:
    """Add one EMA column per spec.

    Leading NULLs of a source are skipped (the EMA starts at its first value, as
    pandas does); rows before it get NULL.  A NULL after a source's first value
    fails the query (``raise_error``): with a gap the weights depend on its length, which needs
    a sort per average (``ema_over_gaps``).

    A caller that already has the 0-based row index ``rn`` and the block number
    ``blk = rn div block`` passes them: every window here is then ordered by
    ``(blk, rn)`` and shares one sort with the caller's other windows.
    """
    keys = list(keys)
    own = rn is None or blk is None or block is None
    if not own:
        for s in specs:
            lb = -math.log(1.0 - s.alpha)
            if block * lb > MAX_LOG_SCALE or block < ema_memory(s.alpha):
                own = True
    if own:
        rn, tmp_rn = "__rn", True
        df = df.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)
        groups = _groups(specs)
        w = Window.partitionBy(*keys).orderBy(order)
    else:
        tmp_rn = False
        groups = [(block, list(specs))]
        w = Window.partitionBy(*keys).orderBy(blk, rn)
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    srcs = sorted({s.src for s in specs})

    tmp = {}
    for c in srcs:
        tmp[f"__first_{c}"] = F.first(c, ignorenulls=True).over(w_all)
        tmp[f"__started_{c}"] = F.count(c).over(w_run) > 0
        # the padded column below only repeats values of c, so its minimum is min(c);
        # taking it here keeps it in the same window operator
        tmp[f"__min_{c}"] = F.min(c).over(w_all)
    df = df.withColumns(tmp)
    for c in srcs:
        gap = F.col(f"__started_{c}") & F.col(c).isNull()
        message = F.lit(f"EMA of {c}: NULL after the first value")
        df = df.withColumn(f"__started_{c}", F.when(gap, F.raise_error(message).cast("boolean")).otherwise(F.col(f"__started_{c}")))
    # Shift to non-negative: pad the head with the first value (y stays x_first
    # through the padding), then subtract the series minimum.
    df = df.withColumns({f"__pad_{c}": F.when(F.col(f"__started_{c}"), F.col(c)).otherwise(F.col(f"__first_{c}"))
                         for c in srcs})
    df = df.withColumns({f"__x_{c}": F.col(f"__pad_{c}") - F.col(f"__min_{c}") for c in srcs})

    for gi, (bsize, group) in enumerate(groups):
        b_col = f"__blk{gi}" if own else blk
        j = f"__j{gi}"
        if own:
            df = df.withColumn(b_col, F.floor(F.col(rn) / F.lit(bsize)))
        df = df.withColumn(j, F.pmod(F.col(rn), F.lit(bsize)).cast("double"))
        wb = (Window.partitionBy(*keys, b_col).orderBy(rn)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        locs = {}
        for s in group:
            b = 1.0 - s.alpha
            wt = F.when(F.col(rn) == 0, F.lit(1.0)).otherwise(F.lit(s.alpha))
            term = wt * F.col(f"__x_{s.src}") * F.pow(F.lit(b), -F.col(j))
            locs[f"__loc_{s.out}"] = F.sum(term).over(wb) * F.pow(F.lit(b), F.col(j))
        df = df.withColumns(locs)
        wprev = Window.partitionBy(*keys).orderBy(b_col).rangeBetween(-1, -1)
        df = df.withColumns({f"__carry_{s.out}": F.coalesce(
            F.max(F.when(F.col(j) == bsize - 1, F.col(f"__loc_{s.out}"))).over(wprev), F.lit(0.0))
            for s in group})
        outs = {}
        for s in group:
            b = 1.0 - s.alpha
            y = (F.col(f"__loc_{s.out}") + F.pow(F.lit(b), F.col(j) + 1.0) * F.col(f"__carry_{s.out}")
                 + F.col(f"__min_{s.src}"))
            outs[s.out] = F.when(F.col(f"__started_{s.src}"), y)
        df = df.withColumns(outs)
        df = df.drop(j, *[f"__loc_{s.out}" for s in group], *[f"__carry_{s.out}" for s in group])
        if own:
            df = df.drop(b_col)
    drop = [f"__{p}_{c}" for c in srcs for p in ("first", "started", "pad", "min", "x")]
    if tmp_rn:
        drop.append(rn)
    return df.drop(*drop)


def ema_by_blocks(df: DataFrame, specs: Sequence[EmaSpec], keys: Sequence[str], pos: str) -> DataFrame:
    """``with_ema`` for series too long for one task, from each row's 0-based position ``pos``.

    The scan inside a block needs the block alone.  What spans the series comes as small tables:
    first value and minimum per series (an aggregate), and the last value of each block, joined to
    the next block.  No window holds more rows than a block.
    """
    keys = list(keys)
    srcs = sorted({s.src for s in specs})
    known = [x for c in srcs for x in (
        F.min(c).alias(f"__min_{c}"), F.min(F.when(F.col(c).isNotNull(), F.col(pos))).alias(f"__at_{c}"),
        F.min_by(c, F.when(F.col(c).isNotNull(), F.col(pos))).alias(f"__first_{c}"))]
    df = df.join(df.groupBy(*keys).agg(*known), keys)
    for c in srcs:
        started = F.col(pos) >= F.col(f"__at_{c}")
        gap = F.raise_error(F.lit(f"EMA of {c}: NULL after the first value")).cast("double")
        value = F.when(started, F.when(F.col(c).isNull(), gap).otherwise(F.col(c))).otherwise(F.col(f"__first_{c}"))
        df = df.withColumn(f"__x_{c}", value - F.col(f"__min_{c}"))
    for size, group in _groups(specs):
        j = F.pmod(F.col(pos), F.lit(size)).cast("double")
        df = df.withColumn("__blk", F.floor(F.col(pos) / F.lit(size)))
        run = Window.partitionBy(*keys, "__blk").orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = {}
        for s in group:
            b = 1.0 - s.alpha
            weight = F.when(F.col(pos) == 0, F.lit(1.0)).otherwise(F.lit(s.alpha))
            local[f"__loc_{s.out}"] = F.sum(weight * F.col(f"__x_{s.src}") * F.pow(F.lit(b), -j)).over(run) * F.pow(F.lit(b), j)
        df = df.withColumns(local)
        ends = df.where(j == size - 1).select(*keys, (F.col("__blk") + 1).alias("__blk"), *[F.col(f"__loc_{s.out}").alias(f"__end_{s.out}") for s in group])
        df = df.join(ends, [*keys, "__blk"], "left")
        df = df.withColumns({s.out: F.when(F.col(pos) >= F.col(f"__at_{s.src}"), F.col(f"__loc_{s.out}") + F.col(f"__min_{s.src}") + F.coalesce(
            F.pow(F.lit(1.0 - s.alpha), j + 1.0) * F.col(f"__end_{s.out}"), F.lit(0.0))) for s in group})
        df = df.drop("__blk", *[f"__{p}_{s.out}" for s in group for p in ("loc", "end")])
    return df.drop(*[f"__{p}_{c}" for c in srcs for p in ("min", "at", "first", "x")])


def _decay(alpha: float, gap: Column) -> Column:
    """-ln of the weight that the average before keeps at a value ``gap`` rows after the last; 0 at the first value."""
    lb = -math.log(1.0 - alpha)
    # ln(b^g + a) + g ln(1/b) has no power of 1/b that a long gap would overflow; past 2 L nothing is left to weigh
    d = F.least(F.log(F.exp(gap * F.lit(-lb)) + F.lit(alpha)) + gap * F.lit(lb), F.lit(2 * SPAN))
    return F.when(gap.isNull(), F.lit(0.0)).otherwise(d)


def _weight(alpha: float, gap: Column) -> Column:
    """The weight of a value ``gap`` rows after the last one; 1 at the first."""
    return F.when(gap.isNull(), F.lit(1.0)).otherwise(F.lit(alpha) / (F.exp(gap * F.lit(math.log(1.0 - alpha))) + F.lit(alpha)))


def _check(specs: Sequence[EmaSpec]) -> None:
    for s in specs:
        if not 0.0 < s.alpha < 1.0:
            raise ValueError(f"{s.out}: alpha {s.alpha} is not between 0 and 1")


def ema_over_gaps(df: DataFrame, specs: Sequence[EmaSpec], keys: Sequence[str] = ("symbol",), order: str = "date") -> DataFrame:
    """``with_ema`` for sources with NULLs between their values (pandas ``ewm(adjust=False, ignore_na=False)``).

    Rows before a source's first value get NULL, rows in a gap the average before it.  One
    shuffle by ``keys``, a sort by ``order`` and one more sort per average, for its blocks.
    """
    _check(specs)
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(order)
    run, before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.unboundedPreceding, -1)
    srcs = sorted({s.src for s in specs})
    df = df.withColumn("__nth", F.row_number().over(w))
    seen = {c: F.last(F.when(F.col(c).isNotNull(), F.col("__nth")), ignorenulls=True).over(before) for c in srcs}
    df = df.withColumns({f"__gap_{c}": F.col("__nth") - seen[c] for c in srcs}
                        | {f"__min_{c}": F.min(c).over(Window.partitionBy(*keys)) for c in srcs})
    df = df.withColumns({f"__d_{s.out}": F.when(F.col(s.src).isNotNull(), _decay(s.alpha, F.col(f"__gap_{s.src}"))).otherwise(F.lit(0.0)) for s in specs})
    df = df.withColumns({f"__blk_{s.out}": F.floor(F.sum(f"__d_{s.out}").over(run) / F.lit(SPAN)) for s in specs})
    for s in specs:
        df = _scan(df, s, keys, "__nth")
        # the block before ends at the last row before this block; its first row hands that on
        at = Window.partitionBy(*keys).orderBy(f"__blk_{s.out}", "__nth").rowsBetween(-1, -1)
        df = df.withColumn("__end", F.last("__local").over(at))
        block = Window.partitionBy(*keys, f"__blk_{s.out}").orderBy("__nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        df = _joined(df.withColumn("__end", F.first("__end").over(block)), s)
    return df.drop("__nth", *[f"__{p}_{c}" for c in srcs for p in ("gap", "min")])


def _scan(df: DataFrame, s: EmaSpec, keys: Sequence[str], rn: str) -> DataFrame:
    """``__in`` (decay since the block's first row), ``__enter`` (that row's own) and ``__local`` (the block's own part)."""
    d = f"__d_{s.out}"
    block = Window.partitionBy(*keys, f"__blk_{s.out}").orderBy(rn).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns({"__enter": F.first(d).over(block), "__in": F.sum(d).over(block)}).withColumn("__in", F.col("__in") - F.col("__enter"))
    term = _weight(s.alpha, F.col(f"__gap_{s.src}")) * (F.col(s.src) - F.col(f"__min_{s.src}")) * F.exp("__in")
    return df.withColumn("__local", F.sum(term).over(block) * F.exp(-F.col("__in")))


def _joined(df: DataFrame, s: EmaSpec) -> DataFrame:
    """The average from the block's own part and ``__end``, that of the block before."""
    before = F.coalesce(F.exp(-F.col("__in") - F.col("__enter")) * F.col("__end"), F.lit(0.0))
    df = df.withColumn(s.out, F.col("__local") + before + F.col(f"__min_{s.src}"))
    return df.drop("__in", "__enter", "__local", "__end", f"__d_{s.out}", f"__blk_{s.out}")


def ema_over_gaps_by_blocks(df: DataFrame, specs: Sequence[EmaSpec], keys: Sequence[str], pos: str) -> DataFrame:
    """``ema_over_gaps`` for series too long for one task, from each row's 0-based position ``pos``.

    Segments of ``SEGMENT`` rows hand on the place of the last value, the decay so far and the
    averages, each as one row per segment.  Blocks hold values only, so a long gap is in no block,
    and a block has at most L / -ln b of them.
    """
    _check(specs)
    keys = list(keys)
    srcs = sorted({s.src for s in specs})
    seg = [*keys, "__seg"]
    inside = Window.partitionBy(*seg).orderBy(pos)
    earlier = Window.partitionBy(*keys).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("__seg", F.floor(F.col(pos) / F.lit(SEGMENT)))
    place = {c: F.when(F.col(c).isNotNull(), F.col(pos)) for c in srcs}
    known = df.groupBy(*seg).agg(*[F.max(place[c]).alias(f"__at_{c}") for c in srcs], *[F.min(c).alias(f"__min_{c}") for c in srcs])
    known = known.select(*seg, *[F.max(f"__at_{c}").over(earlier).alias(f"__at_{c}") for c in srcs],
                         *[F.min(f"__min_{c}").over(Window.partitionBy(*keys)).alias(f"__min_{c}") for c in srcs])
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    work = df.select(*seg, pos, *srcs).join(known, seg)
    work = work.withColumns({f"__gap_{c}": F.col(pos) - F.coalesce(F.max(place[c]).over(before), F.col(f"__at_{c}")) for c in srcs})
    work = work.withColumns({f"__d_{s.out}": F.when(F.col(s.src).isNotNull(), _decay(s.alpha, F.col(f"__gap_{s.src}"))).otherwise(F.lit(0.0)) for s in specs})
    work = written(work.drop(*[f"__at_{c}" for c in srcs]), "ema-decays")
    total = work.groupBy(*seg).agg(*[F.sum(f"__d_{s.out}").alias(s.out) for s in specs])
    total = total.select(*seg, *[F.coalesce(F.sum(s.out).over(earlier), F.lit(0.0)).alias(f"__so_far_{s.out}") for s in specs])
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    work = work.join(total, seg)
    work = written(work.select(*seg, pos, *srcs, *[f"__{p}_{c}" for c in srcs for p in ("gap", "min")], *[f"__d_{s.out}" for s in specs], *[
        F.floor((F.col(f"__so_far_{s.out}") + F.sum(f"__d_{s.out}").over(run)) / F.lit(SPAN)).alias(f"__blk_{s.out}") for s in specs]), "ema-blocks")
    for s in specs:
        blk = f"__blk_{s.out}"
        values = work.where(F.col(s.src).isNotNull()).select(*keys, pos, s.src, f"__gap_{s.src}", f"__min_{s.src}", f"__d_{s.out}", blk)
        values = written(_scan(values, s, keys, pos), "ema-values")
        ends = values.groupBy(*keys, blk).agg(F.max_by("__local", pos).alias("__end")).withColumn(blk, F.col(blk) + 1)
        values = _joined(values.join(ends, [*keys, blk], "left"), s).select(*seg[:-1], pos, s.out)
        df = df.join(values, [*keys, pos], "left")
    df = written(df, "ema-averages")
    last = df.groupBy(*seg).agg(*[F.max_by(s.out, F.when(F.col(s.out).isNotNull(), F.col(pos))).alias(s.out) for s in specs])
    last = last.select(*seg, *[F.last(s.out, ignorenulls=True).over(earlier).alias(f"__last_{s.out}") for s in specs])
    df = df.join(last, seg)
    df = df.withColumns({s.out: F.coalesce(F.last(s.out, ignorenulls=True).over(run), F.col(f"__last_{s.out}")) for s in specs})
    return df.drop("__seg", *[f"__last_{s.out}" for s in specs])
