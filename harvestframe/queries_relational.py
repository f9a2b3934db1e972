"""Registered queries: projections P, joins J, aggregations A, windows W, sorts/sets T."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestframe.checks import sql as S
from harvestframe.checks import sql_more as S2
from harvestframe.functions.numeric import div, ln_pos
from harvestframe.functions.weather import names as weather_names
from harvestframe.operators import windows as Wn
from harvestframe.operators.asof import asof_date_map
from harvestframe.operators.chunking import POS, with_positions
from harvestframe.operators.ema import EmaSpec, alpha_from_com, alpha_from_span, ema_over_gaps, ema_over_gaps_by_blocks, with_ema
from harvestframe.operators.reshape import dedupe_keep, union_all, pivot_first_non_null
from harvestframe.operators.stats import bin_index, corr, decile_probs, exact_percentiles, null_rates
from harvestframe.plans.gold import feature_columns, feature_names
from harvestframe.plans.silver import WEATHER_COLS, build_silver, clean_futures, clean_weather, correlated_closes
from harvestframe.queries_core import gold, gold_table, silver
from harvestframe.registry import CFG, kinds_for, register
from harvestframe.session import written
from harvestframe.sources import tables as T

SIL = S.silver_sql()
GOLD = S.gold_sql()
FEATS = feature_names(CFG)
DEC = "[" + ", ".join(repr(p) for p in decile_probs()) + "]"


def weather_daily(spark, sf):
    return clean_weather(T.weather_long(spark, sf), CFG)


def futures(spark, sf):
    return clean_futures(T.bars(spark, sf), CFG)


# ---------------------------------------------------------------- P
@register("p1_parse_date", S.views_sql(),
          "SELECT CAST(date AS DATE) AS date, region, datatype, value FROM weather_long",
          kinds_for(["date", "region", "datatype", "value"]))
def p1_parse_date(spark, sf):
    """Landed date strings parsed to DATE."""
    return T.weather_long(spark, sf).withColumn("date", F.to_date("date"))


LABELS = ", ".join(f"('{s}', '{lab}')" for lab, s in [("corn", "BUILDING"), *CFG.correlated])


@register("p2_label_filter", S.views_sql() + f", inst(symbol, label) AS (VALUES {LABELS})",
          "SELECT b.* FROM bars b JOIN inst i USING (symbol) WHERE i.label = 'corn'",
          kinds_for(["symbol", "date", "open", "high", "low", "close", "volume"]))
def p2_label_filter(spark, sf):
    """Keep one instrument by its label column (corn = BUILDING)."""
    inst = spark.createDataFrame([("BUILDING", "corn")] + [(s, lab) for lab, s in CFG.correlated], "symbol string, label string")
    b = T.bars(spark, sf).join(inst, "symbol")
    return b.where(F.col("label") == "corn").drop("label")


@register("p3_min_volume", S.views_sql(),
          f"SELECT symbol, count(*) AS rows_in, count(*) FILTER (WHERE volume >= {S.lit(CFG.transforms.min_daily_volume)}) AS rows_kept, "
          f"count(*) FILTER (WHERE NOT volume >= {S.lit(CFG.transforms.min_daily_volume)} OR volume IS NULL) AS rows_dropped FROM bars GROUP BY symbol",
          kinds_for(["symbol", "rows_in", "rows_kept", "rows_dropped"], ints=("rows_in", "rows_kept", "rows_dropped")))
def p3_min_volume(spark, sf):
    """Minimum-volume filter; kept and dropped counts per symbol."""
    ok = F.col("volume") >= F.lit(CFG.transforms.min_daily_volume)
    return T.bars(spark, sf).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(ok).alias("rows_kept"),
        F.count_if(~F.coalesce(ok, F.lit(False))).alias("rows_dropped"))


@register("p4_units", SIL, "SELECT * FROM wpiv", kinds_for(["date", "region", "tmax_f", "tmin_f", "prcp_in", "snow_mm"]))
def p4_units(spark, sf):
    """Per station and day, snow converted from inches to mm."""
    w = T.weather_long(spark, sf).withColumn("date", F.to_date("date"))
    wide = pivot_first_non_null(w, ["date", "region"], "datatype", CFG.weather_datatypes)
    return wide.select("date", "region", F.col("TMAX").alias("tmax_f"), F.col("TMIN").alias("tmin_f"),
                       F.col("PRCP").alias("prcp_in"), (F.col("SNOW") * F.lit(CFG.transforms.snow_in_to_mm)).alias("snow_mm"))


@register("p5_range_ratio", SIL, "SELECT symbol, date, high_low_pct FROM fut",
          kinds_for(["symbol", "date", "high_low_pct"]))
def p5_range_ratio(spark, sf):
    """P5: (high - low) / close on the cleaned futures."""
    return futures(spark, sf).select("symbol", "date", "high_low_pct")


FUT_COLS = ["symbol", "date", "open", "high", "low", "close", "volume", "returns_1d", "log_return_1d", "high_low_pct"]


@register("p6_projection", SIL, "SELECT * FROM fut", kinds_for(FUT_COLS))
def p6_projection(spark, sf):
    """The fixed cleaned-futures projection."""
    return futures(spark, sf)


@register("p7_dropna", GOLD,
          "SELECT symbol, count(*) AS rows, min(date) AS first_date, max(date) AS last_date FROM gold WHERE "
          + " AND ".join(f"{c} IS NOT NULL" for c in ["target", *FEATS]) + " GROUP BY symbol",
          kinds_for(["symbol", "rows", "first_date", "last_date"], ints=("rows",), dates=("first_date", "last_date")))
def p7_dropna(spark, sf):
    """Rows with the target and every feature present, per symbol."""
    g = gold(spark, sf)
    return (g.dropna(subset=["target", *feature_columns(g)]).groupBy("symbol")
             .agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")))


@register("p8_feature_columns", GOLD,
          " UNION ALL ".join(f"SELECT '{c}' AS feature, {i} AS position, count({c}) AS non_null FROM gold"
                             for i, c in enumerate(FEATS)),
          kinds_for(["feature", "position", "non_null"], ints=("position", "non_null")))
def p8_feature_columns(spark, sf):
    """The model feature list (numeric, minus the exclusion set) with its non-null counts."""
    g = gold(spark, sf)
    cols = feature_columns(g)
    agg = g.agg(*[F.count(c).alias(c) for c in cols])
    st = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"), F.col(c).alias("non_null"))
                   for i, c in enumerate(cols)])
    return agg.select(F.explode(st).alias("x")).select("x.*")


# What a silver without weather, wheat and usd leaves of the features.
P9_FEATS = [c for c in FEATS if c not in {*WEATHER_COLS, *weather_names(CFG.features), "wheat_close", "usd_close", "corn_wheat_ratio",
                                          "corn_wheat_spread", "usd_return_5d", "corn_usd_corr_20d"}]


@register("p9_presence_branches", GOLD,
          " UNION ALL ".join(f"SELECT symbol, '{c}' AS feature, count(*) AS rows, count({c}) AS non_null FROM gold GROUP BY symbol" for c in P9_FEATS),
          kinds_for(["symbol", "feature", "rows", "non_null"], ints=("rows", "non_null")))
def p9_presence_branches(spark, sf):
    """Silver and gold built without weather and without the wheat and usd legs: the features of
    these sources are absent, all others are there with the same number of values."""
    from harvestframe.plans.gold import build_gold
    g = build_gold(build_silver(T.bars(spark, sf), None, CFG).drop("wheat_close", "usd_close"), CFG)
    cols = feature_columns(g)
    wide = g.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in cols])
    return wide.unpivot(["symbol", "rows"], cols, "feature", "non_null").select("symbol", "feature", "rows", "non_null")


# ---------------------------------------------------------------- J
# Days of the month without observations in the as-of queries, so that near days must be matched.
GAP = (10, 20)


def _asof(direction):
    def q(spark, sf):
        wd = clean_weather(T.weather_long(spark, sf, GAP), CFG).withColumn("weather_date", F.col("date"))
        m = asof_date_map(futures(spark, sf), wd, CFG.transforms.asof_tolerance_days, direction,
                          value_cols=["weather_date", "tmax_f", "tmin_f", "prcp_in", "snow_mm"])
        return m.withColumn("offset_days", F.datediff("weather_date", "date"))
    return q


def _asof_sql(direction):
    k = CFG.transforms.asof_tolerance_days
    lo, hi = {"nearest": (-k, k), "backward": (-k, 0), "forward": (0, k)}[direction]
    return (S.silver_sql(views=S.views_sql(GAP)) + f""",
c2 AS (SELECT sd.date, wd.date AS weather_date, wd.tmax_f, wd.tmin_f, wd.prcp_in, wd.snow_mm,
              datediff('day', sd.date, wd.date) AS offset_days
       FROM sd JOIN wday wd ON wd.date BETWEEN sd.date + {lo} AND sd.date + {hi}),
b2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY abs(offset_days), offset_days) AS rk FROM c2) WHERE rk = 1)""")


ASOF_COLS = kinds_for(["date", "weather_date", "tmax_f", "tmin_f", "prcp_in", "snow_mm", "offset_days"],
                      ints=("offset_days",), dates=("date", "weather_date"))
for _d in ("nearest", "backward", "forward"):
    register(f"j1_asof_{_d}", _asof_sql(_d),
             "SELECT date, weather_date, tmax_f, tmin_f, prcp_in, snow_mm, offset_days FROM b2", ASOF_COLS)(_asof(_d))


@register("j2_full_outer", SIL, "SELECT * FROM corr", kinds_for(["date", "wheat_close", "crude_close", "usd_close"]))
def j2_full_outer(spark, sf):
    """wheat/crude/usd closes on the union of their dates (one pivot)."""
    return correlated_closes(T.bars(spark, sf), CFG)


@register("j3_left_join", SIL, "SELECT symbol, date, close, wheat_close, crude_close, usd_close FROM silver",
          kinds_for(["symbol", "date", "close", "wheat_close", "crude_close", "usd_close"]))
def j3_left_join(spark, sf):
    """Correlated closes left-joined on the spine; holidays stay NULL."""
    f = futures(spark, sf).select("symbol", "date", "close")
    return f.join(correlated_closes(T.bars(spark, sf), CFG), "date", "left")


@register("j4_positional", SIL,
          f"SELECT symbol, date, high - low AS hl, abs(high - lag(close) OVER {S.W}) AS hc, "
          f"abs(low - lag(close) OVER {S.W}) AS lc, greatest(high - low, abs(high - lag(close) OVER {S.W}), "
          f"abs(low - lag(close) OVER {S.W})) AS tr FROM fut",
          kinds_for(["symbol", "date", "hl", "hc", "lc", "tr"]))
def j4_positional(spark, sf):
    """True-range components side by side on the same row, and their NULL-skipping max."""
    f = futures(spark, sf)
    c1 = Wn.lag("close")
    return f.select("symbol", "date", (F.col("high") - F.col("low")).alias("hl"),
                    F.abs(F.col("high") - c1).alias("hc"), F.abs(F.col("low") - c1).alias("lc"),
                    F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - c1), F.abs(F.col("low") - c1)).alias("tr"))


# ---------------------------------------------------------------- W
@register("w1_lag_diff", SIL,
          f"SELECT symbol, date, lag(close) OVER {S.W} AS close_lag1, close - lag(close) OVER {S.W} AS close_diff1, "
          f"lag(close, 5) OVER {S.W} AS close_lag5 FROM silver",
          kinds_for(["symbol", "date", "close_lag1", "close_diff1", "close_lag5"]))
def w1_lag_diff(spark, sf):
    """Lag / diff / shift over the series."""
    s = silver(spark, sf)
    return s.select("symbol", "date", Wn.lag("close").alias("close_lag1"), Wn.diff("close").alias("close_diff1"),
                    Wn.lag("close", 5).alias("close_lag5"))


@register("w2_pct_change", SIL + f""",
pp AS (SELECT symbol, date, last_value(crude_close IGNORE NULLS) OVER {S.W_RUN} AS cp,
              last_value(wheat_close IGNORE NULLS) OVER {S.W_RUN} AS wp FROM silver)""",
          f"SELECT symbol, date, {S.div('cp', f'lag(cp) OVER {S.W}')} - 1 AS crude_return_1d, "
          f"{S.div('wp', f'lag(wp, 5) OVER {S.W}')} - 1 AS wheat_return_5d FROM pp",
          kinds_for(["symbol", "date", "crude_return_1d", "wheat_return_5d"]))
def w2_pct_change(spark, sf):
    """pct_change with forward fill over holiday NULLs (rule N7)."""
    s = silver(spark, sf).withColumns({"cp": Wn.pad("crude_close"), "wp": Wn.pad("wheat_close")})
    return s.select("symbol", "date", Wn.pct_change_of_padded("cp", 1).alias("crude_return_1d"),
                    Wn.pct_change_of_padded("wp", 5).alias("wheat_return_5d"))


@register("w3_lead", SIL, f"SELECT symbol, date, lead(close, 5) OVER {S.W} AS close_lead5 FROM silver",
          kinds_for(["symbol", "date", "close_lead5"]))
def w3_lead(spark, sf):
    """Lead by the target horizon."""
    return silver(spark, sf).select("symbol", "date", Wn.lead("close", 5).alias("close_lead5"))


W4 = ["tmax_mean10", "tmax_mean10_mp1", "tmax_sum10_mp1", "tmax_std10_mp5", "close_std20"]


@register("w4_rolling", SIL,
          f"SELECT symbol, date, {S.rmean('tmax_f', 10)} AS tmax_mean10, {S.rmean('tmax_f', 10, 1)} AS tmax_mean10_mp1, "
          f"{S.rsum('tmax_f', 10, 1)} AS tmax_sum10_mp1, {S.rstd('tmax_f', 10, 5)} AS tmax_std10_mp5, "
          f"{S.rstd('close', 20)} AS close_std20 FROM silver",
          kinds_for(["symbol", "date", *W4]))
def w4_rolling(spark, sf):
    """Rolling mean/sum/sample std with pandas min_periods over a column with NULLs."""
    s = silver(spark, sf)
    return s.select("symbol", "date", Wn.rolling_mean("tmax_f", 10).alias("tmax_mean10"),
                    Wn.rolling_mean("tmax_f", 10, 1).alias("tmax_mean10_mp1"),
                    Wn.rolling_sum("tmax_f", 10, 1).alias("tmax_sum10_mp1"),
                    Wn.rolling_std("tmax_f", 10, 5).alias("tmax_std10_mp5"),
                    Wn.rolling_std("close", 20).alias("close_std20"))


@register("w5_rolling_corr", SIL + f""",
wl AS (SELECT *, {S.ln_pos(S.div('wheat_close', f'lag(wheat_close) OVER {S.W}'))} AS wheat_lr FROM silver)""",
          f"SELECT symbol, date, {S.rcorr('log_return_1d', 'wheat_lr', 20)} AS wheat_corr_20d, "
          f"{S.rcorr('log_return_1d', 'returns_1d', 20)} AS self_corr_20d FROM wl",
          kinds_for(["symbol", "date", "wheat_corr_20d", "self_corr_20d"]))
def w5_rolling_corr(spark, sf):
    """20-row correlation on complete pairs."""
    s = silver(spark, sf).withColumn("wheat_lr", ln_pos(div(F.col("wheat_close"), Wn.lag("wheat_close"))))
    return s.select("symbol", "date", Wn.rolling_corr("log_return_1d", "wheat_lr", 20).alias("wheat_corr_20d"),
                    Wn.rolling_corr("log_return_1d", "returns_1d", 20).alias("self_corr_20d"))


@register("w6_running_sum", SIL,
          f"SELECT symbol, date, sum(volume) OVER {S.W_RUN} AS volume_cum, "
          f"CASE WHEN tmax_f IS NOT NULL THEN sum(tmax_f) OVER {S.W_RUN} END AS tmax_cum FROM silver",
          kinds_for(["symbol", "date", "volume_cum", "tmax_cum"]))
def w6_running_sum(spark, sf):
    """Running sums; NULL rows stay NULL and the sum continues after them (rule N6)."""
    s = silver(spark, sf)
    return s.select("symbol", "date", Wn.running_sum("volume").alias("volume_cum"),
                    Wn.running_sum_keep_null("tmax_f").alias("tmax_cum"))


@register("w7_rolling_of_rolling", SIL + f""",
r1 AS (SELECT symbol, date, {S.rstd('close', 5)} AS std5 FROM silver)""",
          f"SELECT symbol, date, std5, {S.rmean('std5', 10)} AS std5_mean10 FROM r1",
          kinds_for(["symbol", "date", "std5", "std5_mean10"]))
def w7_rolling_of_rolling(spark, sf):
    """A rolling mean over a rolling std (two stages, one sort)."""
    s = silver(spark, sf).withColumn("std5", Wn.rolling_std("close", 5))
    return s.select("symbol", "date", "std5", Wn.rolling_mean("std5", 10).alias("std5_mean10"))


@register("w8_ema_hourly", S2.hourly_ema_sql(),
          "SELECT symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS hour, e5 AS ema_5, e60 AS ema_60, up AS gain_ema FROM he",
          kinds_for(["symbol", "hour", "ema_5", "ema_60", "gain_ema"], strs={"symbol", "hour"}))
def w8_ema_hourly(spark, sf):
    """EMA block scan on a second shape - hourly bars of the events table."""
    hb = T.hourly_bars(spark, sf)
    hb = hb.withColumn("gain", F.when(Wn.diff("close", order="ts").isNotNull(),
                                      F.greatest(Wn.diff("close", order="ts"), F.lit(0.0))))
    out = with_ema(hb, [EmaSpec("ema_5", "close", alpha_from_span(5)), EmaSpec("ema_60", "close", alpha_from_span(60)),
                        EmaSpec("gain_ema", "gain", alpha_from_com(13))], order="ts")
    return out.select("symbol", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("hour"), "ema_5", "ema_60", "gain_ema")


GAP_COLS = kinds_for(["symbol", "hour", "ema_5", "ema_60", "rise_ema"], strs={"symbol", "hour"})
GAP_SPECS = [EmaSpec("ema_5", "close", alpha_from_span(5)), EmaSpec("ema_60", "close", alpha_from_span(60)),
             EmaSpec("rise_ema", "rise", alpha_from_com(13))]
GAP_SELECT = "SELECT symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS hour, e5 AS ema_5, e60 AS ema_60, up AS rise_ema FROM hg"


def every_hour(spark, sf):
    """Each symbol's hours from its first to its last, with NULLs for hours without events and for ``rise`` of hours that do not rise."""
    hb = T.hourly_bars(spark, sf).select("symbol", "ts", "close", F.when(F.col("close") > F.col("open"), F.col("close") - F.col("open")).alias("rise"))
    ends = hb.groupBy("symbol").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    grid = ends.select("symbol", F.explode(F.expr("sequence(lo, hi, interval 1 hour)")).alias("ts"))
    return grid.join(hb, ["symbol", "ts"], "left")


def _named_hours(df):
    return df.select("symbol", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("hour"), "ema_5", "ema_60", "rise_ema")


@register("w8_ema_gaps", S2.gap_ema_sql(), GAP_SELECT, GAP_COLS)
def w8_ema_gaps(spark, sf):
    """Averages over every hour, re-weighted where hours have no value."""
    return _named_hours(ema_over_gaps(every_hour(spark, sf), GAP_SPECS, order="ts"))


@register("w8_ema_gaps_split", S2.gap_ema_sql(), GAP_SELECT, GAP_COLS)
def w8_ema_gaps_split(spark, sf):
    """The same without a window over a whole series."""
    hours = with_positions(every_hour(spark, sf), ["symbol"], "ts", F.date_trunc("month", "ts"))
    return _named_hours(ema_over_gaps_by_blocks(written(hours, "hours"), GAP_SPECS, ["symbol"], POS))


@register("w9_positional", SIL,
          f"SELECT symbol, date, row_number() OVER {S.W} - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS n, "
          f"CASE WHEN row_number() OVER {S.W} - 1 < count(*) OVER (PARTITION BY symbol) // 2 THEN 'first' ELSE 'second' END AS half "
          "FROM silver",
          kinds_for(["symbol", "date", "pos", "n", "half"], ints=("pos", "n"), strs={"symbol", "half"}))
def w9_positional(spark, sf):
    """Position in the series, series length and positional halves."""
    s = silver(spark, sf).withColumns({"pos": Wn.row_index(), "n": Wn.series_length()})
    return s.select("symbol", "date", "pos", "n",
                    F.when(F.col("pos") < F.floor(F.col("n") / 2), "first").otherwise("second").alias("half"))


@register("w10_date_gap", SIL,
          f"SELECT symbol, max(gap) AS max_gap, avg(gap) AS mean_gap FROM (SELECT symbol, datediff('day', lag(date) OVER {S.W}, date) AS gap FROM silver) GROUP BY symbol",
          kinds_for(["symbol", "max_gap", "mean_gap"], ints=("max_gap",)))
def w10_date_gap(spark, sf):
    """Largest and mean gap in days between consecutive rows."""
    s = silver(spark, sf).withColumn("gap", Wn.day_gap())
    return s.groupBy("symbol").agg(F.max("gap").alias("max_gap"), F.avg("gap").alias("mean_gap"))


# ---------------------------------------------------------------- A
# The first ingest lacks the maxima of one station and has other values than the later one.
ING_SQL = """,
w1 AS (SELECT date, region, datatype, CASE WHEN region = 'ASIA' AND datatype = 'TMAX' THEN NULL ELSE value + 20 END AS v, 1 AS ing FROM {0}
       UNION ALL SELECT date, region, datatype, value, 2 FROM {0}),
{1} AS (SELECT date, region, datatype, arg_min(v, ing) AS value FROM w1 WHERE v IS NOT NULL GROUP BY 1, 2, 3)"""


def two_ingests(spark, sf):
    """The landed weather ingested twice; the first ingest counts where it has a value."""
    w = T.weather_long(spark, sf)
    first = F.when((F.col("region") == "ASIA") & (F.col("datatype") == "TMAX"), None).otherwise(F.col("value") + 20)
    return w.withColumn("value", first), w


@register("a1_pivot", S.views_sql() + ING_SQL.format("weather_long", "wi"),
          f"SELECT CAST(date AS DATE) AS date, region, max(value) FILTER (WHERE datatype = 'TMAX') AS tmax_f, max(value) FILTER (WHERE datatype = 'TMIN') AS tmin_f, "
          f"max(value) FILTER (WHERE datatype = 'PRCP') AS prcp_in, max(value) FILTER (WHERE datatype = 'SNOW') * {S.lit(CFG.transforms.snow_in_to_mm)} AS snow_mm "
          "FROM wi GROUP BY 1, 2",
          kinds_for(["date", "region", "tmax_f", "tmin_f", "prcp_in", "snow_mm"]))
def a1_pivot(spark, sf):
    """A1: long -> wide over two ingests, first non-NULL value by ingest order per (date, station, datatype)."""
    first, later = two_ingests(spark, sf)
    both = later.withColumn("_ingest_date", F.lit("2024-01-02")).unionByName(first.withColumn("_ingest_date", F.lit("2024-01-01")))
    wide = pivot_first_non_null(both.withColumn("date", F.to_date("date")), ["date", "region"], "datatype", CFG.weather_datatypes,
                                order_cols=["_ingest_date"])
    return wide.select("date", "region", F.col("TMAX").alias("tmax_f"), F.col("TMIN").alias("tmin_f"),
                       F.col("PRCP").alias("prcp_in"), (F.col("SNOW") * F.lit(CFG.transforms.snow_in_to_mm)).alias("snow_mm"))


# Silver over a bronze root with two ingests of every day (T4, A1, F32 together).
ING_VIEWS = (S.views_sql().replace("bars AS (", "bars0 AS (").replace("weather_long AS (", "weather0 AS (") + ING_SQL.format("weather0", "weather_long") + """,
bars AS (SELECT symbol, date, open, high, low, arg_min(c, ing) AS close, volume FROM (
           SELECT *, close + 1 AS c, 1 AS ing FROM bars0 UNION ALL SELECT *, close AS c, 2 AS ing FROM bars0) GROUP BY symbol, date, open, high, low, volume)""")


@register("f32_silver_two_ingests", S.silver_sql(views=ING_VIEWS), "SELECT * FROM silver", kinds_for(
    ["symbol", "date", "open", "high", "low", "close", "volume", "returns_1d", "log_return_1d", "high_low_pct", "tmax_f", "tmin_f", "prcp_in",
     "snow_mm", "wheat_close", "crude_close", "usd_close", "day_of_week", "month"]))
def f32_silver_two_ingests(spark, sf):
    """F32 over bronze with two ingests per day whose values differ: the first ingest counts."""
    from harvestframe.session import scratch_path
    from harvestframe.sources import bronze as B
    first, later = two_ingests(spark, sf)
    b = T.bars(spark, sf)
    weather, bars = scratch_path(spark, "weather"), scratch_path(spark, "bars")
    for day, w, x in (("2024-01-02", later, b), ("2024-01-01", first, b.withColumn("close", F.col("close") + 1))):
        B.write_bronze(w, weather, "weather", day)
        B.write_bronze(x, bars, "futures", day)
    return build_silver(B.read_bronze(spark, bars), B.read_bronze(spark, weather), CFG)


@register("a2_station_mean", SIL, "SELECT * FROM wday", kinds_for(["date", "tmax_f", "tmin_f", "prcp_in", "snow_mm"]))
def a2_station_mean(spark, sf):
    """A2: NULL-skipping station mean per day."""
    return weather_daily(spark, sf)


@register("a3_null_rates", GOLD,
          " UNION ALL ".join(f"SELECT symbol, '{c}' AS feature, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate, "
                             f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > {CFG.monitoring.max_feature_null_rate} AS above FROM gold GROUP BY symbol"
                             for c in FEATS),
          kinds_for(["symbol", "feature", "null_rate", "above"], bools=("above",)))
def a3_null_rates(spark, sf):
    """A3: null rate per symbol and feature and whether it exceeds the 10 % threshold."""
    g = gold(spark, sf)
    nr = null_rates(g, feature_columns(g)).withColumnRenamed("column", "feature")
    return nr.withColumn("above", F.col("null_rate") > CFG.monitoring.max_feature_null_rate)


def _a4_sql():
    from harvestframe.registry import GOLD_COLS
    cols = [c for c in GOLD_COLS if c != "symbol"]
    rates = " + ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)" for c in ["symbol", *cols])
    return (f"SELECT symbol, count(*) AS rows, min(date) AS min_date, max(date) AS max_date, "
            f"({rates}) / {len(cols) + 1} AS null_pct, avg(CASE WHEN target IS NULL THEN 1.0 ELSE 0.0 END) AS target_null_pct "
            f"FROM gold GROUP BY symbol")


@register("a4_table_stats", GOLD, _a4_sql(),
          kinds_for(["symbol", "rows", "min_date", "max_date", "null_pct", "target_null_pct"], ints=("rows",),
                    dates=("min_date", "max_date")))
def a4_table_stats(spark, sf):
    """A4: rows, date range, overall null share (mean of column null rates), target null share."""
    g = gold(spark, sf)
    rates = [F.avg(F.col(c).isNull().cast("double")) for c in g.columns]
    return g.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("min_date"),
                                   F.max("date").alias("max_date"),
                                   (sum(rates) / F.lit(len(rates))).alias("null_pct"),
                                   F.avg(F.col("target").isNull().cast("double")).alias("target_null_pct"))


@register("a5_uniqueness", SIL,
          "SELECT count(*) AS rows, count(DISTINCT (symbol, date)) AS distinct_keys, count(*) = count(DISTINCT (symbol, date)) AS is_unique FROM silver",
          kinds_for(["rows", "distinct_keys", "is_unique"], ints=("rows", "distinct_keys"), bools=("is_unique",)))
def a5_uniqueness(spark, sf):
    """A5: distinct (symbol, date) count equals the row count."""
    s = silver(spark, sf)
    return s.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("symbol", "date").alias("distinct_keys")) \
        .withColumn("is_unique", F.col("rows") == F.col("distinct_keys"))


@register("a6_date_range", S.views_sql(),
          "SELECT symbol, min(date) AS min_date, max(date) AS max_date FROM bars GROUP BY symbol",
          kinds_for(["symbol", "min_date", "max_date"], dates=("min_date", "max_date")))
def a6_date_range(spark, sf):
    """First and latest date per series."""
    return T.bars(spark, sf).groupBy("symbol").agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def _corr_sql(x, y):
    xm = f"(CASE WHEN {y} IS NOT NULL THEN {x} END)"
    ym = f"(CASE WHEN {x} IS NOT NULL THEN {y} END)"
    return S.div(f"covar_samp({xm}, {ym})", f"stddev_samp({xm}) * stddev_samp({ym})")


@register("a7_corr", GOLD, f"SELECT symbol, {_corr_sql('close', 'target')} AS corr_close_target FROM gold GROUP BY symbol",
          kinds_for(["symbol", "corr_close_target"]))
def a7_corr(spark, sf):
    """Pearson correlation of close and target on complete pairs."""
    return gold(spark, sf).groupBy("symbol").agg(corr("close", "target").alias("corr_close_target"))


PCOLS = [f"p{int(round(p * 100))}" for p in decile_probs()]


@register("a8_percentiles", GOLD,
          f"SELECT symbol, {', '.join(f'q[{i + 1}] AS {c}' for i, c in enumerate(PCOLS))} FROM "
          f"(SELECT symbol, quantile_cont(close, {DEC}) AS q FROM gold GROUP BY symbol)",
          kinds_for(["symbol", *PCOLS]))
def a8_percentiles(spark, sf):
    """Exact deciles of close (linear interpolation) per symbol."""
    q = exact_percentiles(gold_table(spark, sf), ["symbol"], "close", decile_probs())
    return q.select("symbol", *[F.col("q")[i].alias(c) for i, c in enumerate(PCOLS)])


@register("a9_histogram", GOLD + f""",
he AS (SELECT symbol, list_sort(list_distinct(quantile_cont(close, {DEC}))) AS edges FROM gold GROUP BY symbol),
hb AS (SELECT g.symbol, CASE WHEN g.close < e.edges[1] OR g.close > e.edges[len(e.edges)] THEN NULL
                             WHEN g.close = e.edges[len(e.edges)] THEN len(e.edges) - 2
                             ELSE len(list_filter(e.edges, lambda x: x <= g.close)) - 1 END AS bin
       FROM gold g JOIN he e USING (symbol))""",
          "SELECT symbol, bin, count(*) AS count FROM hb WHERE bin IS NOT NULL GROUP BY symbol, bin",
          kinds_for(["symbol", "bin", "count"], ints=("bin", "count")))
def a9_histogram(spark, sf):
    """Histogram of close with explicit (decile) edges: half-open bins, last closed."""
    g = gold_table(spark, sf)
    e = exact_percentiles(g, ["symbol"], "close", decile_probs(), out="edges").withColumn("edges", F.array_distinct("edges"))
    b = g.join(e, "symbol").withColumn("bin", bin_index(F.col("edges"), F.col("close")))
    return b.where(F.col("bin").isNotNull()).groupBy("symbol", "bin").agg(F.count(F.lit(1)).alias("count"))


@register("a11_mean_abs", GOLD,
          " UNION ALL ".join(f"SELECT symbol, '{c}' AS feature, avg(abs({c})) AS mean_abs FROM gold GROUP BY symbol" for c in FEATS),
          kinds_for(["symbol", "feature", "mean_abs"]))
def a11_mean_abs(spark, sf):
    """Mean absolute value per feature and symbol (one aggregation, unpivoted)."""
    g = gold(spark, sf)
    cols = feature_columns(g)
    wide = g.groupBy("symbol").agg(*[F.avg(F.abs(F.col(c).cast("double"))).alias(c) for c in cols])
    return wide.unpivot(["symbol"], cols, "feature", "mean_abs")


# ---------------------------------------------------------------- T
@register("t1_sort", SIL, "SELECT symbol, date, close FROM silver ORDER BY symbol, date",
          kinds_for(["symbol", "date", "close"]))
def t1_sort(spark, sf):
    """Output sorted by series and date (the only global sort, at the output)."""
    return silver(spark, sf).select("symbol", "date", "close").orderBy("symbol", "date")


@register("t2_latest_row", GOLD,
          "SELECT symbol, 'latest' AS kind, max(date) AS date FROM gold GROUP BY symbol UNION ALL "
          "SELECT symbol, 'latest_complete', max(date) FROM gold WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FEATS) +
          " GROUP BY symbol",
          kinds_for(["symbol", "kind", "date"], strs={"symbol", "kind"}))
def t2_latest_row(spark, sf):
    """Latest row and latest row with every feature present, per symbol (max_by, no sort)."""
    from harvestframe.plans.scoring import latest_row
    g = gold(spark, sf)
    a = latest_row(g.select("symbol", "date", "close")).select("symbol", F.lit("latest").alias("kind"), "date")
    b = latest_row(g, require=feature_columns(g)).select("symbol", F.lit("latest_complete").alias("kind"), "date")
    return a.unionByName(b)


@register("t3_top_k", GOLD,
          "SELECT feature, mean_abs FROM (" + " UNION ALL ".join(
              f"SELECT '{c}' AS feature, avg(abs({c})) AS mean_abs FROM gold" for c in FEATS) +
          ") ORDER BY mean_abs DESC LIMIT 5",
          kinds_for(["feature", "mean_abs"]))
def t3_top_k(spark, sf):
    """Top-5 features by mean absolute value (TakeOrderedAndProject, no full sort)."""
    g = gold(spark, sf)
    cols = feature_columns(g)
    wide = g.agg(*[F.avg(F.abs(F.col(c).cast("double"))).alias(c) for c in cols])
    return wide.unpivot([], cols, "feature", "mean_abs").orderBy(F.desc("mean_abs")).limit(5)


@register("t4_dedupe", S.views_sql() + """,
ing AS (SELECT *, '2024-01-01' AS ingest_date FROM bars UNION ALL
        SELECT symbol, date, open, high, low, close + 1, volume, '2024-01-02' FROM bars)""",
          "SELECT symbol, date, close, ingest_date FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY ingest_date) AS k FROM ing) WHERE k = 1",
          kinds_for(["symbol", "date", "close", "ingest_date"]))
def t4_dedupe(spark, sf):
    """T4: two ingests of the same days; dedupe keeps the earliest-ingested row."""
    b = T.bars(spark, sf)
    both = b.withColumn("ingest_date", F.lit("2024-01-01")).unionByName(
        b.withColumn("close", F.col("close") + 1).withColumn("ingest_date", F.lit("2024-01-02")))
    return dedupe_keep(both, ["symbol", "date"], ["ingest_date"], "first").select("symbol", "date", "close", "ingest_date")


@register("t5_union_by_name", S.views_sql(),
          "SELECT symbol, date, close, NULL AS datatype, CAST(NULL AS DOUBLE) AS value FROM bars UNION ALL "
          "SELECT region, CAST(date AS DATE), NULL, datatype, value FROM weather_long",
          kinds_for(["symbol", "date", "close", "datatype", "value"], dates=("date",), strs={"symbol", "datatype"}))
def t5_union_by_name(spark, sf):
    """T5: bars and weather cells stacked by column name; what a side lacks is NULL, repeated rows stay."""
    w = T.weather_long(spark, sf).select("datatype", "value", F.to_date("date").alias("date"), F.col("region").alias("symbol"))
    return union_all([T.bars(spark, sf).select("symbol", "date", "close"), w])


@register("t5_union", S.views_sql(), "SELECT * FROM weather_long",
          kinds_for(["date", "region", "datatype", "value"], dates=(), strs={"date", "region", "datatype"}))
def t5_union(spark, sf):
    """T5: the rows of all stations in one read (a union of one read per station would scan as often)."""
    return T.weather_long(spark, sf).join(T.stations(spark, sf).select("region"), "region", "left_semi")


SIL_NR_COLS = ["open", "high", "low", "close", "volume", "returns_1d", "log_return_1d", "high_low_pct", "tmax_f",
               "tmin_f", "prcp_in", "snow_mm", "wheat_close", "crude_close", "usd_close", "day_of_week", "month"]
WX_COLS = ["tmax_f", "tmin_f", "prcp_in", "snow_mm"]


@register("a3_silver_null_rates", SIL,
          " UNION ALL ".join(f"SELECT 'silver' AS source, '{c}' AS feature, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate, "
                             f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.05 AS above FROM silver" for c in SIL_NR_COLS)
          + " UNION ALL " +
          " UNION ALL ".join(f"SELECT 'weather', '{c}', avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), "
                             f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > {CFG.transforms.max_null_rate} FROM wday" for c in WX_COLS),
          kinds_for(["source", "feature", "null_rate", "above"], bools=("above",)))
def a3_silver_null_rates(spark, sf):
    """A3: silver summary (columns above 5 % NULL) and the station-mean weather columns above max_null_rate."""
    s = null_rates(silver(spark, sf), SIL_NR_COLS, keys=()).withColumnRenamed("column", "feature")
    w = null_rates(weather_daily(spark, sf), WX_COLS, keys=()).withColumnRenamed("column", "feature")
    return (s.select(F.lit("silver").alias("source"), "feature", "null_rate", (F.col("null_rate") > 0.05).alias("above"))
             .unionByName(w.select(F.lit("weather").alias("source"), "feature", "null_rate",
                                   (F.col("null_rate") > CFG.transforms.max_null_rate).alias("above"))))
