"""Registered queries: bars, sessions, prices by volume, pivots, data health."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators import health as H
from .registry import query

_OHLC = 'arg_min(open, t) AS open, max(high) AS high, min(low) AS low, arg_max("close", t) AS "close", sum(volume) AS volume, count(*) AS n'
_TICK_OHLC = 'min(epoch) AS open_epoch, max(epoch) AS close_epoch, count(*) AS n_ticks, arg_min(price, seq) AS open, max(price) AS high, min(price) AS low, arg_max(price, seq) AS "close", sum(volume) AS volume'


@query("bar_resample_to_interval", """-- floats: open high low close volume
SELECT series_id, t, open, high, low, "close", volume, n FROM bars""")
def _(v):
    return B.resample_ticks(v.ticks, 3600)


@query("bar_convert_timeframe", f"""-- floats: open high low close volume
SELECT series_id, t - t % 14400 AS t, {_OHLC.replace('count(*) AS n', 'CAST(sum(1) AS BIGINT) AS n')} FROM bars GROUP BY series_id, t - t % 14400""")
def _(v):
    return B.resample(v.bars, 14400)


@query("bar_align_to_session", f"""-- floats: open high low close volume
SELECT series_id, (t - 7 * 3600) - (t - 7 * 3600) % 86400 + 7 * 3600 AS t, {_OHLC} FROM bars WHERE idx > 0 OR (t - 7 * 3600) % 86400 = 0 GROUP BY ALL""")
def _(v):
    return B.align_to_session(v.bars, 7)


@query("bar_construct_tick", f"""-- floats: open high low close volume
SELECT * FROM (SELECT series_id, CAST((rn - 1) // 25 AS BIGINT) AS bar, {_TICK_OHLC} FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY seq) AS rn FROM ticks) GROUP BY ALL) WHERE n_ticks >= 2""")
def _(v):
    return B.tick_bars(v.ticks, 25).withColumn("bar", F.col("bar").cast("long"))


def _reset_sql(measure: str, limit: float, signed: bool = False) -> str:
    test = "abs(a.s + x.m)" if signed else "a.s + x.m"
    fold = f"list_reduce(list_prepend({{'m': 0.0, 's': 0.0, 'b': 0, 'n': 0}}, list({{'m': {measure}, 's': 0.0, 'b': 0, 'n': 0}} ORDER BY seq))"
    return f"""-- floats: open high low close volume measure_sum
SELECT k.series_id, bar, {_TICK_OHLC}, sum(m) AS measure_sum FROM (
WITH RECURSIVE n AS (SELECT *, {measure} AS m, row_number() OVER (PARTITION BY series_id ORDER BY seq) AS rn FROM ticks),
f AS (SELECT series_id, 0::BIGINT AS rn, 0::BIGINT AS bar, 0.0::DOUBLE AS s, false AS done FROM n GROUP BY series_id
UNION ALL SELECT n.series_id, n.rn, CASE WHEN f.done THEN f.bar + 1 ELSE f.bar END, (CASE WHEN f.done THEN 0.0 ELSE f.s END) + n.m, {'abs' if signed else ''}((CASE WHEN f.done THEN 0.0 ELSE f.s END) + n.m) >= {limit} FROM f JOIN n ON n.series_id = f.series_id AND n.rn = f.rn + 1)
SELECT n.*, f.bar, max(CASE WHEN f.done THEN f.bar END) OVER (PARTITION BY n.series_id) AS full_bars FROM n JOIN f USING (series_id, rn)) k WHERE bar <= full_bars GROUP BY ALL"""


@query("bar_construct_volume", _reset_sql("volume", 500.0))
def _(v):
    return B.reset_bars(v.ticks, F.col("volume"), 500.0)


@query("bar_construct_dollar", _reset_sql("price * volume", 25000.0))
def _(v):
    return B.reset_bars(v.ticks, F.col("price") * F.col("volume"), 25000.0)


@query("bar_construct_imbalance", _reset_sql("(CASE WHEN side = 'buy' THEN volume ELSE -volume END)", 150.0, True))
def _(v):
    return B.reset_bars(v.ticks, F.when(F.col("side") == "buy", F.col("volume")).otherwise(-F.col("volume")), 150.0, signed=True)


@query("vwap_compute", """-- floats: vwap volume
SELECT series_id, sum(price * volume) / nullif(sum(volume), 0) AS vwap, sum(volume) AS volume FROM ticks GROUP BY ALL""")
def _(v):
    return v.ticks.groupBy("series_id").agg(B.vwap().alias("vwap"), F.sum("volume").alias("volume"))


@query("twap_compute", """-- floats: twap
SELECT series_id, sum("close" * n) / sum(n) AS twap FROM bars GROUP BY ALL""")
def _(v):
    return v.bars.groupBy("series_id").agg(B.twap("close", "n").alias("twap"))


@query("vwap_per_session", """-- floats: vwap volume
SELECT series_id, name AS session, sum(price * volume) / nullif(sum(volume), 0) AS vwap, count(*) AS n, sum(volume) AS volume FROM ticks JOIN (VALUES ('asia', 23, 8), ('europe', 7, 16), ('america', 13, 22)) s(name, a, b)
ON CASE WHEN a < b THEN epoch % 86400 // 3600 >= a AND epoch % 86400 // 3600 < b ELSE a <> b AND (epoch % 86400 // 3600 >= a OR epoch % 86400 // 3600 < b) END GROUP BY ALL""")
def _(v):
    return B.vwap_per_session(v.ticks, v.spark.createDataFrame([("asia", 23, 8), ("europe", 7, 16), ("america", 13, 22)], "name string, start_hour int, end_hour int"))


@query("vwap_slippage", """-- floats: price vwap slippage_abs slippage_bps cost
SELECT series_id, seq, price, vwap, (price - vwap) * s AS slippage_abs, (price - vwap) * s / vwap * 10000 AS slippage_bps, (price - vwap) * s * volume AS cost,
CASE WHEN (price - vwap) * s / vwap * 10000 < -5 THEN 'excellent' WHEN (price - vwap) * s / vwap * 10000 < 0 THEN 'good' WHEN (price - vwap) * s / vwap * 10000 < 10 THEN 'acceptable' ELSE 'poor' END AS verdict
FROM (SELECT *, CASE WHEN side = 'buy' THEN 1.0 ELSE -1.0 END AS s FROM ticks) JOIN (SELECT series_id, epoch // 86400 AS day, sum(price * volume) / nullif(sum(volume), 0) AS vwap FROM ticks GROUP BY ALL) d USING (series_id) WHERE epoch // 86400 = day""")
def _(v):
    day = F.floor(F.col("epoch") / 86400).alias("day")
    market = v.ticks.groupBy("series_id", day).agg(B.vwap().alias("vwap"))
    fills = v.ticks.withColumn("day", F.floor(F.col("epoch") / 86400)).withColumnRenamed("volume", "size").join(market, ["series_id", "day"])
    return B.slippage(fills).select("series_id", "seq", "price", "vwap", "slippage_abs", "slippage_bps", "cost", "verdict")


@query("vwap_participation_rate", """-- floats: participation_pct
SELECT *, CASE WHEN participation_pct < 1 THEN 'negligible' WHEN participation_pct < 5 THEN 'low' WHEN participation_pct < 10 THEN 'moderate' WHEN participation_pct < 25 THEN 'high' ELSE 'dominant' END AS impact FROM (
SELECT series_id, epoch // 86400 AS day, 100 * sum(CASE WHEN seq % 10 = 0 THEN volume ELSE 0 END) / nullif(sum(volume), 0) AS participation_pct FROM ticks GROUP BY ALL)""")
def _(v):
    g = v.ticks.groupBy("series_id", F.floor(F.col("epoch") / 86400).alias("day")).agg(F.sum(F.when(F.col("seq") % 10 == 0, F.col("volume")).otherwise(0.0)).alias("own"), F.sum("volume").alias("market"))
    pct, impact = B.participation(F.col("own"), F.col("market"))
    return g.select("series_id", "day", pct.alias("participation_pct"), impact.alias("impact"))


_PREV = """(SELECT series_id, t, lag(h) OVER w AS h, lag(l) OVER w AS l, lag(c) OVER w AS c, lag(o) OVER w AS o FROM (SELECT series_id, t - t % 86400 AS t, max(high) AS h, min(low) AS l, arg_max("close", t) AS c, arg_min(open, t) AS o FROM bars GROUP BY series_id, t - t % 86400) WINDOW w AS (PARTITION BY series_id ORDER BY t))"""
_LEVELS = {
    "classic": {"p": "(h+l+c)/3", "r1": "2*((h+l+c)/3)-l", "s1": "2*((h+l+c)/3)-h", "r2": "(h+l+c)/3+(h-l)", "s2": "(h+l+c)/3-(h-l)"},
    "fibonacci": {"p": "(h+l+c)/3"} | {f"{a}{k}": f"(h+l+c)/3{s}{x}*(h-l)" for k, x in ((1, 0.382), (2, 0.618), (3, 1.0)) for a, s in (("r", "+"), ("s", "-"))},
    "camarilla": {"p": "(h+l+c)/3"} | {f"{a}{k}": f"c{s}(h-l)*1.1/{x}" for k, x in ((1, 12), (2, 6), (3, 4), (4, 2)) for a, s in (("r", "+"), ("s", "-"))},
    "woodie": {"p": "(h+l+2*c)/4", "r1": "2*((h+l+2*c)/4)-l", "s1": "2*((h+l+2*c)/4)-h", "r2": "(h+l+2*c)/4+(h-l)", "s2": "(h+l+2*c)/4-(h-l)"},
    "demark": {k: e.replace("x", "(CASE WHEN c < o THEN h+2*l+c WHEN c > o THEN 2*h+l+c ELSE h+l+2*c END)") for k, e in {"p": "x/4", "r1": "x/2-l", "s1": "x/2-h"}.items()},
}


def _previous(v):
    """Levels of a day from the day before."""
    w = Window.partitionBy("series_id").orderBy("t")
    return B.resample(v.bars, 86400).select("series_id", "t", *(F.lag(c).over(w).alias(c[0]) for c in ("high", "low", "close", "open")))


for _kind, _cols in _LEVELS.items():

    @query(f"pivots_{_kind}", f"-- floats: {' '.join(_cols)}\nSELECT series_id, t, {', '.join(f'{e} AS {k}' for k, e in _cols.items())} FROM {_PREV}")
    def _(v, kind=_kind):
        levels = B.pivots(*(F.col(c) for c in "hlco"))[kind]
        return _previous(v).select("series_id", "t", *(e.alias(k) for k, e in levels.items()))


@query("pivots_compare_all", "-- floats: p r1 s1\n" + " UNION ALL ".join(f"SELECT series_id, t, '{k}' AS kind, {c['p']} AS p, {c['r1']} AS r1, {c['s1']} AS s1 FROM {_PREV}" for k, c in _LEVELS.items()))
def _(v):
    sets = B.pivots(*(F.col(c) for c in "hlco"))
    rows = F.array(*(F.struct(F.lit(k).alias("kind"), *(s[x].alias(x) for x in ("p", "r1", "s1"))) for k, s in sets.items()))
    return _previous(v).select("series_id", "t", F.inline(rows))


_GAP = "SELECT *, t - lag(t) OVER (PARTITION BY series_id ORDER BY t) AS d FROM bars"


@query("data_health_gap_report", f"""-- floats: gap_pct
SELECT *, 100 * missing / (missing + n - 1) AS gap_pct FROM (SELECT series_id, count(*) AS n, CAST(sum(CASE WHEN d > 5400 THEN 1 ELSE 0 END) AS BIGINT) AS gaps, CAST(sum(CASE WHEN d > 5400 THEN greatest(d // 3600 - 1, 0) ELSE 0 END) AS BIGINT) AS missing, max(d) AS largest_step FROM ({_GAP}) GROUP BY ALL)""")
def _(v):
    return H.gap_report(v.bars, 3600)


@query("data_health_gap_list", f"SELECT series_id, t - d AS gap_start, t AS gap_end, greatest(d // 3600 - 1, 0) AS missing FROM ({_GAP}) WHERE d > 5400")
def _(v):
    return H.gaps(v.bars, 3600)


_NOW = 1706659200  # 2024-01-31

for _name, _limit in (("data_health_freshness_gate", 3600), ("data_age_check", 7 * 86400), ("symbol_freshness_report", 2 * 3600)):

    @query(_name, f"SELECT *, age <= {_limit} AS fresh FROM (SELECT series_id, max(t) AS last, greatest({_NOW} - max(t), 0) AS age FROM bars GROUP BY ALL)")
    def _(v, limit=_limit):
        return H.freshness(v.bars, F.lit(_NOW).cast("long"), limit)


@query("data_health_monotonicity", """SELECT series_id, seq AS arrival, prev, t, total FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY seq) AS nth, count(*) OVER (PARTITION BY series_id) AS total FROM (SELECT series_id, seq, epoch // 600 AS t, lag(epoch // 600) OVER (PARTITION BY series_id ORDER BY seq) AS prev FROM ticks) WHERE t <= prev) WHERE nth <= 10""")
def _(v):
    return H.not_increasing(v.ticks.withColumn("t", F.floor(F.col("epoch") / 600)), "seq")


for _name, _hours in (("data_health_bar_count_check", 1.0), ("data_bar_density", 0.7)):

    @query(_name, f"""-- floats: expected coverage_pct
SELECT *, CASE WHEN coverage_pct >= 99 THEN 'complete' WHEN coverage_pct >= 95 THEN 'good' WHEN coverage_pct >= 80 THEN 'patchy' ELSE 'sparse' END AS band FROM (SELECT *, 100 * n / expected AS coverage_pct FROM (
SELECT series_id, count(*) AS n, min(t) AS start, max(t) AS "end", greatest(((max(t) - min(t)) / 3600 + 1) * {_hours}, 1.0) AS expected FROM bars GROUP BY ALL))""")
    def _(v, hours=_hours):
        return H.bar_counts(v.bars, 3600, hours)


@query("workflow_data_health_check", f"""-- floats: gap_pct coverage_pct
SELECT series_id, gaps, 100 * missing / (missing + n - 1) AS gap_pct, 100 * n / ((z - a) / 3600 + 1) AS coverage_pct, {_NOW} - z <= 86400 AS fresh, CASE WHEN {_NOW} - z > 86400 THEN 'stale' WHEN 100 * n / ((z - a) / 3600 + 1) < 80 THEN 'sparse' WHEN gaps > 0 THEN 'gaps' ELSE 'ok' END AS verdict
FROM (SELECT series_id, count(*) AS n, min(t) AS a, max(t) AS z, CAST(sum(CASE WHEN d > 5400 THEN 1 ELSE 0 END) AS BIGINT) AS gaps, CAST(sum(CASE WHEN d > 5400 THEN greatest(d // 3600 - 1, 0) ELSE 0 END) AS BIGINT) AS missing FROM ({_GAP}) GROUP BY ALL)""")
def _(v):
    out = H.gap_report(v.bars, 3600).join(H.freshness(v.bars, F.lit(_NOW).cast("long"), 86400), "series_id").join(H.bar_counts(v.bars, 3600).drop("n"), "series_id")
    verdict = F.when(~F.col("fresh"), "stale").when(F.col("coverage_pct") < 80, "sparse").when(F.col("gaps") > 0, "gaps").otherwise("ok")
    return out.select("series_id", "gaps", "gap_pct", "coverage_pct", "fresh", verdict.alias("verdict"))


_COVER = """(SELECT series_id, min(t) AS date_from, max(t) AS date_to FROM bars GROUP BY ALL)"""

for _name, _shift in (("data_coverage_check", 3600), ("symbol_coverage_gaps", 86400)):

    @query(_name, f"""SELECT * FROM (SELECT r.series_id, CASE WHEN a.date_from IS NULL THEN 'NO_DATA' WHEN r.date_from < a.date_from THEN 'REQUESTED_BEFORE_AVAILABLE' WHEN r.date_to > a.date_to THEN 'REQUESTED_AFTER_AVAILABLE' END AS issue FROM (
SELECT series_id || CASE WHEN series_id = 'view' THEN 'x' ELSE '' END AS series_id, CASE WHEN series_id = 'click' THEN date_from - {_shift} ELSE date_from END AS date_from, CASE WHEN series_id = 'error' THEN date_to + {_shift} ELSE date_to END AS date_to FROM {_COVER}) r LEFT JOIN {_COVER} a USING (series_id)) WHERE issue IS NOT NULL""")
    def _(v, shift=_shift):
        have = v.bars.groupBy("series_id").agg(F.min("t").alias("date_from"), F.max("t").alias("date_to"))
        s = F.col("series_id")
        asked = have.select(
            F.when(s == "view", F.concat(s, F.lit("x"))).otherwise(s).alias("series_id"), F.when(s == "click", F.col("date_from") - shift).otherwise(F.col("date_from")).alias("date_from"), F.when(s == "error", F.col("date_to") + shift).otherwise(F.col("date_to")).alias("date_to")
        )
        return H.coverage_gaps(asked, have, ["series_id"])


@query("broker_data_integrity", """SELECT symbol, timeframe, CASE WHEN r.k IS NULL THEN 'disk_only' WHEN d.k IS NULL THEN 'registry_only' ELSE 'matched' END AS status FROM (SELECT DISTINCT symbol, timeframe, 1 AS k FROM strategies WHERE project <> 'p0') d FULL JOIN (SELECT DISTINCT symbol, timeframe, 1 AS k FROM strategies WHERE databank <> 'd1') r USING (symbol, timeframe)""")
def _(v):
    return H.integrity(v.strategies.filter("project <> 'p0'"), v.strategies.filter("databank <> 'd1'"), ["symbol", "timeframe"])


@query("data_workspace_quality_report", """SELECT issue, count(*) AS n FROM (SELECT unnest([CASE WHEN r.n IS NULL THEN 'orphan' END, CASE WHEN d.n < 3 THEN 'thin' END, CASE WHEN d.n IS NULL THEN 'no_data' END]) AS issue FROM (SELECT symbol, timeframe, count(*) AS n FROM strategies WHERE project <> 'p0' GROUP BY ALL) d FULL JOIN (SELECT symbol, timeframe, count(*) AS n FROM strategies WHERE databank <> 'd1' GROUP BY ALL) r USING (symbol, timeframe)) WHERE issue IS NOT NULL GROUP BY ALL""")
def _(v):
    keys = ["symbol", "timeframe"]
    d = v.strategies.filter("project <> 'p0'").groupBy(*keys).agg(F.count(F.lit(1)).alias("d"))
    r = v.strategies.filter("databank <> 'd1'").groupBy(*keys).agg(F.count(F.lit(1)).alias("r"))
    issues = F.array(F.when(F.col("r").isNull(), "orphan"), F.when(F.col("d") < 3, "thin"), F.when(F.col("d").isNull(), "no_data"))
    return d.join(r, keys, "full_outer").select(F.explode(issues).alias("issue")).filter("issue is not null").groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


_TF = ["H1", "H4", "D1"]
@query("symbol_timeframe_matrix", f"""SELECT symbol, {', '.join(f"count(*) FILTER (timeframe = '{t}') AS {t}" for t in _TF)}, concat_ws(',', {', '.join(f"CASE WHEN count(*) FILTER (timeframe = '{t}') = 0 THEN '{t}' END" for t in _TF)}) AS missing FROM strategies GROUP BY symbol""")
def _(v):
    return H.presence_matrix(v.strategies, _TF)


@query("history_data_summary", '-- floats: high low\nSELECT series_id, count(*) AS n, min(t) AS first_t, max(t) AS last_t, (max(t) - min(t)) // 3600 + 1 AS expected, max(high) AS high, min(low) AS low FROM bars GROUP BY series_id')
def _(v):
    """What the history of each series holds: bars, ends, bars that a gapless one would have, extremes."""
    return H.history_summary(v.bars, 3600)


@query("data_dat_header_diff", """SELECT series_id, n_new, last_new, n_old, last_old, n_new - n_old AS appended FROM (SELECT series_id, count(*) AS n_new, max(t) AS last_new, count(*) FILTER (t < 1705276800) AS n_old, max(t) FILTER (t < 1705276800) AS last_old FROM bars GROUP BY ALL)""")
def _(v):
    return H.version_diff(v.bars.filter("t < 1705276800"), v.bars)


@query("data_update", """SELECT series_id, count(*) AS appended FROM bars WHERE t >= 1705276800 GROUP BY ALL""")
def _(v):
    """Incremental append: rows of the new delivery that the table does not hold."""
    return v.bars.join(v.bars.filter("t < 1705276800").select("series_id", "t"), ["series_id", "t"], "left_anti").groupBy("series_id").agg(F.count(F.lit(1)).alias("appended"))
