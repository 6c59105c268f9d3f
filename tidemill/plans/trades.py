"""Registered queries: trade lists."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.common import bands, bands_sql, halves_up
from ..operators import bars as B
from ..operators import risk as R
from ..operators import trades as T
from .registry import query

_M = "n net gross_profit gross_loss win_rate profit_factor mean_pnl max_drawdown"
_FM = "net gross_profit gross_loss win_rate profit_factor mean_pnl max_drawdown"


def metrics_sql(src: str, keys: str = "strategy_id", order: str = "seq", floor: bool = True) -> str:
    peak = "max(eq) OVER w"
    peak = f"greatest({peak}, 0)" if floor else peak
    return f"""SELECT {keys}, count(*) AS n, sum(pnl) AS net, sum(greatest(pnl, 0)) AS gross_profit, sum(greatest(-pnl, 0)) AS gross_loss, avg(CASE WHEN pnl > 0 THEN 1.0 ELSE 0 END) AS win_rate, sum(greatest(pnl, 0)) / nullif(sum(greatest(-pnl, 0)), 0) AS profit_factor, avg(pnl) AS mean_pnl, max(dd) AS max_drawdown
FROM (SELECT *, {peak} - eq AS dd FROM (SELECT *, sum(pnl) OVER (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS eq FROM {src}) WINDOW w AS (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING)) GROUP BY {keys}"""


for _name, _c, _s in (("cost_apply_to_trades", 1.5, 0.25), ("trade_replay_apply_costs", 2.0, 1.0)):

    @query(_name, f"-- floats: pnl\nSELECT strategy_id, seq, pnl - ({_c} + {_s} * 2.0) AS pnl FROM trades")
    def _(v, c=_c, s=_s):
        return T.with_costs(v.trades, c, s, 2.0).select("strategy_id", "seq", "pnl")


@query("cost_recompute_metrics", f"""-- floats: {_FM} net_after drawdown_after reduction
SELECT a.*, b.net AS net_after, b.max_drawdown AS drawdown_after, a.net - b.net AS reduction, b.net > 0 AS survives FROM ({metrics_sql('trades')}) a JOIN ({metrics_sql('(SELECT strategy_id, seq, pnl - 2.0 AS pnl FROM trades)')}) b USING (strategy_id)""", digits=4)
def _(v):
    after = T.metrics(T.with_costs(v.trades, 1.5, 0.5)).select("strategy_id", F.col("net").alias("net_after"), F.col("max_drawdown").alias("drawdown_after"))
    return T.metrics(v.trades).join(after, "strategy_id").withColumns({"reduction": F.col("net") - F.col("net_after"), "survives": F.col("net_after") > 0})


@query("cost_break_even_per_trade", "-- floats: break_even\nSELECT strategy_id, greatest(avg(pnl), 0) AS break_even FROM trades GROUP BY ALL")
def _(v):
    return v.trades.groupBy("strategy_id").agg(F.greatest(F.avg("pnl"), F.lit(0.0)).alias("break_even"))


@query("cost_sensitivity_grid", "-- floats: commission slippage net\nSELECT strategy_id, c AS commission, s AS slippage, round(sum(pnl) - count(*) * (c + s), 6) + 0.0 AS net, round(sum(pnl) - count(*) * (c + s), 6) > 0 AS survives FROM trades, (SELECT unnest([0.0::DOUBLE, 1.0, 2.0]) AS c), (SELECT unnest([0.0::DOUBLE, 0.5, 5.0]) AS s) GROUP BY strategy_id, c, s", digits=4)
def _(v):
    return T.cost_grid(v.trades, [0.0, 1.0, 2.0], [0.0, 0.5, 5.0])


_FOLD = """SELECT strategy_id, n.seq, n.pnl * size AS pnl, size FROM (WITH RECURSIVE n AS (SELECT *, row_number() OVER (PARTITION BY strategy_id ORDER BY seq) AS i FROM trades), f AS (SELECT strategy_id, 1::BIGINT AS i, 10000.0::DOUBLE AS eq FROM n WHERE i = 1
UNION ALL SELECT f.strategy_id, f.i + 1, f.eq + n.pnl * greatest(0, f.eq * {share}) FROM f JOIN n ON n.strategy_id = f.strategy_id AND n.i = f.i) SELECT n.strategy_id, n.seq, n.pnl, greatest(0, f.eq * {share}) AS size FROM n JOIN f USING (strategy_id, i)) n"""


@query("trade_replay_position_sizing", f"-- floats: {_FM}\n" + metrics_sql(f"({_FOLD.format(share=0.0001)})"), digits=3)
def _(v):
    return T.metrics(T.sized(v.trades, "fixed_fractional", fraction=0.0001))


@query("trade_replay_position_sizing_percent_risk", f"-- floats: {_FM}\n" + metrics_sql(f"({_FOLD.format(share=1.0 / 100 / 1000)})"), digits=3)
def _(v):
    return T.metrics(T.sized(v.trades, "percent_risk", risk=1000.0))


_CAPPED = """(SELECT strategy_id, seq, x2 AS pnl FROM (WITH RECURSIVE n AS (SELECT strategy_id, seq, pnl, row_number() OVER (PARTITION BY strategy_id ORDER BY seq) AS i FROM trades),
f AS (SELECT strategy_id, 0::BIGINT AS i, 0::BIGINT AS seq, 0.0::DOUBLE AS x2, 0.0::DOUBLE AS day, 0.0::DOUBLE AS week, 0 AS k, 0 AS days FROM n GROUP BY strategy_id
UNION ALL SELECT strategy_id, i, seq, x2, CASE WHEN k = 2 THEN 0.0 ELSE greatest(0.0, day - x2) END, CASE WHEN k = 2 AND days = 4 THEN 0.0 ELSE greatest(0.0, week - x2) END, CASE WHEN k = 2 THEN 0 ELSE k + 1 END, CASE WHEN k = 2 THEN (days + 1) % 5 ELSE days END
FROM (SELECT *, CASE WHEN x1 < 0 AND week - x1 > 150 THEN 0.0 ELSE x1 END AS x2 FROM (SELECT *, CASE WHEN x0 < 0 AND day - x0 > 60 THEN 0.0 ELSE x0 END AS x1 FROM (SELECT n.strategy_id, n.i, n.seq, greatest(n.pnl, -40.0) AS x0, f.day, f.week, f.k, f.days FROM f JOIN n ON n.strategy_id = f.strategy_id AND n.i = f.i + 1)))) SELECT * FROM f WHERE i > 0))"""


@query("trade_replay_risk_caps", f"-- floats: {_FM}\nSELECT m.*, n_capped, n_skipped, n_days, n_weeks FROM ({metrics_sql(_CAPPED, floor=False)}) m JOIN (SELECT c.strategy_id, count(*) FILTER (t.pnl < -40) AS n_capped, count(*) FILTER (t.pnl <> 0 AND c.pnl = 0) AS n_skipped, count(*) // 3 AS n_days, count(*) // 15 AS n_weeks FROM {_CAPPED} c JOIN trades t ON t.strategy_id = c.strategy_id AND t.seq = c.seq GROUP BY c.strategy_id) n ON n.strategy_id = m.strategy_id", digits=4)
def _(v):
    capped = T.risk_capped(v.trades, 40.0, 60.0, 150.0, 3)
    return T.metrics(capped, floor=None).join(T.cap_counts(capped, 3), "strategy_id")


@query("trade_replay_filter_by_regime", f"-- floats: {_FM}\n" + metrics_sql("(SELECT * FROM trades WHERE symbol NOT IN ('error', 'view'))"), digits=4)
def _(v):
    return T.metrics(v.trades.filter(~F.col("symbol").isin("error", "view")))


@query("trade_replay_compare_to_original", f"""-- floats: d_net d_win_rate d_drawdown
SELECT strategy_id, b.net - a.net AS d_net, b.win_rate - a.win_rate AS d_win_rate, b.max_drawdown - a.max_drawdown AS d_drawdown FROM ({metrics_sql('trades', floor=False)}) a JOIN ({metrics_sql('(SELECT strategy_id, seq, pnl - 3.0 AS pnl FROM trades)', floor=False)}) b USING (strategy_id)""", digits=4)
def _(v):
    a, b = T.metrics(v.trades, floor=None), T.metrics(T.with_costs(v.trades, 3.0, 0.0), floor=None)
    d = lambda c: (F.col(f"b.{c}") - F.col(f"a.{c}"))
    return a.alias("a").join(b.alias("b"), "strategy_id").select("strategy_id", d("net").alias("d_net"), d("win_rate").alias("d_win_rate"), d("max_drawdown").alias("d_drawdown"))


_SLIP = "(SELECT strategy_id, seq, CASE WHEN pnl > 0 THEN pnl * 0.98 WHEN pnl < 0 THEN pnl * 1.02 ELSE pnl END AS pnl, seq AS place FROM trades)"
_BEST = "(SELECT strategy_id, seq, pnl, seq AS place FROM (SELECT *, row_number() OVER (PARTITION BY strategy_id ORDER BY pnl DESC, seq) AS i FROM trades) WHERE i > 5)"
_WORST = "(SELECT strategy_id, seq, pnl, CASE WHEN i <= 10 THEN i - 11 ELSE seq END AS place FROM (SELECT *, row_number() OVER (PARTITION BY strategy_id ORDER BY pnl, seq) AS i FROM trades))"


@query("stress_apply_slippage", f"-- floats: {_FM}\n" + metrics_sql(_SLIP), digits=4)
def _(v):
    return T.metrics(v.trades.withColumn("pnl", T.slipped(F.col("pnl"), 2.0)))


@query("stress_apply_skip_best", f"-- floats: {_FM}\n" + metrics_sql(_BEST), digits=4)
def _(v):
    return T.metrics(T.without_best(v.trades, 5))


_SKIP = "(SELECT strategy_id, seq, pnl, seq AS place FROM trades WHERE CAST('0x' || left(md5(concat_ws(':', 42, strategy_id, seq)), 8) AS BIGINT) % 1000000 / 1000000 >= 0.05)"


@query("stress_apply_random_skip", f"-- floats: {_FM}\n" + metrics_sql(_SKIP), digits=4)
def _(v):
    """Rows go by a hash of their keys."""
    return T.metrics(T.randomly_skipped(v.trades, 0.05))


@query("stress_worst_case_dd", f"-- floats: {_FM}\n" + metrics_sql(_WORST, order="place"), digits=4)
def _(v):
    return T.metrics(T.worst_first(v.trades, 10), order="place")


STRESS_SQL = "SELECT *, CASE WHEN killed >= 3 THEN 'fragile' WHEN killed >= 1 THEN 'moderate' ELSE 'robust' END AS verdict FROM (SELECT strategy_id, count(*) FILTER (net <= 0) AS killed FROM (" + " UNION ALL ".join(f"SELECT strategy_id, sum(pnl) AS net FROM {x} GROUP BY strategy_id" for x in (_SLIP, _BEST, _SKIP, _WORST)) + ") GROUP BY strategy_id)"


@query("stress_combined_scenarios", STRESS_SQL)
def _(v):
    return T.stress_verdict(T.stress(v.trades))


_GINI = "(SELECT {key}, greatest(0, least(1, 2 * sum(i * a) / nullif(count(*) * sum(a), 0) - (count(*) + 1) / count(*))) AS gini FROM (SELECT {key}, abs({val}) AS a, row_number() OVER (PARTITION BY {key} ORDER BY abs({val})) AS i FROM {src}) GROUP BY {key})"


def _top(n: str, name: str, src: str = "trades", key: str = "strategy_id", val: str = "pnl") -> str:
    return f"(SELECT {key}, coalesce(100 * sum(CASE WHEN i <= {n} THEN greatest({val}, 0) END) / nullif(sum(greatest({val}, 0)), 0), 0) AS {name} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {val} DESC) AS i, count(*) OVER (PARTITION BY {key}) AS n FROM {src}) GROUP BY {key})"


BRITTLE_SQL = f"""SELECT *, CASE WHEN top10 >= 80 THEN 'very_brittle' WHEN top10 >= 60 THEN 'brittle' WHEN gini > 0.7 THEN 'skewed' ELSE 'robust' END AS verdict FROM {_GINI.format(key='strategy_id', val='pnl', src='trades')} JOIN {_top('greatest(1, n // 20)', 'top5')} USING (strategy_id) JOIN {_top('greatest(1, n // 10)', 'top10')} USING (strategy_id)"""


@query("brittle_score_from_trades", f"-- floats: gini top5 top10\n{BRITTLE_SQL}")
def _(v):
    return T.brittle(v.trades)


_DELTA = "(SELECT series_id, bucket, arg_max(v, idx) - arg_min(v, idx) AS d FROM (SELECT *, least((row_number() OVER (PARTITION BY series_id ORDER BY idx) - 1) // (count(*) OVER (PARTITION BY series_id) // 20), 19) AS bucket FROM series) GROUP BY ALL)"


@query("brittle_curve_concentration", f"""-- floats: gini top
SELECT *, CASE WHEN top >= 80 THEN 'very_brittle' WHEN top >= 60 THEN 'brittle' WHEN gini > 0.6 THEN 'skewed' ELSE 'robust' END AS verdict FROM {_GINI.format(key='series_id', val='d', src=_DELTA)} JOIN {_top('4', 'top', _DELTA, 'series_id', 'd')} USING (series_id)""")
def _(v):
    size = F.floor(F.count(F.lit(1)).over(Window.partitionBy("series_id")) / 20)
    b = F.least(F.floor((F.row_number().over(Window.partitionBy("series_id").orderBy("idx")) - 1) / size), F.lit(19))
    d = v.series.withColumn("bucket", b).groupBy("series_id", "bucket").agg((F.max_by("v", "idx") - F.min_by("v", "idx")).alias("d"))
    g = T.gini(d, "d", "series_id").join(T.top_share(d, "d", "series_id", F.lit(4), "top"), "series_id")
    return g.withColumn("verdict", F.when(F.col("top") >= 80, "very_brittle").when(F.col("top") >= 60, "brittle").when(F.col("gini") > 0.6, "skewed").otherwise("robust"))


@query("brittle_top_trades_share", f"-- floats: share_pct\nSELECT * FROM {_top('5', 'share_pct')}")
def _(v):
    return T.top_share(v.trades, "pnl", "strategy_id", F.lit(5), "share_pct")


@query("brittle_consecutive_loss_streak", """SELECT t.strategy_id, coalesce(l, 0) AS longest_loss, coalesce(w, 0) AS longest_win, CASE WHEN coalesce(l, 0) / n > 0.1 THEN 'brittle' WHEN coalesce(l, 0) / n > 0.05 THEN 'moderate' ELSE 'robust' END AS verdict FROM (SELECT strategy_id, count(*) AS n FROM trades GROUP BY ALL) t LEFT JOIN (
SELECT strategy_id, max(c) FILTER (k < 0) AS l, max(c) FILTER (k > 0) AS w FROM (SELECT strategy_id, k, g, count(*) AS c FROM (SELECT strategy_id, sign(pnl) AS k, row_number() OVER (PARTITION BY strategy_id ORDER BY seq) - row_number() OVER (PARTITION BY strategy_id, sign(pnl) ORDER BY seq) AS g FROM trades) WHERE k <> 0 GROUP BY ALL) GROUP BY strategy_id) USING (strategy_id)""")
def _(v):
    runs = R.longest_runs(v.trades, F.when(F.col("pnl") < 0, "loss").when(F.col("pnl") > 0, "win"), "strategy_id", "seq").groupBy("strategy_id").pivot("kind", ["loss", "win"]).agg(F.max("longest"))
    g = v.trades.groupBy("strategy_id").agg(F.count(F.lit(1)).alias("n")).join(runs, "strategy_id", "left").fillna(0, ["loss", "win"])
    return g.select("strategy_id", F.col("loss").alias("longest_loss"), F.col("win").alias("longest_win"), bands(F.col("loss") / F.col("n"), [(">", 0.1, "brittle"), (">", 0.05, "moderate")], "robust").alias("verdict"))


for _name, _part, _part_sql, _every in (
    ("hour", lambda: F.hour("closed_at"), "hour(closed_at)", list(range(24))), ("dayofweek", lambda: F.weekday("closed_at"), "isodow(closed_at) - 1", list(range(7))),
    ("month", lambda: F.month("closed_at"), "month(closed_at)", list(range(1, 13))), ("quarter", lambda: F.quarter("closed_at"), "quarter(closed_at)", list(range(1, 5))),
):

    @query(f"calendar_by_{_name}", f"""-- floats: total best worst mean win_rate
SELECT CAST(r.k AS INT) AS {_name}, coalesce(n, 0) AS n, coalesce(wins, 0) AS wins, coalesce(total, 0) AS total, best, worst, mean, wins / n AS win_rate FROM (SELECT unnest({_every}) AS k) r LEFT JOIN (SELECT {_part_sql} AS k, count(*) AS n, count(*) FILTER (pnl > 0) AS wins, sum(pnl) AS total, max(pnl) AS best, min(pnl) AS worst, avg(pnl) AS mean FROM trades GROUP BY ALL) USING (k)""")
    def _(v, name=_name, part=_part, every=_every):
        return T.calendar(v.trades, part(), every, name)


@query("calendar_session_split", """-- floats: total mean win_rate
SELECT CASE WHEN h >= 7 AND h < 12 THEN 'morning' WHEN h >= 10 AND h < 16 THEN 'midday' WHEN h >= 22 OR h < 4 THEN 'night' ELSE 'uncategorized' END AS session, count(*) AS n, count(*) FILTER (pnl > 0) AS wins, sum(pnl) AS total, avg(pnl) AS mean, avg(CASE WHEN pnl > 0 THEN 1.0 ELSE 0 END) AS win_rate FROM (SELECT *, hour(closed_at) AS h FROM trades) GROUP BY ALL""")
def _(v):
    h, session = F.hour("closed_at"), F.lit("uncategorized")
    for name, a, b in reversed([("morning", 7, 12), ("midday", 10, 16), ("night", 22, 4)]):  # the first that matches wins
        session = F.when(B.in_hours(h, F.lit(a), F.lit(b)), name).otherwise(session)
    return T.by_group(v.trades.withColumn("session", session), "session")


_BY = "count(*) AS n, count(*) FILTER (pnl > 0) AS wins, sum(pnl) AS total, avg(pnl) AS mean, avg(CASE WHEN pnl > 0 THEN 1.0 ELSE 0 END) AS win_rate"


@query("regime_pnl_split", f"-- floats: total mean win_rate\nSELECT symbol, {_BY} FROM trades GROUP BY symbol")
def _(v):
    return T.by_group(v.trades, "symbol")


@query("regime_recommend_filter", f"-- floats: mean\nSELECT symbol, mean, rank() OVER (ORDER BY mean DESC) AS place, mean >= 0 AS keep FROM (SELECT symbol, {_BY} FROM trades GROUP BY symbol)")
def _(v):
    g = T.by_group(v.trades, "symbol")
    return g.select("symbol", "mean", F.rank().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("mean"))).cast("long").alias("place"), (F.col("mean") >= 0).alias("keep"))  # a row a regime


_LIVE = "(SELECT *, closed_at >= TIMESTAMP '2024-01-20' AS live FROM trades)"
_DRIFT = f"""(WITH t AS {_LIVE}, m AS ({metrics_sql('t', 'strategy_id, live')}), g AS (SELECT strategy_id, count(*) FILTER (live) AS n_live, avg(CASE WHEN live THEN CASE WHEN pnl > 0 THEN 1.0 ELSE 0 END END) AS live_win, avg(CASE WHEN NOT live THEN CASE WHEN pnl > 0 THEN 1.0 ELSE 0 END END) AS back_win, avg(pnl) FILTER (live) AS live_mean, avg(pnl) FILTER (NOT live) AS back_mean, stddev_samp(pnl) FILTER (NOT live) AS back_std FROM t GROUP BY strategy_id),
d AS (SELECT strategy_id, max(max_drawdown) FILTER (live) AS live_dd, max(max_drawdown) FILTER (NOT live) AS back_dd FROM m GROUP BY strategy_id),
x AS (SELECT *, greatest(0, (live_win + 3.8416 / (2 * n_live) - 1.96 * sqrt((live_win * (1 - live_win) + 3.8416 / (4 * n_live)) / n_live)) / (1 + 3.8416 / n_live)) AS ci_low, least(1, (live_win + 3.8416 / (2 * n_live) + 1.96 * sqrt((live_win * (1 - live_win) + 3.8416 / (4 * n_live)) / n_live)) / (1 + 3.8416 / n_live)) AS ci_high,
coalesce((live_mean - back_mean) / nullif(back_std / sqrt(n_live), 0), 0) AS z, live_dd - back_dd AS dd_excess FROM g JOIN d USING (strategy_id)),
y AS (SELECT *, CASE WHEN n_live < 20 THEN 'insufficient_sample' WHEN back_win < ci_low OR back_win > ci_high THEN 'drift_detected' ELSE 'within_band' END AS win_verdict, CASE WHEN n_live < 20 THEN 'insufficient_sample' WHEN abs(z) > 2 THEN 'drift_detected' ELSE 'within_band' END AS mean_verdict, CASE WHEN dd_excess > 5 THEN 'drift_detected' ELSE 'within_band' END AS dd_verdict FROM x),
q AS (SELECT *, CAST(win_verdict = 'drift_detected' AS INT) + CAST(mean_verdict = 'drift_detected' AS INT) + CAST(dd_verdict = 'drift_detected' AS INT) AS drifts FROM y)
SELECT *, CASE WHEN n_live < 20 THEN 'insufficient_sample' WHEN drifts >= 2 THEN 'red' WHEN drifts >= 1 THEN 'yellow' ELSE 'green' END AS light FROM q)"""


for _name, _cols, _floats in (
    ("drift_compare_win_rate", ["strategy_id", "n_live", "live_win", "back_win", "ci_low", "ci_high", "win_verdict"], "live_win back_win ci_low ci_high"), ("drift_compare_average_trade", ["strategy_id", "live_mean", "back_mean", "z", "mean_verdict"], "live_mean back_mean z"),
    ("drift_compare_drawdown", ["strategy_id", "live_dd", "back_dd", "dd_excess", "dd_verdict"], "live_dd back_dd dd_excess"), ("drift_score_overall", ["strategy_id", "drifts", "light"], ""),
):

    @query(_name, (f"-- floats: {_floats}\n" if _floats else "") + f"SELECT {', '.join(_cols)} FROM {_DRIFT}")
    def _(v, cols=_cols):
        return T.drift(v.trades, F.col("closed_at") >= F.lit("2024-01-20").cast("timestamp")).select(*cols)


@query("drift_compare_distributions", f"""-- floats: ks critical
SELECT symbol, max(abs(fa / na - fb / nb)) AS ks, max(na) AS na, max(nb) AS nb, 1.36 * sqrt((max(na) + max(nb)) / (max(na) * max(nb))) AS critical, max(abs(fa / na - fb / nb)) > 1.36 * sqrt((max(na) + max(nb)) / (max(na) * max(nb))) AS drift FROM (
SELECT symbol, CAST(sum(a) OVER w AS DOUBLE) AS fa, CAST(sum(b) OVER w AS DOUBLE) AS fb, CAST(sum(a) OVER (PARTITION BY symbol) AS BIGINT) AS na, CAST(sum(b) OVER (PARTITION BY symbol) AS BIGINT) AS nb FROM (SELECT symbol, pnl, count(*) FILTER (live) AS a, count(*) FILTER (NOT live) AS b FROM {_LIVE} GROUP BY symbol, pnl) WINDOW w AS (PARTITION BY symbol ORDER BY pnl ROWS UNBOUNDED PRECEDING)) GROUP BY symbol""")
def _(v):
    t = v.trades.withColumn("live", F.col("closed_at") >= F.lit("2024-01-20").cast("timestamp"))
    return T.ks_distance(t, "pnl", "live", "symbol").withColumn("drift", F.col("ks") > F.col("critical"))


@query("report_compare_with_catalogue", f"""-- floats: a b diff
SELECT strategy_id, metric, {halves_up('a')} AS a, {halves_up('b')} AS b, {halves_up('abs(a - b) / nullif(abs(b), 0)')} AS diff, CASE WHEN a IS NULL OR b IS NULL THEN 'missing' WHEN round(abs(a - b) / nullif(abs(b), 0), 9) > 0.1 THEN 'warn' ELSE 'ok' END AS verdict FROM (UNPIVOT (SELECT strategy_id, round(sum(pnl), 6) AS net, round(sum(pnl), 6) / count(pnl) AS mean, max(pnl) AS best FROM trades WHERE side = 'long' GROUP BY strategy_id) ON net, mean, best INTO NAME metric VALUE a) FULL JOIN (UNPIVOT (SELECT strategy_id, round(sum(pnl), 6) AS net, round(sum(pnl), 6) / count(pnl) AS mean, min(pnl) AS worst FROM trades WHERE side = 'short' GROUP BY strategy_id) ON net, mean, worst INTO NAME metric VALUE b) USING (strategy_id, metric)""")
def _(v):
    """Two reports of one strategy, metric by metric. Sums to a millionth and the difference to 9 digits, so that the order of a sum decides no verdict."""
    p = F.col("pnl")
    net = F.round(F.sum(p), 6)
    means = net.alias("net"), (net / F.nullif(F.count(p), F.lit(0))).alias("mean")
    a = v.trades.filter("side = 'long'").groupBy("strategy_id").agg(*means, F.max(p).alias("best")).unpivot("strategy_id", ["net", "mean", "best"], "metric", "a")
    b = v.trades.filter("side = 'short'").groupBy("strategy_id").agg(*means, F.min(p).alias("worst")).unpivot("strategy_id", ["net", "mean", "worst"], "metric", "b")
    diff = F.abs(F.col("a") - F.col("b")) / F.nullif(F.abs("b"), F.lit(0.0))
    out = a.join(b, ["strategy_id", "metric"], "full_outer").withColumn("diff", diff).withColumn("verdict", F.when(F.col("a").isNull() | F.col("b").isNull(), "missing").when(F.round("diff", 9) > 0.1, "warn").otherwise("ok"))
    return out.withColumns({c: F.round(c, 10) for c in ("a", "b", "diff")})
