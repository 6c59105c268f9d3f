"""Registered queries: strategy catalogues and portfolios."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.common import bands, bands_sql, ratio
from ..operators import catalog as C
from .indicators import _returns
from .registry import query

_S = """(SELECT *, fitness_oos / nullif(fitness_is, 0) AS oos_is, net_profit / nullif(drawdown_abs, 0) AS profit_to_dd, net_profit / nullif(trades, 0) AS avg_trade, history_days / 365.25 AS years, trades / nullif(history_days / 365.25, 0) AS trades_per_year FROM strategies)"""
_SCORE = "coalesce(nullif(fitness_oos, 0), nullif(fitness_full, 0), fitness_is) * coalesce(greatest(0.1, least(1.0, oos_is * 2)), 1.0) * CASE WHEN drawdown_pct > 25 THEN 25 / drawdown_pct ELSE 1.0 END * CASE WHEN trades < 100 THEN greatest(0.1, trades / 100) ELSE 1.0 END"
_SCORED = f"(SELECT *, {_SCORE} AS score FROM {_S})"


def cat(v):
    return C.derive(v.strategies)


_LIMITS = [("trades", "min", 50), ("trades", "max", 100000), ("net_profit", "min", -20000.0), ("drawdown_pct", "max", 60.0), ("profit_to_dd", "min", -8.0), ("fitness_is", "min", 0.45), ("fitness_oos", "min", 0.45), ("oos_is", "min", 0.9), ("avg_trade", "min", -50.0), ("trades_per_year", "min", 1.0)]
_REASON = "CASE " + " ".join(f"WHEN NOT coalesce({c} {'>=' if k == 'min' else '<='} {x}, {'true' if (c, k) == ('trades', 'max') else 'false'}) THEN '{c}_{k}'" for c, k, x in _LIMITS) + " END"


@query("databank_filter", f"-- floats: fitness_oos\nSELECT strategy_id, fitness_oos, reason FROM (SELECT *, {_REASON} AS reason FROM {_S}) WHERE reason IS NULL ORDER BY fitness_oos DESC, strategy_id LIMIT 50")
def _(v):
    return C.rejections(cat(v), _LIMITS).filter("reason is null").orderBy(F.desc_nulls_last("fitness_oos"), "strategy_id").limit(50).select("strategy_id", "fitness_oos", "reason")


@query("databank_filter_reasons", f"SELECT reason, count(*) AS n FROM (SELECT {_REASON} AS reason FROM {_S}) WHERE reason IS NOT NULL GROUP BY reason")
def _(v):
    return C.rejections(cat(v), _LIMITS).filter("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("databank_top_n", "-- floats: fitness_oos\nSELECT strategy_id, fitness_oos FROM strategies WHERE fitness_oos IS NOT NULL ORDER BY fitness_oos DESC, strategy_id LIMIT 10")
def _(v):
    return v.strategies.filter("fitness_oos is not null").orderBy(F.desc("fitness_oos"), "strategy_id").limit(10).select("strategy_id", "fitness_oos")


@query("databank_partition", "SELECT CASE WHEN fitness_oos IS NULL THEN 'missing' WHEN round(fitness_oos, 9) >= 0.5 THEN 'above' ELSE 'below' END AS bucket, count(*) AS n FROM strategies WHERE trades >= 50 GROUP BY ALL")
def _(v):
    """Fitness to 9 digits, so that the order in which a mean is summed decides no bucket."""
    x = F.round("fitness_oos", 9)
    return v.strategies.filter("trades >= 50").groupBy(F.when(x.isNull(), "missing").when(x >= 0.5, "above").otherwise("below").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("databank_top_bottom", "SELECT project, strategy_id, side, i FROM (SELECT project, strategy_id, 'top' AS side, row_number() OVER (PARTITION BY project ORDER BY fitness_full DESC, strategy_id) AS i FROM strategies UNION ALL SELECT project, strategy_id, 'bottom', row_number() OVER (PARTITION BY project ORDER BY fitness_full, strategy_id) FROM strategies) WHERE i <= 5")
def _(v):
    out = []
    for side, order in (("top", F.desc("fitness_full")), ("bottom", F.asc("fitness_full"))):
        i = F.row_number().over(Window.partitionBy("project").orderBy(order, "strategy_id")).cast("long")
        out.append(v.strategies.select("project", "strategy_id", F.lit(side).alias("side"), i.alias("i")).filter("i <= 5"))
    return out[0].union(out[1])


_MODES = {"defensive": _SCORE, "fitness_oos": "fitness_oos", "fitness_is": "fitness_is", "fitness_full": "fitness_full", "net_profit": "net_profit", "profit_to_dd": "profit_to_dd", "trades": "trades", "drawdown": "-drawdown_abs"}


def _mode(s, mode):
    return C.defensive_score(s) if mode == "defensive" else -F.col("drawdown_abs") if mode == "drawdown" else F.col(mode).cast("double")


for _m, _sql in _MODES.items():

    @query("portfolio_rank" if _m == "defensive" else f"portfolio_rank_{_m}", f"-- floats: score\nSELECT * FROM (SELECT project, strategy_id, CAST({_sql} AS DOUBLE) AS score, row_number() OVER (PARTITION BY project ORDER BY {_sql} DESC NULLS LAST, strategy_id) AS place FROM {_S}) WHERE place <= 20")
    def _(v, mode=_m):
        s = cat(v)
        return C.ranked(s, _mode(s, mode), "project").filter("place <= 20").select("project", "strategy_id", "score", F.col("place").cast("long").alias("place"))


@query("portfolio_select_diverse", f"""SELECT strategy_id, bucket, round FROM (SELECT *, max(score) OVER (PARTITION BY bucket) AS top, row_number() OVER (PARTITION BY bucket ORDER BY score DESC NULLS LAST, strategy_id) AS round FROM (SELECT *, coalesce(trades_hash, '__no_key__') AS bucket FROM {_SCORED})) ORDER BY round, top DESC NULLS LAST, bucket LIMIT 12""")
def _(v):
    s = cat(v)
    return C.diverse(s.withColumn("score", C.defensive_score(s)), F.col("trades_hash"), 12).select("strategy_id", "bucket", F.col("round").cast("long").alias("round"))


@query("workspace_find_strategies", "SELECT strategy_id, project, databank FROM strategies WHERE timeframe = 'H4' AND trades >= 50 AND databank = 'd1' ORDER BY strategy_id LIMIT 500")
def _(v):
    return v.strategies.filter("timeframe = 'H4' and trades >= 50 and databank = 'd1'").orderBy("strategy_id").limit(500).select("strategy_id", "project", "databank")


@query("symbol_overview", "SELECT symbol, count(*) AS strategies, count(DISTINCT project) AS projects, count(DISTINCT timeframe) AS timeframes, CAST(sum(trades) AS BIGINT) AS trades FROM strategies GROUP BY symbol")
def _(v):
    return v.strategies.groupBy("symbol").agg(F.count(F.lit(1)).alias("strategies"), F.count_distinct("project").alias("projects"), F.count_distinct("timeframe").alias("timeframes"), F.sum("trades").alias("trades"))


@query("strategy_history", "SELECT trades_hash, array_to_string(list_sort(list(DISTINCT project || '/' || databank)), ',') AS places, count(*) AS n FROM strategies WHERE trades_hash IS NOT NULL GROUP BY trades_hash")
def _(v):
    place = F.concat_ws("/", "project", "databank")
    return v.strategies.filter("trades_hash is not null").groupBy("trades_hash").agg(F.array_join(F.sort_array(F.collect_set(place)), ",").alias("places"), F.count(F.lit(1)).alias("n"))


_FIND = [("trades < 30", "FEW_TRADES", "high"), ("fitness_oos IS NULL OR fitness_oos = 0", "NO_OOS", "high"), ("oos_is < 0.5", "OVERFIT", "high"), ("profit_to_dd > 20", "TOO_GOOD", "critical"), ("drawdown_pct > 50", "DEEP_DRAWDOWN", "critical"), ("years < 1", "SHORT_HISTORY", "medium"), ("drawdown_abs < 0.01", "NO_DRAWDOWN", "critical"), ("trades_per_year > 5000", "TOO_FREQUENT", "medium"), ("net_profit <= 0", "UNPROFITABLE", "low")]
_FOUND = "(" + " UNION ALL ".join(f"SELECT strategy_id, project, databank, '{c}' AS code, '{s}' AS severity FROM {_S} WHERE {w}" for w, c, s in _FIND) + ")"
_COUNTED = f"(SELECT s.*, coalesce(critical, 0) AS critical, coalesce(high, 0) AS high, coalesce(findings, 0) AS findings FROM {_S} s LEFT JOIN (SELECT strategy_id, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'high') AS high, count(*) AS findings FROM {_FOUND} GROUP BY strategy_id) USING (strategy_id))"


@query("strategy_anomaly_check", f"SELECT strategy_id, code, severity FROM {_FOUND}")
def _(v):
    return C.findings(cat(v))


@query("pre_live_checklist", f"SELECT strategy_id, trades >= 100 AS enough_trades, coalesce(fitness_oos > 0, false) AS has_oos, drawdown_pct <= 30 AS drawdown_ok, coalesce(profit_to_dd >= 1.5, false) AS ratio_ok, critical = 0 AS clean FROM {_COUNTED}")
def _(v):
    no = F.lit(False)
    return C.with_counts(cat(v)).select("strategy_id", (F.col("trades") >= 100).alias("enough_trades"), F.coalesce(F.col("fitness_oos") > 0, no).alias("has_oos"), (F.col("drawdown_pct") <= 30).alias("drawdown_ok"), F.coalesce(F.col("profit_to_dd") >= 1.5, no).alias("ratio_ok"), (F.col("critical") == 0).alias("clean"))


for _n in ("databank_audit_summary", "workspace_audit"):
    _floor = "" if _n == "databank_audit_summary" else " WHERE severity IN ('critical', 'high', 'medium')"

    @query(_n, f"SELECT project, databank, code, severity, count(*) AS n FROM {_FOUND}{_floor} GROUP BY ALL")
    def _(v, floor=_floor):
        f = C.findings(cat(v)).join(v.strategies.select("strategy_id", "project", "databank"), "strategy_id")
        f = f.filter(F.col("severity").isin("critical", "high", "medium")) if floor else f
        return f.groupBy("project", "databank", "code", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("portfolio_audit", f"""-- floals:
SELECT project, array_to_string(list_filter([CASE WHEN avg(CASE WHEN net_profit > 0 THEN 1.0 ELSE 0 END) < 0.2 THEN 'FEW_PROFITABLE' END, CASE WHEN avg(CASE WHEN oos_is < 0.5 THEN 1.0 ELSE 0 END) > 0.3 THEN 'OVERFIT' END, CASE WHEN 1 - count(DISTINCT trades_hash) / count(*) > 0.3 THEN 'DUPLICATES' END, CASE WHEN count(DISTINCT timeframe) = 1 THEN 'ONE_TIMEFRAME' END, CASE WHEN count(*) < 10 THEN 'FEW' END], lambda x: x IS NOT NULL), ',') AS codes FROM {_S} GROUP BY project""".replace("-- floals:\n", ""))
def _(v):
    p = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("double"))
    codes = F.array(
        F.when(p(F.col("net_profit") > 0) < 0.2, "FEW_PROFITABLE"), F.when(p(F.col("oos_is") < 0.5) > 0.3, "OVERFIT"), F.when(1 - F.count_distinct("trades_hash") / F.count(F.lit(1)) > 0.3, "DUPLICATES"), F.when(F.count_distinct("timeframe") == 1, "ONE_TIMEFRAME"), F.when(F.count(F.lit(1)) < 10, "FEW")
    )
    return cat(v).groupBy("project").agg(F.array_join(F.filter(codes, lambda x: x.isNotNull()), ",").alias("codes"))


_Q = "greatest(0, least(100, coalesce(least(30, greatest(0, fitness_oos * 30)), 0) + coalesce(least(25, greatest(0, oos_is / 0.5 * 25)), 0) + coalesce(least(20, greatest(0, 20 * (1 - drawdown_pct / 50))), 0) + least(15, greatest(0, trades / 200 * 15)) + least(10, greatest(0, years / 3 * 10)) - 10 * critical - 5 * high))"
_TIER = [(">=", 75, "excellent"), (">=", 60, "good"), (">=", 40, "marginal")]
_ACT = "CASE WHEN critical > 0 OR coalesce(fitness_oos <= 0, false) THEN 'DROP' WHEN high > 0 OR coalesce(oos_is < 0.4, false) THEN 'TWEAK' WHEN trades < 100 OR drawdown_pct > 25 THEN 'RETEST' WHEN coalesce(fitness_oos > 0.3 AND oos_is >= 0.5, false) THEN 'SHIP' ELSE 'RETEST' END"


@query("strategy_quality_score", f"-- floats: quality\nSELECT *, {bands_sql('quality', _TIER, 'poor')} AS tier FROM (SELECT strategy_id, CAST({_Q} AS DOUBLE) AS quality FROM {_COUNTED})")
def _(v):
    s = C.with_counts(cat(v))
    return s.select("strategy_id", C.quality(s).alias("quality")).withColumn("tier", bands(F.col("quality"), _TIER, "poor"))


@query("strategy_recommendation", f"SELECT strategy_id, {_ACT} AS action FROM {_COUNTED}")
def _(v):
    s = C.with_counts(cat(v))
    return s.select("strategy_id", C.action(s).alias("action"))


@query("strategy_summarize", f"-- floats: quality\nSELECT strategy_id, CAST({_Q} AS DOUBLE) AS quality, {_ACT} AS action, findings FROM {_COUNTED}")
def _(v):
    s = C.with_counts(cat(v))
    return s.select("strategy_id", C.quality(s).alias("quality"), C.action(s).alias("action"), "findings")


_PROF = "(VALUES " + ", ".join(f"('{n}', {a}, {b})" for n, a, b in C.PROFILES) + ") p(profile, cap, least)"
_VIOL = "concat_ws(',', CASE WHEN drawdown_pct > cap THEN 'drawdown' END, CASE WHEN oos_is < least THEN 'oos' END, CASE WHEN trades < 100 THEN 'trades' END)"


def _violations(v):
    """Strategies against the four profiles, a small table beside every row."""
    p = v.spark.createDataFrame(C.PROFILES, "profile string, cap double, least double")
    s = cat(v).crossJoin(F.broadcast(p))
    viol = F.concat_ws(",", F.when(F.col("drawdown_pct") > F.col("cap"), "drawdown"), F.when(F.col("oos_is") < F.col("least"), "oos"), F.when(F.col("trades") < 100, "trades"))
    return s.select("strategy_id", "profile", "cap", viol.alias("violations"))


@query("risk_profile_compare_to_strategy", f"SELECT strategy_id, profile, {_VIOL} AS violations FROM {_S}, {_PROF}")
def _(v):
    return _violations(v).drop("cap")


@query("risk_profile_recommend", f"SELECT strategy_id, arg_min(profile, cap) FILTER ({_VIOL} = '') AS profile FROM {_S}, {_PROF} GROUP BY strategy_id")
def _(v):
    ok = F.col("violations") == ""
    return _violations(v).groupBy("strategy_id").agg(F.min_by(F.when(ok, F.col("profile")), F.when(ok, F.col("cap"))).alias("profile"))


@query("risk_profile_list", f"SELECT profile, count(*) FILTER ({_VIOL} = '') AS fits, count(*) AS n FROM {_S}, {_PROF} GROUP BY profile")
def _(v):
    return _violations(v).groupBy("profile").agg(F.count(F.when(F.col("violations") == "", 1)).alias("fits"), F.count(F.lit(1)).alias("n"))


_PAY = "(UNPIVOT (SELECT strategy_id AS id, CAST(trades AS VARCHAR) AS trades, CAST(round(drawdown_pct) AS VARCHAR) AS drawdown, symbol, trades_hash FROM strategies) ON trades, drawdown, symbol, trades_hash INTO NAME metric VALUE value)"
_RULES = [("few", "trades", "<", "600", "high"), ("deep", "drawdown", ">=", "40", "critical"), ("listed", "symbol", "in", "NATION_1,NATION_2", "info"), ("no_hash", "trades_hash", "missing", "", "medium"), ("has_1", "symbol", "contains", "_1", "low"), ("other", "symbol", "not_in", "NATION_3", "info"), ("same", "symbol", "==", "NATION_5", "info"), ("nothing", "absent", ">", "0", "high")]


def _alerts(v):
    s = v.strategies.select(F.col("strategy_id").alias("id"), F.col("trades").cast("string").alias("trades"), F.format_string("%.1f", F.round("drawdown_pct")).alias("drawdown"), "symbol", "trades_hash")
    p = s.unpivot("id", ["trades", "drawdown", "symbol", "trades_hash"], "metric", "value").filter("value is not null")
    return C.evaluate_rules(p, v.spark.createDataFrame(_RULES, "name string, metric string, op string, threshold string, severity string"))


_FIRED = f"""(SELECT i.id, r.name, r.severity, coalesce(CASE WHEN op = 'missing' THEN value IS NULL WHEN value IS NULL THEN false WHEN op = '==' THEN value = threshold WHEN op = '<' THEN TRY_CAST(value AS DOUBLE) < TRY_CAST(threshold AS DOUBLE) WHEN op = '>=' THEN TRY_CAST(value AS DOUBLE) >= TRY_CAST(threshold AS DOUBLE) WHEN op = 'in' THEN list_contains(string_split(threshold, ','), value) WHEN op = 'not_in' THEN NOT list_contains(string_split(threshold, ','), value) WHEN op = 'contains' THEN contains(value, threshold) ELSE false END, false) AS fired
FROM (SELECT DISTINCT id FROM {_PAY}) i CROSS JOIN (VALUES {', '.join(str(r) for r in _RULES)}) r(name, metric, op, threshold, severity) LEFT JOIN {_PAY} p ON p.id = i.id AND p.metric = r.metric)"""


@query("alert_rule_evaluate", f"SELECT * FROM {_FIRED}")
def _(v):
    return _alerts(v)


@query("alert_rules_batch", f"SELECT severity, count(*) FILTER (fired) AS fired, count(*) AS n FROM {_FIRED} GROUP BY severity")
def _(v):
    return _alerts(v).groupBy("severity").agg(F.count(F.when(F.col("fired"), 1)).alias("fired"), F.count(F.lit(1)).alias("n"))


_GATES = "(" + " UNION ALL ".join(f"SELECT strategy_id, '{g}' AS gate, {r} AS required, coalesce({p}, false) AS passed FROM {_COUNTED}" for g, r, p in (("min_trades", "true", "trades >= 100"), ("oos_evidence", "true", "oos_is >= 0.4"), ("drawdown_cap", "true", "drawdown_pct <= 40"), ("profit", "false", "net_profit > 0"), ("audit_clean", "true", "critical = 0"))) + ")"
_PROMO = f"(SELECT strategy_id, count(*) FILTER (passed) AS passed, count(*) FILTER (required AND NOT passed) AS required_failures, count(*) FILTER (NOT required AND NOT passed) AS soft_failures, count(*) FILTER (required AND NOT passed) = 0 AS approved FROM {_GATES} GROUP BY strategy_id)"


def _promo(v):
    return C.promotion(C.with_counts(cat(v)), 40.0, 0.4)


@query("promotion_evaluate", f"SELECT * FROM {_PROMO}")
def _(v):
    return _promo(v)


@query("promotion_explain_failure", f"SELECT strategy_id, gate FROM {_GATES} WHERE required AND NOT passed")
def _(v):
    return C.gates(C.with_counts(cat(v)), 40.0, 0.4).filter("required and not passed").select("strategy_id", "gate")


@query("promotion_required_gates", f"SELECT gate, required, count(*) FILTER (passed) AS passed FROM {_GATES} GROUP BY ALL")
def _(v):
    return C.gates(C.with_counts(cat(v)), 40.0, 0.4).groupBy("gate", "required").agg(F.count(F.when(F.col("passed"), 1)).alias("passed"))


_VERD = "CASE WHEN approved AND soft_failures = 0 THEN 'ready' WHEN approved OR required_failures = 1 THEN 'marginal' ELSE 'blocked' END"


@query("batch_audit_databank", f"SELECT {_VERD} AS verdict, count(*) AS n FROM {_PROMO} GROUP BY ALL")
def _(v):
    verdict = F.when(F.col("approved") & (F.col("soft_failures") == 0), "ready").when(F.col("approved") | (F.col("required_failures") == 1), "marginal").otherwise("blocked")
    return _promo(v).groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


_PLAN = "CASE WHEN round(oos_is, 9) < 0.9 THEN 'rebuild' WHEN history_days < 2400 THEN 'rebuild' WHEN round(oos_is, 9) < 1.0 OR trades < 500 THEN 'retest' ELSE 'no_action' END"


def _cadence():
    r = F.round("oos_is", 9)  # the order in which a mean is summed decides no verdict
    return F.when(r < 0.9, "rebuild").when(F.col("history_days") < 2400, "rebuild").when((r < 1.0) | (F.col("trades") < 500), "retest").otherwise("no_action")


@query("schedule_for_strategy", f"SELECT strategy_id, {_PLAN} AS verdict FROM {_S}")
def _(v):
    return cat(v).select("strategy_id", _cadence().alias("verdict"))


@query("schedule_for_workspace", f"SELECT project, {_PLAN} AS verdict, count(*) AS n FROM {_S} GROUP BY ALL")
def _(v):
    return cat(v).groupBy("project", _cadence().alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


@query("symbol_normalize", "SELECT c_name, upper(replace(replace(c_name, '#', ''), '_', '')) AS canonical, regexp_extract(upper(replace(c_name, '#', '')), '(0|1|2|3|4)$', 1) AS quote FROM customer")
def _(v):
    s = F.upper(F.translate("c_name", "#_", ""))
    return v.table("customer").select("c_name", s.alias("canonical"), F.regexp_extract(F.upper(F.translate("c_name", "#", "")), "(0|1|2|3|4)$", 1).alias("quote"))


def _dedupe(name, order_sql, order):
    @query(name, f"SELECT strategy_id, trades_hash FROM (SELECT *, row_number() OVER (PARTITION BY trades_hash ORDER BY {order_sql}, strategy_id) AS i FROM {_S}) WHERE i = 1 OR trades_hash IS NULL")
    def _(v):
        return C.dedupe(cat(v), "trades_hash", order()).select("strategy_id", "trades_hash")


_dedupe("portfolio_dedupe", "fitness_oos DESC NULLS LAST", lambda: F.desc_nulls_last("fitness_oos"))
_dedupe("portfolio_dedupe_best_profit", "profit_to_dd DESC NULLS LAST", lambda: F.desc_nulls_last("profit_to_dd"))


@query("databank_merge", "WITH u AS (SELECT strategy_id, trades_hash, CASE project WHEN 'p1' THEN 0 ELSE 1 END AS source FROM strategies WHERE project IN ('p1', 'p2')) SELECT strategy_id, trades_hash FROM (SELECT *, row_number() OVER (PARTITION BY trades_hash ORDER BY source, strategy_id) AS i FROM u) WHERE (i = 1 OR trades_hash IS NULL) AND (trades_hash IS NULL OR trades_hash NOT IN (SELECT trades_hash FROM strategies WHERE project = 'p3' AND databank = 'd0' AND trades_hash IS NOT NULL))")
def _(v):
    s = v.strategies
    return C.merged([s.filter("project = 'p1'"), s.filter("project = 'p2'")], s.filter("project = 'p3' and databank = 'd0'")).select("strategy_id", "trades_hash")


@query("databank_promote", f"""SELECT strategy_id, trades_hash FROM (SELECT *, row_number() OVER (PARTITION BY trades_hash ORDER BY profit_to_dd DESC NULLS LAST, strategy_id) AS i FROM {_S} WHERE project = 'p0' AND drawdown_pct <= 60 AND (trades_hash IS NULL OR trades_hash NOT IN (SELECT trades_hash FROM strategies WHERE project = 'p1' AND databank = 'd1' AND trades_hash IS NOT NULL))) WHERE i = 1 OR trades_hash IS NULL ORDER BY profit_to_dd DESC NULLS LAST, strategy_id LIMIT 10""")
def _(v):
    s = cat(v)
    have = s.filter("project = 'p1' and databank = 'd1' and trades_hash is not null").select("trades_hash").distinct()
    new = s.filter("project = 'p0' and drawdown_pct <= 60").join(have, "trades_hash", "left_anti")
    return C.dedupe(new, "trades_hash", F.desc_nulls_last("profit_to_dd")).orderBy(F.desc_nulls_last("profit_to_dd"), "strategy_id").limit(10).select("strategy_id", "trades_hash")


@query("portfolio_ab_test", """-- floats: jaccard mean_a mean_b
WITH h AS (SELECT DISTINCT project, trades_hash FROM strategies WHERE trades_hash IS NOT NULL AND databank IN ('d0', 'd1')), a AS (SELECT trades_hash FROM h WHERE project = 'p0'), b AS (SELECT trades_hash FROM h WHERE project = 'p1')
SELECT (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS shared, (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) / (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS jaccard, m.mean_a, m.mean_b, CASE WHEN abs(m.mean_a - m.mean_b) <= 1e-6 * greatest(abs(m.mean_a), abs(m.mean_b)) THEN 'tie' WHEN m.mean_a > m.mean_b THEN 'a' ELSE 'b' END AS winner
FROM (SELECT avg(fitness_oos) FILTER (project = 'p0') AS mean_a, avg(fitness_oos) FILTER (project = 'p1') AS mean_b FROM strategies WHERE databank IN ('d0', 'd1')) m""")
def _(v):
    s = v.strategies.filter("databank in ('d0', 'd1')")
    a, b = F.col("project") == "p0", F.col("project") == "p1"
    sides = s.filter("trades_hash is not null").filter(a | b).groupBy("trades_hash").agg(F.max(a).alias("a"), F.max(b).alias("b"))
    o = sides.agg(F.count(F.when(F.col("a") & F.col("b"), 1)).alias("shared"), F.count(F.lit(1)).alias("_all"))
    m = s.agg(F.avg(F.when(a, F.col("fitness_oos"))).alias("mean_a"), F.avg(F.when(b, F.col("fitness_oos"))).alias("mean_b"))
    x, y = F.col("mean_a"), F.col("mean_b")
    tie = F.abs(x - y) <= 1e-6 * F.greatest(F.abs(x), F.abs(y))
    return o.crossJoin(m).select("shared", ratio(F.col("shared"), F.col("_all")).alias("jaccard"), "mean_a", "mean_b", F.when(tie, "tie").when(x > y, "a").otherwise("b").alias("winner"))  # one row each


@query("strategy_compare", f"""-- floats: profit_to_dd
SELECT project, strategy_id, profit_to_dd, row_number() OVER (PARTITION BY project ORDER BY profit_to_dd DESC NULLS LAST, strategy_id) AS place, trades_hash IS NOT NULL AND count(*) OVER (PARTITION BY project, trades_hash) > 1 AS shared_hash, max(trades) OVER (PARTITION BY project) > 4 * min(trades) OVER (PARTITION BY project) AS uneven, coalesce(oos_is < 0.5, false) AS overfit FROM {_S}""")
def _(v):
    w, h = Window.partitionBy("project"), Window.partitionBy("project", "trades_hash")
    place = F.row_number().over(w.orderBy(F.desc_nulls_last("profit_to_dd"), "strategy_id")).cast("long")
    return cat(v).select(
        "project", "strategy_id", "profit_to_dd", place.alias("place"), (F.col("trades_hash").isNotNull() & (F.count(F.lit(1)).over(h) > 1)).alias("shared_hash"), (F.max("trades").over(w) > 4 * F.min("trades").over(w)).alias("uneven"), F.coalesce(F.col("oos_is") < 0.5, F.lit(False)).alias("overfit")
    )


_CMP = ["trades", "net_profit", "drawdown_abs", "fitness_full"]


@query("strategy_compare_two", f"-- floats: a b delta delta_pct\nSELECT metric, a, b, b - a AS delta, (b - a) / nullif(abs(a), 0) * 100 AS delta_pct FROM (SELECT metric, max(value) FILTER (strategy_id = 0) AS a, max(value) FILTER (strategy_id = 1) AS b FROM (UNPIVOT (SELECT strategy_id, {', '.join(f'CAST({m} AS DOUBLE) AS {m}' for m in _CMP)} FROM strategies) ON {', '.join(_CMP)} INTO NAME metric VALUE value) GROUP BY metric)", digits=4)
def _(v):
    u = v.strategies.filter("strategy_id in (0, 1)").select("strategy_id", *(F.col(m).cast("double").alias(m) for m in _CMP)).unpivot("strategy_id", _CMP, "metric", "value")
    g = u.groupBy("metric").agg(*(F.max(F.when(F.col("strategy_id") == k, F.col("value"))).alias(n) for k, n in enumerate("ab")))
    return g.withColumn("delta", F.col("b") - F.col("a")).withColumn("delta_pct", ratio(F.col("delta"), F.abs("a")) * 100)


_LIGHT = f"CASE WHEN critical > 0 OR high > 0 THEN 'red' WHEN findings > 0 THEN 'yellow' ELSE 'green' END"


def _light():
    return F.when((F.col("critical") > 0) | (F.col("high") > 0), "red").when(F.col("findings") > 0, "yellow").otherwise("green")


@query("strategy_ready_for_deploy", f"SELECT strategy_id, {_LIGHT} AS light FROM {_COUNTED}")
def _(v):
    return C.with_counts(cat(v)).select("strategy_id", _light().alias("light"))


@query("strategy_export_pipeline", f"""SELECT strategy_id, bucket, light FROM (SELECT *, max(score) OVER (PARTITION BY bucket) AS top, row_number() OVER (PARTITION BY bucket ORDER BY score DESC NULLS LAST, strategy_id) AS round FROM (SELECT *, {_SCORE} AS score, coalesce(trades_hash, '__no_key__') AS bucket, {_LIGHT} AS light FROM {_COUNTED} WHERE trades >= 30)) ORDER BY round, top DESC NULLS LAST, bucket LIMIT 5""")
def _(v):
    s = C.with_counts(cat(v)).filter("trades >= 30")
    return C.diverse(s.withColumn("score", C.defensive_score(s)), F.col("trades_hash"), 5).select("strategy_id", "bucket", _light().alias("light"))


@query("databank_regression_check", """-- floats: cur prev change
WITH n AS (SELECT fingerprint, arg_max(fitness_full, strategy_id) AS cur, true AS k FROM strategies WHERE project <> 'p0' GROUP BY ALL), t AS (SELECT fingerprint, arg_max(fitness_full, strategy_id) AS prev, true AS k FROM strategies WHERE project = 'p0' GROUP BY ALL)
SELECT fingerprint, cur, prev, change, CASE WHEN nk IS NULL THEN 'missing' WHEN tk IS NULL THEN 'new' WHEN change > 0.01 THEN 'improved' WHEN change < -0.01 THEN 'regressed' ELSE 'stable' END AS state FROM (SELECT fingerprint, cur, prev, n.k AS nk, t.k AS tk, (cur - prev) / nullif(abs(prev), 0) AS change FROM n FULL JOIN t USING (fingerprint))""")
def _(v):
    s = v.strategies
    return C.regression(s.filter("project <> 'p0'"), s.filter("project = 'p0'"), "fingerprint", "fitness_full", 0.01)


@query("databank_correlation_matrix", "-- floats: rho\nSELECT x.series_id AS sym_a, y.series_id AS sym_b, corr(x.r, y.r) AS rho, abs(corr(x.r, y.r)) > 0.02 AS over FROM series x JOIN series y ON x.idx = y.idx AND x.series_id < y.series_id WHERE x.r IS NOT NULL AND y.r IS NOT NULL GROUP BY ALL".replace("GROUP BY ALL", "GROUP BY x.series_id, y.series_id"))
def _(v):
    from .risk import correlations

    return correlations(v).withColumn("over", F.abs("rho") > 0.02)


_DIMS = ["trades_hash", "symbol", "timeframe", "fingerprint"]
_CONC = f"(SELECT dim, count(*) AS keys, sum(s * s) AS hhi, CASE WHEN count(*) > 1 THEN (sum(s * s) - 1 / count(*)) / (1 - 1 / count(*)) ELSE 1 END AS hhi_scaled FROM (SELECT dim, key, c / sum(c) OVER (PARTITION BY dim) AS s FROM (SELECT dim, key, count(*) AS c FROM (UNPIVOT (SELECT {', '.join(f'''coalesce({d}, '__missing__') AS {d}''' for d in _DIMS)} FROM strategies) ON {', '.join(_DIMS)} INTO NAME dim VALUE key) GROUP BY dim, key)) GROUP BY dim)"


@query("portfolio_concentration", f"-- floats: hhi hhi_scaled\nSELECT * FROM {_CONC}")
def _(v):
    return C.concentration(v.strategies, _DIMS)


@query("portfolio_diversity_score", f"-- floats: score\nSELECT avg(100 * (1 - hhi_scaled)) AS score, count(*) AS dims FROM {_CONC} WHERE dim <> 'timeframe'")
def _(v):
    return C.concentration(v.strategies, [d for d in _DIMS if d != "timeframe"]).agg(F.avg(100 * (1 - F.col("hhi_scaled"))).alias("score"), F.count(F.lit(1)).alias("dims"))


@query("portfolio_summary", f"-- floats: mean_oos median_profit\nSELECT symbol, timeframe, count(*) AS n, count(*) FILTER (net_profit > 0) AS profitable, count(DISTINCT trades_hash) AS hashes, avg(fitness_oos) AS mean_oos, median(net_profit) AS median_profit FROM {_S} GROUP BY GROUPING SETS ((symbol), (timeframe), ())")
def _(v):
    return cat(v).groupingSets([["symbol"], ["timeframe"], []], "symbol", "timeframe").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("net_profit") > 0, 1)).alias("profitable"), F.count_distinct("trades_hash").alias("hashes"), F.avg("fitness_oos").alias("mean_oos"), F.percentile("net_profit", 0.5).alias("median_profit"))


@query("portfolio_capital_allocation", f"-- floats: w\nSELECT project, strategy_id, 0.5 * inv / sum(inv) OVER p + 0.5 * fit / nullif(sum(fit) OVER p, 0) AS w FROM (SELECT project, strategy_id, 1 / greatest(drawdown_pct, 1) AS inv, greatest(coalesce(fitness_oos, 0), 0) AS fit FROM strategies) WINDOW p AS (PARTITION BY project)")
def _(v):
    w = Window.partitionBy("project")
    s = v.strategies.select("project", "strategy_id", (1 / F.greatest("drawdown_pct", F.lit(1.0))).alias("inv"), F.greatest(F.coalesce("fitness_oos", F.lit(0.0)), F.lit(0.0)).alias("fit"))
    return s.select("project", "strategy_id", (0.5 * F.col("inv") / F.sum("inv").over(w) + 0.5 * ratio(F.col("fit"), F.sum("fit").over(w))).alias("w"))


def _book(v):
    """All series as members of two portfolios."""
    r = _returns(v).select("series_id", "idx", "r")
    return r.withColumn("portfolio_id", F.explode(F.when(F.col("series_id") < "G", F.array(F.lit("all"), F.lit("early"))).otherwise(F.array(F.lit("all")))))


_BOOK = "(SELECT 'all' AS portfolio_id, series_id, idx, r FROM series WHERE r IS NOT NULL UNION ALL SELECT 'early', series_id, idx, r FROM series WHERE r IS NOT NULL AND series_id < 'G')"
_COV = f"(SELECT x.portfolio_id, x.series_id AS sym_a, y.series_id AS sym_b, covar_samp(x.r, y.r) AS cov FROM {_BOOK} x JOIN {_BOOK} y ON x.portfolio_id = y.portfolio_id AND x.idx = y.idx GROUP BY x.portfolio_id, x.series_id, y.series_id)"


@query("portfolio_equal_weight", f"-- floats: variance\nSELECT portfolio_id, sum(cov) / count(*) AS variance FROM {_COV} GROUP BY portfolio_id")
def _(v):
    return C.covariances(_book(v)).groupBy("portfolio_id").agg((F.sum("cov") / F.count(F.lit(1))).alias("variance"))


@query("portfolio_inverse_volatility", f"-- floats: w\nSELECT portfolio_id, series_id, coalesce(1 / nullif(s, 0), 0) / sum(coalesce(1 / nullif(s, 0), 0)) OVER (PARTITION BY portfolio_id) AS w FROM (SELECT portfolio_id, series_id, stddev_samp(r) AS s FROM {_BOOK} GROUP BY ALL)")
def _(v):
    g = _book(v).groupBy("portfolio_id", "series_id").agg(F.coalesce(1 / F.nullif(F.stddev_samp("r"), F.lit(0.0)), F.lit(0.0)).alias("i"))
    return g.select("portfolio_id", "series_id", (F.col("i") / F.sum("i").over(Window.partitionBy("portfolio_id"))).alias("w"))


@query("portfolio_risk_parity")
def _(v):
    """Iterative; tests hold that all risk contributions are equal."""
    return C.solved_weights(C.covariances(_book(v)), "risk_parity")


@query("portfolio_min_variance")
def _(v):
    """Iterative; tests hold that no shift of weight lowers the variance."""
    return C.solved_weights(C.covariances(_book(v)), "min_variance")


_DR = [(">", 1.5, "strong"), (">", 1.2, "moderate")]


@query("portfolio_diversification_ratio", f"-- floats: ratio\nSELECT *, {bands_sql('ratio', _DR, 'weak')} AS verdict FROM (SELECT portfolio_id, sum(CASE WHEN sym_a = sym_b THEN sqrt(cov) / n END) / sqrt(sum(cov / (n * n))) AS ratio FROM (SELECT *, count(*) FILTER (sym_a = sym_b) OVER (PARTITION BY portfolio_id) AS n FROM {_COV}) GROUP BY portfolio_id)")
def _(v):
    """With equal weights."""
    c = C.covariances(_book(v))
    own = F.col("sym_a") == F.col("sym_b")
    g = c.groupBy("portfolio_id").agg(F.sum(F.when(own, F.sqrt("cov"))).alias("a"), F.count(F.when(own, 1)).alias("n"), F.sum("cov").alias("t"))
    return g.select("portfolio_id", (F.col("a") / F.col("n") / F.sqrt(F.col("t") / F.col("n") ** 2)).alias("ratio")).withColumn("verdict", bands(F.col("ratio"), _DR, "weak"))


@query("databank_metric_histogram", "SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((fitness_full - lo) / ((hi - lo) / 20)), 19) END AS BIGINT) AS bin, count(*) AS n FROM (SELECT fitness_full, min(fitness_full) OVER () AS lo, max(fitness_full) OVER () AS hi FROM strategies) GROUP BY ALL")
def _(v):
    from ..operators.stats import bins

    return bins(v.strategies, "fitness_full", 20).groupBy(F.col("bin").cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("workspace_insights", "SELECT dim, key, count(*) AS n FROM (UNPIVOT (SELECT symbol, timeframe, project FROM strategies) ON symbol, timeframe, project INTO NAME dim VALUE key) GROUP BY ALL")
def _(v):
    return v.strategies.select(F.inline(F.array(*(F.struct(F.lit(d).alias("dim"), F.col(d).alias("key")) for d in ("symbol", "timeframe", "project"))))).groupBy("dim", "key").agg(F.count(F.lit(1)).alias("n"))


@query("dashboard_overview", f"SELECT strategy_id, side FROM (SELECT strategy_id, row_number() OVER (ORDER BY score DESC NULLS LAST, strategy_id) AS a, row_number() OVER (ORDER BY score, strategy_id) AS z FROM {_SCORED}), (VALUES ('best'), ('worst')) s(side) WHERE CASE WHEN side = 'best' THEN a ELSE z END <= 10")
def _(v):
    s = cat(v)
    s = s.withColumn("score", C.defensive_score(s))
    best = s.orderBy(F.desc_nulls_last("score"), "strategy_id").limit(10).select("strategy_id", F.lit("best").alias("side"))
    return best.union(s.orderBy(F.asc_nulls_last("score"), "strategy_id").limit(10).select("strategy_id", F.lit("worst").alias("side")))


@query("databank_list", "SELECT project, databank, count(*) AS n FROM strategies GROUP BY ALL")
def _(v):
    return v.strategies.groupBy("project", "databank").agg(F.count(F.lit(1)).alias("n"))


@query("databank_count", "SELECT project, count(*) FILTER (databank = 'd1') AS n FROM strategies GROUP BY project")
def _(v):
    """Strategies of one databank by name, in every project, those without it included."""
    return v.strategies.groupBy("project").agg(F.count(F.when(F.col("databank") == "d1", 1)).alias("n"))


@query("projects_inventory", "SELECT project, count(*) AS databanks, CAST(sum(n) AS BIGINT) AS strategies, array_to_string(list_sort(list(databank || '=' || n)), ',') AS counts FROM (SELECT project, databank, count(*) AS n FROM strategies GROUP BY ALL) GROUP BY project")
def _(v):
    """A row a project: its databanks, strategies, and counts by databank (names, few in a project)."""
    n = v.strategies.groupBy("project", "databank").agg(F.count(F.lit(1)).alias("n"))
    counts = F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "databank", "n"))), ",")
    return n.groupBy("project").agg(F.count(F.lit(1)).alias("databanks"), F.sum("n").alias("strategies"), counts.alias("counts"))


@query("instrument_list", "SELECT symbol, array_to_string(list_sort(list(DISTINCT project)), ',') AS projects, arg_min(timeframe, strategy_id) AS timeframe FROM strategies GROUP BY symbol")
def _(v):
    return v.strategies.groupBy("symbol").agg(F.array_join(F.sort_array(F.collect_set("project")), ",").alias("projects"), F.min_by("timeframe", "strategy_id").alias("timeframe"))


_REG = "(SELECT strategy_id, symbol, trades_hash AS alias, fingerprint AS instrument, timeframe, history_days * 86400000 + strategy_id AS date_to FROM strategies)"


@query("data_registry_lookup", f"SELECT asked, strategy_id, symbol, timeframe, strftime(make_timestamp(date_to * 1000), '%Y-%m-%dT%H:%M:%S') AS date_to FROM {_REG} r JOIN (VALUES ('h2 H1', 'h2', 'H1'), ('x5', 'x5', NULL), ('all D1', NULL, 'D1')) q(asked, s, f) ON (s IS NULL OR r.symbol = s OR r.alias = s OR r.instrument = s) AND (f IS NULL OR timeframe = f)")
def _(v):
    """Three look-ups, each by a symbol, alias or instrument, a timeframe, or both."""
    reg = v.strategies.select("strategy_id", "symbol", F.col("trades_hash").alias("alias"), F.col("fingerprint").alias("instrument"), "timeframe", (F.col("history_days") * 86400000 + F.col("strategy_id")).alias("date_to"))
    found = [C.registry_lookup(reg, s, f).withColumn("asked", F.lit(a)) for a, s, f in (("h2 H1", "h2", "H1"), ("x5", "x5", None), ("all D1", None, "D1"))]
    return found[0].union(found[1]).union(found[2]).select("asked", "strategy_id", "symbol", "timeframe", "date_to")


@query("broker_registry_query", "SELECT p_partkey, p_brand, (SELECT count(*) FROM part WHERE upper(p_brand) LIKE '%D#1%') AS total FROM part WHERE upper(p_brand) LIKE '%D#1%' ORDER BY p_partkey LIMIT 50")
def _(v):
    """The first 50 rows of a table whose column holds a text, in any case, and how many there are."""
    return C.registry_query(v.table("part"), "p_brand", "d#1", "p_partkey", 50).select("p_partkey", "p_brand", "total")
