"""Registered queries: operators composed of others."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as C
from ..operators import trades as T
from ..operators import workflows as W
from .catalog import _COUNTED, _GATES, cat
from .indicators import PAIRS, _pairs
from .registry import query
from .risk import _RUN
from .text import _TAGS, _tags
from .trades import BRITTLE_SQL, STRESS_SQL

_SIDE = ", ".join(f"{s}.gini AS gini_{s}, {s}.top5 AS top5_{s}, {s}.top10 AS top10_{s}, {s}.verdict AS brittle_{s}, {s}.killed AS killed_{s}, {s}.stress AS stress_{s}" for s in "ab")
_ABOVE = _RUN.format(key="series_id", order="idx", src="(SELECT *, CASE WHEN a > b THEN 'above' WHEN a < b THEN 'below' END AS kind FROM p)")


@query("workflow_compare_two_strategies", f"""-- floats: mean t beta alpha correlation share_above gini_a top5_a top10_a gini_b top5_b top10_b
WITH p AS (SELECT * FROM {PAIRS}), trades AS (SELECT series_id || ':a' AS strategy_id, idx AS seq, a AS pnl FROM p UNION ALL SELECT series_id || ':b', idx, b FROM p),
f AS (SELECT x.*, y.killed, y.verdict AS stress FROM ({BRITTLE_SQL}) x JOIN ({STRESS_SQL}) y ON y.strategy_id = x.strategy_id), runs AS ({_ABOVE}),
m AS (SELECT series_id, count(*) AS n, avg(a - b) AS mean, avg(a - b) / (stddev_samp(a - b) / sqrt(count(*))) AS t, regr_slope(a, b) AS beta, regr_intercept(a, b) AS alpha, corr(a, b) AS correlation, avg(CASE WHEN a > b THEN 1.0 ELSE 0 END) AS share_above FROM p GROUP BY series_id)
SELECT m.*, abs(t) > 1.959963984540054 AS different, {_SIDE}, coalesce((SELECT longest FROM runs r WHERE r.series_id = m.series_id AND kind = 'above'), 0) AS longest_above, coalesce((SELECT longest FROM runs r WHERE r.series_id = m.series_id AND kind = 'below'), 0) AS longest_below,
CASE WHEN abs(t) <= 1.959963984540054 THEN 'no significant difference' WHEN mean > 0 THEN 'a' ELSE 'b' END AS better FROM m JOIN f a ON a.strategy_id = m.series_id || ':a' JOIN f b ON b.strategy_id = m.series_id || ':b'""")
def _(v):
    """Each series (a) beside the benchmark (b)."""
    return W.compare_sides(_pairs(v))


_FIRES = f"""(SELECT s.strategy_id, list_sort(list_filter([CASE WHEN drawdown_pct > 25 THEN 'extreme_drawdown' END, CASE WHEN oos_is < 0.3 AND oos_is <> 0 THEN 'weak_oos' END, CASE WHEN trades < 100 THEN 'low_trades' END, CASE WHEN verdict = 'very_brittle' THEN 'very_brittle' END], lambda x: x IS NOT NULL)) AS names
FROM {_COUNTED} s LEFT JOIN ({BRITTLE_SQL}) b ON b.strategy_id = s.strategy_id)"""


def _alerts(v):
    b = T.brittle(v.trades).select("strategy_id", F.col("verdict").alias("brittle_verdict"))
    return W.workspace_alerts(W.ship_payload(cat(v).join(b, "strategy_id", "left").withColumn("drift_verdict", F.lit(None).cast("string"))))


@query("alert_workspace_defaults", f"SELECT strategy_id AS id, unnest(names) AS fired FROM {_FIRES}")
def _(v):
    """The default rules that fire on each strategy."""
    return _alerts(v).filter("fired").select("id", F.col("name").alias("fired"))


_REQUESTS = """(SELECT strategy_id, 30 * strategy_id AS node_id, CASE WHEN 30 * strategy_id > 500 THEN 30 * strategy_id - 500 END AS parent_id, symbol AS label, CASE WHEN strategy_id % 5 = 0 THEN []::VARCHAR[] ELSE ['live', 'checked', 'H1'] END AS add, {dry} AS dry_run FROM strategies)"""
_SHIP = f"""WITH g AS (SELECT strategy_id, coalesce(string_agg(gate, ',' ORDER BY gate) FILTER (required AND NOT passed), '') AS blocked_by, coalesce(string_agg(gate, ',' ORDER BY gate) FILTER (NOT required AND NOT passed), '') AS warnings FROM {_GATES} GROUP BY strategy_id),
r AS (SELECT q.*, blocked_by, warnings, CASE WHEN blocked_by <> '' THEN 'not approved' WHEN dry_run THEN 'dry_run' END AS no FROM {{requests}} q JOIN g ON g.strategy_id = q.strategy_id)
SELECT r.strategy_id, CASE WHEN blocked_by <> '' THEN 'blocked' WHEN dry_run THEN 'approved_dry_run' ELSE 'shipped' END AS verdict, blocked_by, warnings, coalesce(no, CASE WHEN len(add) = 0 THEN 'no tags requested' ELSE 'tagged' END) AS tagging,
array_to_string(list_sort(list_distinct(CASE WHEN no IS NULL THEN list_concat(t.tags, add) ELSE t.tags END)), ',') AS tags,
coalesce(no, CASE WHEN r.node_id IN (SELECT node_id FROM lineage) THEN 'node already exists' WHEN r.parent_id IS NOT NULL AND r.parent_id NOT IN (SELECT node_id FROM lineage) THEN 'parent not registered' ELSE 'registered' END) AS lineage,
r.node_id, r.parent_id, r.label, array_to_string(names, ',') AS alerts, len(names) AS n_alerts FROM r JOIN {_TAGS} t ON t.strategy_id = r.strategy_id JOIN {_FIRES} f ON f.strategy_id = r.strategy_id"""

for _n, _dry in (("ship_pipeline_run", "strategy_id % 2 = 0"), ("ship_pipeline_dry_run", "true"), ("workflow_promote_strategy", "false")):

    @query(_n, _SHIP.format(requests=_REQUESTS.format(dry=_dry)))
    def _(v, dry=_dry):
        """Every strategy asks to be shipped as a node of its own; ship_pipeline_run asks for even ids as dry runs."""
        s = cat(v)
        k = 30 * F.col("strategy_id")
        add = F.when(F.col("strategy_id") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("live"), F.lit("checked"), F.lit("H1")))
        requests = s.select("strategy_id", k.alias("node_id"), F.when(k > 500, k - 500).alias("parent_id"), F.col("symbol").alias("label"), add.alias("add"), F.expr(dry).alias("dry_run"))
        out = W.ship(requests, C.gates(C.with_counts(s), 40.0, 0.4), _tags(v), v.lineage, _alerts(v))
        return out.withColumn("tags", F.array_join("tags", ","))
