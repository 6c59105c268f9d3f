"""Operators composed of others: comparison of two sides, shipping of strategies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import normal_cdf
from ..session import materialise
from . import catalog as C
from . import graph as G
from . import risk as R
from . import stats as S
from . import trades as T

KEY = T.KEY


def compare_sides(pairs: DataFrame, level: float = 0.05) -> DataFrame:
    """Sides a and b of each series (series_id, idx, a, b), a row a series.

    Paired t of a - b; brittleness and combined stress of each side; regression of a on b; share of rows in which a is
    above, longest runs above and below; and the side that is better at ``level``, or ``no significant difference``.
    """
    p = materialise(pairs.select("series_id", "idx", "a", "b"), "pairs")
    sides = p.select("series_id", F.col("idx").alias(T.ORDER), F.inline(F.array(*(F.struct(F.lit(s).alias("side"), F.col(s).alias("pnl")) for s in "ab"))))
    trades = sides.withColumn(KEY, F.concat_ws(":", "series_id", "side"))
    facts = materialise(T.brittle(trades).join(T.stress_verdict(T.stress(trades)).select(KEY, "killed", F.col("verdict").alias("stress")), KEY), "sides")
    out = S.paired_t(p).withColumn("different", F.coalesce(2 * (1 - normal_cdf(F.abs("t"))) < level, F.lit(False)))
    for s in "ab":
        one = facts.select(KEY, *(F.col(c).alias(f"{n}_{s}") for c, n in (("gini", "gini"), ("top5", "top5"), ("top10", "top10"), ("verdict", "brittle"), ("killed", "killed"), ("stress", "stress"))))
        out = out.withColumn(KEY, F.concat_ws(":", "series_id", F.lit(s))).join(one, KEY).drop(KEY)
    above = F.avg((F.col("a") > F.col("b")).cast("double")).alias("share_above")
    fit = p.groupBy("series_id").agg(F.regr_slope("a", "b").alias("beta"), F.regr_intercept("a", "b").alias("alpha"), F.corr("a", "b").alias("correlation"), above)
    runs = R.longest_runs(p, F.when(F.col("a") > F.col("b"), "above").when(F.col("a") < F.col("b"), "below"), "series_id", "idx")
    runs = runs.groupBy("series_id").agg(*(F.max(F.when(F.col("kind") == k, F.col("longest"))).alias(f"longest_{k}") for k in ("above", "below")))
    better = F.when(~F.col("different"), "no significant difference").when(F.col("mean") > 0, "a").otherwise("b")
    return out.join(fit, "series_id").join(runs, "series_id", "left").fillna(0, ["longest_above", "longest_below"]).withColumn("better", better)


def ship(requests: DataFrame, gates: DataFrame, tags: DataFrame, lineage: DataFrame, alerts: DataFrame) -> DataFrame:
    """What becomes of requests to ship (strategy_id, node_id, parent_id, label, add, dry_run; one a strategy), a row a request.

    A strategy whose required ``gates`` all pass is approved. If it is and this is no dry run, its tags ``add`` are added
    to ``tags`` and its node goes into ``lineage``, unless the node is there or its parent is not; parents must be there
    before. ``tagging`` and ``lineage`` say what was done or why not, ``alerts`` the rules that fire on it (rows of
    ``evaluate_rules``, whatever the approval), ``blocked_by`` and ``warnings`` the gates that failed.
    """
    failed = lambda required: F.array_join(F.sort_array(F.collect_list(F.when((F.col("required") == required) & ~F.col("passed"), F.col("gate")))), ",")
    g = gates.groupBy(KEY).agg(failed(True).alias("blocked_by"), failed(False).alias("warnings"))
    fired = alerts.filter("fired").groupBy(F.col("id").alias(KEY)).agg(F.array_join(F.sort_array(F.collect_list("name")), ",").alias("alerts"), F.count(F.lit(1)).alias("n_alerts"))
    known = lineage.select("node_id").distinct()
    m = requests.join(g, KEY).join(fired, KEY, "left").fillna("", ["alerts"]).fillna(0, ["n_alerts"])
    m = m.join(known.withColumn("_there", F.lit(True)), "node_id", "left").join(known.select(F.col("node_id").alias("parent_id"), F.lit(True).alias("_parent")), "parent_id", "left")
    approved = F.col("blocked_by") == ""
    m = m.withColumn("_not", F.when(~approved, "not approved").when(F.col("dry_run"), "dry_run"))
    node = F.when(F.col("_there"), "node already exists").when(F.col("parent_id").isNotNull() & F.col("_parent").isNull(), "parent not registered").otherwise("registered")
    m = m.withColumn("lineage", F.coalesce("_not", node)).withColumn("verdict", F.when(~approved, "blocked").when(F.col("dry_run"), "approved_dry_run").otherwise("shipped"))
    asked = F.coalesce(F.size("add") > 0, F.lit(False))
    m = m.withColumn("_not", F.coalesce("_not", F.when(~asked, "no tags requested")))
    change = m.filter("_not is null").select(KEY, "add", F.array().cast("array<string>").alias("remove"))
    m = m.join(G.edit_tags(tags, change, KEY), KEY, "left").withColumn("tagging", F.coalesce("_not", "error", F.lit("tagged")))
    return m.select(KEY, "verdict", "blocked_by", "warnings", "tagging", "tags", "lineage", "node_id", "parent_id", "label", "alerts", "n_alerts")


def shipped_nodes(manifest: DataFrame) -> DataFrame:
    """Lineage rows that ``ship`` adds."""
    return manifest.filter("lineage = 'registered'").select("node_id", "parent_id", "label")


def shipped_tags(manifest: DataFrame) -> DataFrame:
    """New tag rows of the strategies that ``ship`` tagged."""
    return manifest.filter("tagging = 'tagged'").select(KEY, "tags")


def ship_payload(s: DataFrame) -> DataFrame:
    """(id, metric, value text) that the workspace rules read; without evidence a strategy counts as harmless."""
    c = F.col
    value = {
        "drawdown_pct": F.coalesce("drawdown_pct", F.lit(0.0)), "oos_is_ratio": F.coalesce(F.nullif("oos_is", F.lit(0.0)), F.lit(1.0)), "trades": c("trades"),
        "drift_verdict": F.coalesce("drift_verdict", F.lit("green")), "brittle_verdict": F.coalesce("brittle_verdict", F.lit("robust")), "status": F.lit("running"),
    }
    rows = F.array(*(F.struct(F.lit(k).alias("metric"), x.cast("string").alias("value")) for k, x in value.items()))
    return s.select(c(KEY).alias("id"), F.inline(rows)).filter("value is not null")


def workspace_alerts(payload: DataFrame) -> DataFrame:
    rules = payload.sparkSession.createDataFrame(WORKSPACE_RULES, "name string, metric string, op string, threshold string, severity string")
    return C.evaluate_rules(payload, rules)


# The default rules of a workspace.
WORKSPACE_RULES = [
    ("extreme_drawdown", "drawdown_pct", ">", "25", "high"),
    ("drift_red", "drift_verdict", "==", "red", "critical"),
    ("drift_yellow", "drift_verdict", "==", "yellow", "medium"),
    ("weak_oos", "oos_is_ratio", "<", "0.3", "high"),
    ("low_trades", "trades", "<", "100", "medium"),
    ("stalled_build", "status", "==", "stalled", "high"),
    ("very_brittle", "brittle_verdict", "==", "very_brittle", "critical"),
]
