"""Registered queries: resampling, selection tests, walk-forward, sensitivity, permutations, clustering."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.common import bands, bands_sql, halves_up, ratio
from ..operators import risk as R
from ..operators import selection as S
from ..operators import stats as ST
from .indicators import _returns
from .registry import query

_R = "(SELECT series_id, idx, r FROM series WHERE r IS NOT NULL)"


def _scaled(v):
    """Returns cut to a tenth and to half a loss at most, so that equity stays positive."""
    return _returns(v).withColumn("r", F.greatest(F.col("r") / 10, F.lit(-0.5)))


for _n, _stat, _steps in (("montecarlo_equity_paths", "total", None), ("montecarlo_synthetic_from_returns", "total", 100), ("montecarlo_drawdown_distribution", "max_drawdown", None)):

    @query(_n)
    def _(v, stat=_stat, steps=_steps):
        """Draws depend on seed, series and path alone; tests hold repeatability, moments and bounds."""
        return S.percentiles(S.bootstrap_paths(_scaled(v), 1000, steps=steps), stat, [0.05, 0.25, 0.5, 0.75, 0.95])


@query("montecarlo_probability_of_drawdown")
def _(v):
    return S.bootstrap_paths(_scaled(v), 1000).groupBy("series_id").agg(F.avg((F.col("max_drawdown") >= 50).cast("double")).alias("probability"))


@query("stationary_bootstrap_resample")
def _(v):
    return S.bootstrap_paths(_scaled(v), 20, block=10.0)


@query("stationary_bootstrap_paths")
def _(v):
    return S.percentiles(S.bootstrap_paths(_scaled(v), 1000, block=10.0), "sharpe", [0.05, 0.25, 0.5, 0.75, 0.95])


@query("stationary_bootstrap_confidence")
def _(v):
    return S.percentiles(S.bootstrap_paths(_scaled(v), 1000, block=10.0), "mean", [0.025, 0.975]).withColumnsRenamed({"p2": "ci_low", "p98": "ci_high"})


def _excess(v):
    return S.aligned_excess(_returns(v).filter("series_id <> 'BUILDING'"), _returns(v).filter("series_id = 'BUILDING'"))


@query("spa_test_reality_check")
def _(v):
    return S.reality_check(_excess(v), 1000)


@query("spa_test_hansen")
def _(v):
    return S.reality_check(_excess(v), 1000, studentised=True)


@query("spa_test_consistency")
def _(v):
    return S.win_shares(_excess(v), 1000)


_SPLITS = [(a, b) for a in range(6) for b in range(a + 1, 6)]
_CPCV = f"""(WITH b AS (SELECT series_id, idx, row_number() OVER (PARTITION BY series_id ORDER BY idx) - 1 AS i, count(*) OVER (PARTITION BY series_id) AS n FROM series), s(split, g, h) AS (VALUES {', '.join(f'({k}, {a}, {b})' for k, (a, b) in enumerate(_SPLITS))}),
e AS (SELECT *, g * (n // 6) + least(g, n % 6) AS g0, (g + 1) * (n // 6) + least(g + 1, n % 6) AS g1, h * (n // 6) + least(h, n % 6) AS h0, (h + 1) * (n // 6) + least(h + 1, n % 6) AS h1, CAST(floor(0.01 * n) AS BIGINT) AS m FROM b, s)
SELECT series_id, idx, split, CASE WHEN (i >= g0 AND i < g1) OR (i >= h0 AND i < h1) THEN 'test' WHEN (i >= g1 AND i < g1 + m) OR (i >= h1 AND i < h1 + m) THEN 'embargo' ELSE 'train' END AS role FROM e)"""


@query("cpcv_generate_splits", f"SELECT series_id, split, role, count(*) AS n, CAST(sum(idx) AS BIGINT) AS idx_sum FROM {_CPCV} GROUP BY ALL")
def _(v):
    """Sizes and index sums of the roles of each split."""
    return S.cpcv_roles(v.series, 6, 2).groupBy("series_id", "split", "role").agg(F.count(F.lit(1)).alias("n"), F.sum("idx").alias("idx_sum"))


@query("cpcv_path_count", "SELECT series_id, CAST(15 AS BIGINT) AS paths FROM series GROUP BY series_id")
def _(v):
    return S.cpcv_roles(v.series, 6, 2).groupBy("series_id").agg(F.count_distinct("split").alias("paths"))


_BANDS = "CASE WHEN better >= 0.9 AND mean - 2 * std > 0 THEN 'robust' WHEN better >= 0.7 THEN 'promising' WHEN better >= 0.5 THEN 'borderline' ELSE 'fragile' END"


@query("cpcv_summarize_paths", f"""-- floats: mean std p5 median p95 better
SELECT *, {_BANDS} AS verdict FROM (SELECT series_id, avg(x) AS mean, stddev_samp(x) AS std, quantile_cont(x, 0.05) AS p5, median(x) AS median, quantile_cont(x, 0.95) AS p95, avg(CASE WHEN x > 0 THEN 1.0 ELSE 0 END) AS better FROM (SELECT c.series_id, split, avg(r) / stddev_samp(r) * sqrt(252.0) AS x FROM {_CPCV} c JOIN {_R} r ON r.series_id = c.series_id AND r.idx = c.idx WHERE role = 'test' GROUP BY c.series_id, split) GROUP BY series_id)""")
def _(v):
    test = S.cpcv_roles(v.series, 6, 2).filter("role = 'test'").join(_returns(v), ["series_id", "idx"]).groupBy("series_id", "split").agg(R.sharpe(F.col("r")).alias("x"))
    q = F.percentile("x", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    g = test.groupBy("series_id").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), q.alias("q"), F.avg((F.col("x") > 0).cast("double")).alias("better"))
    b = F.col("better")
    verdict = F.when((b >= 0.9) & (F.col("mean") - 2 * F.col("std") > 0), "robust").when(b >= 0.7, "promising").when(b >= 0.5, "borderline").otherwise("fragile")
    return g.select("series_id", "mean", "std", F.col("q")[0].alias("p5"), F.col("q")[1].alias("median"), F.col("q")[2].alias("p95"), "better", verdict.alias("verdict"))


def _moments(v):
    """Sharpe per trade, rows and shape of every strategy's trades; trials are the strategies."""
    p = F.col("pnl")
    g = v.trades.groupBy("strategy_id").agg(F.count(F.lit(1)).alias("n"), ratio(F.avg(p), F.stddev_samp(p)).alias("sharpe"), F.skewness(p).alias("skewness"), (F.kurtosis(p) + 3).alias("kurtosis"))
    return g.crossJoin(F.broadcast(v.trades.select(F.count_distinct("strategy_id").alias("trials"))))  # one row


_MOM = "(SELECT strategy_id, count(*) AS n, avg(pnl) / nullif(stddev_samp(pnl), 0) AS sharpe, avg(power((pnl - m) / s, 3)) AS skewness, avg(power((pnl - m) / s, 4)) AS kurtosis, (SELECT count(DISTINCT strategy_id) FROM trades) AS trials FROM (SELECT *, avg(pnl) OVER (PARTITION BY strategy_id) AS m, stddev_pop(pnl) OVER (PARTITION BY strategy_id) AS s FROM trades) GROUP BY strategy_id)"


@query("overfit_deflated_sharpe")
def _(v):
    """Needs normal quantiles, which DuckDB lacks; tests hold it against a plain computation."""
    return S.deflated_sharpe(_moments(v))


_HAIR = [(">", 1.0, "robust"), (">", 0.5, "acceptable"), (">", 0.0, "marginal")]


@query("overfit_haircut_sharpe", f"-- floats: haircut\nSELECT *, {bands_sql('haircut', _HAIR, 'negative')} AS verdict FROM (SELECT strategy_id, sharpe - sqrt(ln(greatest(trials, 1)) / n) AS haircut FROM {_MOM})")
def _(v):
    g = _moments(v).select("strategy_id", S.haircut(F.col("sharpe"), F.col("trials"), F.col("n")).alias("haircut"))
    return g.withColumn("verdict", bands(F.col("haircut"), _HAIR, "negative"))


@query("overfit_min_track_record_length", f"SELECT strategy_id, CASE WHEN sharpe > 0 AND 1 - skewness * sharpe + (kurtosis - 1) / 4 * sharpe * sharpe > 0 THEN CAST(ceil(1 + (1 - skewness * sharpe + (kurtosis - 1) / 4 * sharpe * sharpe) * power(1.6448536269514715 / sharpe, 2)) AS BIGINT) END AS least FROM {_MOM}")
def _(v):
    return _moments(v).select("strategy_id", S.least_track_record(F.col("sharpe"), F.col("skewness"), F.col("kurtosis")).alias("least"))


@query("overfit_pbo_from_oos_pairs", "-- floats: median top\nSELECT fold_id, max(CASE WHEN i = n // 2 THEN oos_metric END) AS median, arg_max(oos_metric, {'a': is_metric, 'b': strategy_id}) AS top, max(n) AS n, CASE WHEN max(n) >= 4 THEN arg_max(oos_metric, {'a': is_metric, 'b': strategy_id}) < max(CASE WHEN i = n // 2 THEN oos_metric END) END AS overfit FROM (SELECT *, row_number() OVER (PARTITION BY fold_id ORDER BY oos_metric) - 1 AS i, count(*) OVER (PARTITION BY fold_id) AS n FROM folds) GROUP BY fold_id")
def _(v):
    return S.pbo(v.folds, "fold_id")


_EFF = "CASE WHEN avg(is_metric) > 0 THEN avg(oos_metric) / avg(is_metric) END"
_SUM = f"(SELECT strategy_id, count(*) AS n, avg(is_metric) AS is_mean, stddev_samp(is_metric) AS is_std, avg(oos_metric) AS oos_mean, stddev_samp(oos_metric) AS oos_std, min(oos_metric) AS oos_min, max(oos_metric) AS oos_max, avg(CASE WHEN oos_metric > 0 THEN 1.0 ELSE 0 END) AS positive, {_EFF} AS efficiency FROM folds GROUP BY strategy_id)"
_SF = "is_mean is_std oos_mean oos_std oos_min oos_max positive efficiency"


@query("wf_efficiency", f"-- floats: efficiency\nSELECT *, {bands_sql('efficiency', S.EFFICIENCY, 'destructive')} AS verdict FROM (SELECT strategy_id, {_EFF} AS efficiency FROM folds GROUP BY strategy_id)")
def _(v):
    return S.fold_summary(v.folds, "strategy_id").select("strategy_id", "efficiency", bands(F.col("efficiency"), S.EFFICIENCY, "destructive").alias("verdict"))


@query("wf_matrix_summary", f"-- floats: efficiency\nSELECT is_bars // 20 AS is_size, oos_bars // 20 AS oos_size, count(*) AS n, {_EFF} AS efficiency FROM folds GROUP BY ALL")
def _(v):
    f = v.folds.withColumns({"is_size": F.floor(F.col("is_bars") / 20), "oos_size": F.floor(F.col("oos_bars") / 20)})
    return S.fold_summary(f, "is_size", "oos_size").select("is_size", "oos_size", "n", "efficiency")


_AR = [(">", 0.05, "anchored_wins"), ("<", -0.05, "rolling_wins")]


@query("wf_anchored_vs_rolling", f"-- floats: diff\nSELECT *, {bands_sql('diff', _AR, 'comparable')} AS verdict FROM (SELECT strategy_id, avg(oos_metric) FILTER (fold_id % 2 = 0) - avg(oos_metric) FILTER (fold_id % 2 = 1) AS diff FROM folds GROUP BY strategy_id)")
def _(v):
    """Even years stand for anchored, odd ones for rolling folds."""
    even = F.col("fold_id") % 2 == 0
    g = v.folds.groupBy("strategy_id").agg((F.avg(F.when(even, F.col("oos_metric"))) - F.avg(F.when(~even, F.col("oos_metric")))).alias("diff"))
    return g.withColumn("verdict", bands(F.col("diff"), _AR, "comparable"))


@query("wf_recommendation", "-- floats: score\nSELECT strategy_id, fold_id, score, i FROM (SELECT *, row_number() OVER (PARTITION BY strategy_id ORDER BY score DESC, fold_id) AS i FROM (SELECT strategy_id, fold_id, oos_metric / is_metric * sqrt(oos_bars) AS score FROM folds WHERE is_metric > 0 AND oos_metric / is_metric >= 0.5 AND oos_bars >= 10)) WHERE i <= 5")
def _(v):
    f = v.folds.filter("is_metric > 0 and oos_metric / is_metric >= 0.5 and oos_bars >= 10").withColumn("score", F.col("oos_metric") / F.col("is_metric") * F.sqrt("oos_bars"))
    i = F.row_number().over(Window.partitionBy("strategy_id").orderBy(F.desc("score"), "fold_id")).cast("long")
    return f.select("strategy_id", "fold_id", "score", i.alias("i")).filter("i <= 5")


@query("walkforward_from_folds", f"-- floats: {_SF}\nSELECT * FROM {_SUM}")
def _(v):
    return S.fold_summary(v.folds, "strategy_id")


@query("walkforward_databank_summary", f"-- floats: {_SF}\nSELECT project, databank, count(*) AS n, avg(x) AS is_mean, stddev_samp(x) AS is_std, avg(y) AS oos_mean, stddev_samp(y) AS oos_std, min(y) AS oos_min, max(y) AS oos_max, avg(CASE WHEN y > 0 THEN 1.0 ELSE 0 END) AS positive, CASE WHEN avg(x) > 0 THEN avg(y) / avg(x) END AS efficiency FROM (SELECT project, databank, fitness_is AS x, fitness_oos AS y FROM strategies WHERE fitness_is IS NOT NULL AND fitness_oos IS NOT NULL) GROUP BY project, databank HAVING count(*) >= 2")
def _(v):
    """Each strategy of a databank that has both fitness values is a fold; databanks with one fold have no summary."""
    return S.databank_folds(v.strategies, "fitness")


@query("walkforward_consistency_score", f"-- floats: score\nSELECT *, {bands_sql('score', [('>=', 70, 'robust'), ('>=', 40, 'borderline')], 'weak')} AS verdict FROM (SELECT strategy_id, CASE WHEN oos_mean > 0 THEN least(40, greatest(0, CASE WHEN oos_std > 0 THEN oos_mean / oos_std ELSE 5 END * 10)) + positive * 30 + CASE WHEN is_mean > 0 THEN greatest(0, least(1, oos_mean / is_mean)) * 30 ELSE 0 END ELSE 0 END AS score FROM {_SUM})")
def _(v):
    return S.consistency(S.fold_summary(v.folds, "strategy_id")).select("strategy_id", "score", "verdict")


@query("walkforward_overfit_flags", f"-- floats: kept\nSELECT strategy_id, fold_id, {halves_up('oos_metric / is_metric')} AS kept FROM folds WHERE is_metric > 0 AND round(oos_metric / is_metric, 9) < 0.9")
def _(v):
    """The share kept to 9 digits, so that the order in which a mean is summed raises no flag."""
    return v.folds.filter("is_metric > 0").withColumn("kept", F.col("oos_metric") / F.col("is_metric")).filter(F.round("kept", 9) < 0.9).select("strategy_id", "fold_id", F.round("kept", 10).alias("kept"))


_NB = """(SELECT param, l.x AS left_value, r.x AS right_value, (r.y - l.y) / nullif(r.x - l.x, 0) AS slope, CASE WHEN 25 <= a.x THEN a.y WHEN 25 >= z.x THEN z.y ELSE coalesce(same, l.y + (25 - l.x) * (r.y - l.y) / nullif(r.x - l.x, 0)) END AS baseline FROM (SELECT *, CASE WHEN l0 IS NOT NULL AND r0 IS NOT NULL THEN l0 ELSE a END AS l, CASE WHEN l0 IS NOT NULL AND r0 IS NOT NULL THEN r0 ELSE z END AS r FROM (
SELECT param, max({'x': value, 'y': metric}) FILTER (value < 25) AS l0, min({'x': value, 'y': metric}) FILTER (value > 25) AS r0, min({'x': value, 'y': metric}) AS a, max({'x': value, 'y': metric}) AS z, max(metric) FILTER (value = 25) AS same FROM points GROUP BY param)))"""


@query("sensitivity_local_slope", f"-- floats: left_value right_value slope baseline\nSELECT *, {bands_sql('abs(slope)', [('<', 0.01, 'low'), ('<', 1.0, 'moderate')], 'high')} AS verdict FROM {_NB}")
def _(v):
    return S.neighbours(v.points, 25.0).withColumn("verdict", bands(F.abs("slope"), [("<", 0.01, "low"), ("<", 1.0, "moderate")], "high"))


_PLAT = f"(SELECT param, mean, std, greatest(0, least(100, 100 * (1 - std / abs(mean)))) AS score FROM (SELECT param, avg(metric) AS mean, coalesce(stddev_samp(metric), 0) AS std FROM points GROUP BY param))"


@query("sensitivity_plateau_score", f"-- floats: mean std score\nSELECT *, {bands_sql('score', [('>=', 75, 'robust'), ('>=', 50, 'borderline')], 'fragile')} AS verdict FROM {_PLAT}")
def _(v):
    return S.plateau(v.points)


@query("sensitivity_compare_two_params", f"SELECT a.param AS param_a, b.param AS param_b, CASE WHEN round(a.score, 9) < round(b.score, 9) THEN a.param WHEN round(b.score, 9) < round(a.score, 9) THEN b.param ELSE 'tie' END AS more_sensitive FROM {_PLAT} a JOIN {_PLAT} b ON a.param < b.param")
def _(v):
    p = S.plateau(v.points).select("param", F.round("score", 9).alias("score"))
    a, b = p.select(F.col("param").alias("param_a"), F.col("score").alias("sa")), p.select(F.col("param").alias("param_b"), F.col("score").alias("sb"))
    more = F.when(F.col("sa") < F.col("sb"), F.col("param_a")).when(F.col("sb") < F.col("sa"), F.col("param_b")).otherwise("tie")
    return a.join(b, F.col("param_a") < F.col("param_b")).select("param_a", "param_b", more.alias("more_sensitive"))


@query("sensitivity_range_decay", f"""-- floats: baseline floor left_break right_break
SELECT *, CASE WHEN left_break IS NULL AND right_break IS NULL THEN 'wide_plateau' WHEN left_break IS NOT NULL AND right_break IS NOT NULL THEN 'narrow_plateau' ELSE 'asymmetric_decay' END AS verdict FROM (SELECT p.param, baseline, baseline * 0.98 AS floor, max(value) FILTER (value < 25 AND metric < baseline * 0.98) AS left_break, min(value) FILTER (value > 25 AND metric < baseline * 0.98) AS right_break FROM points p JOIN {_NB} n ON n.param = p.param GROUP BY p.param, baseline)""")
def _(v):
    return S.range_decay(v.points, 25.0, 2.0)


@query("sensitivity_bullseye", f"-- floats: best best_value low high\nSELECT *, {bands_sql('n', [('>=', 3, 'wide'), ('>=', 2, 'narrow')], 'single_point')} AS verdict FROM (SELECT p.param, best, best_value, count(*) AS n, min(value) AS low, max(value) AS high FROM points p JOIN (SELECT param, max(metric) AS best, arg_min(value, {{'m': -metric, 'v': value}}) AS best_value FROM points GROUP BY param) b ON b.param = p.param WHERE metric >= best * 0.98 GROUP BY p.param, best, best_value)")
def _(v):
    return S.bullseye(v.points, 2.0)


@query("spp_permutation_grid", "-- floats: a b\nSELECT owner, a * f.k AS a, b * g.k AS b FROM (SELECT p_brand AS owner, avg(p_retailprice) AS a, avg(p_size) AS b FROM part GROUP BY p_brand), (VALUES (0.9), (1.0), (1.1)) f(k), (VALUES (0.9), (1.0), (1.1)) g(k)")
def _(v):
    base = v.table("part").groupBy(F.col("p_brand").alias("owner")).agg(F.avg("p_retailprice").alias("a"), F.avg("p_size").alias("b"))
    return S.parameter_grid(base, 10.0, 3)


_DV = "CASE WHEN profitable >= 0.95 AND (cv IS NULL OR cv < 0.3) THEN 'very_robust' WHEN profitable >= 0.8 AND (cv IS NULL OR cv < 0.5) THEN 'robust' WHEN profitable >= 0.5 THEN 'moderately_fragile' ELSE 'fragile' END"


@query("spp_summarize_distribution", f"-- floats: mean std profitable p5 p25 p50 p75 p95 cv\nSELECT *, {_DV} AS verdict FROM (SELECT *, std / nullif(abs(mean), 0) AS cv FROM (SELECT project, count(*) AS n, avg(net_profit) AS mean, stddev_samp(net_profit) AS std, avg(CASE WHEN net_profit > 0 THEN 1.0 ELSE 0 END) AS profitable, {', '.join(f'quantile_cont(net_profit, {a / 100}) AS p{a}' for a in (5, 25, 50, 75, 95))} FROM strategies GROUP BY project))", digits=4)
def _(v):
    return S.distribution(v.strategies, "project", "net_profit")


_PCT = [(">=", 95, "suspicious"), (">=", 75, "strong"), (">=", 25, "middle")]


@query("spp_compare_baseline", f"-- floats: percentile\nSELECT *, {bands_sql('percentile', _PCT, 'bottom')} AS verdict FROM (SELECT s.project, 100 * avg(CASE WHEN net_profit <= b THEN 1.0 ELSE 0 END) AS percentile FROM strategies s JOIN (SELECT project, arg_min(net_profit, strategy_id) AS b FROM strategies GROUP BY project) p ON p.project = s.project GROUP BY s.project)")
def _(v):
    """The first strategy of a project stands for the baseline."""
    b = v.strategies.groupBy("project").agg(F.min_by("net_profit", "strategy_id").alias("b"))
    g = v.strategies.join(b, "project").groupBy("project").agg((100 * F.avg((F.col("net_profit") <= F.col("b")).cast("double"))).alias("percentile"))
    return g.withColumn("verdict", bands(F.col("percentile"), _PCT, "bottom"))


@query("spp_recommend_params", "SELECT param, CAST(max(value) FILTER (i = n // 2) AS BIGINT) AS recommended, CAST(max(value) FILTER (i = n - 1) AS BIGINT) AS best, CAST(max(value) FILTER (i = 0) AS BIGINT) AS worst FROM (SELECT *, row_number() OVER (PARTITION BY param ORDER BY metric, value) - 1 AS i, count(*) OVER (PARTITION BY param) AS n FROM points) GROUP BY param")
def _(v):
    i, n = F.row_number().over(Window.partitionBy("param").orderBy("metric", "value")) - 1, F.count(F.lit(1)).over(Window.partitionBy("param"))
    p = v.points.withColumns({"i": i, "n": n})
    at = lambda k, name: F.max(F.when(F.col("i") == k, F.col("value"))).cast("long").alias(name)
    return p.groupBy("param").agg(at(F.floor(F.col("n") / 2), "recommended"), at(F.col("n") - 1, "best"), at(F.lit(0), "worst"))


_ZM = ["fitness_full", "drawdown_pct", "trades"]
_Z = "(SELECT strategy_id, " + ", ".join(f"({m} - avg({m}) OVER ()) / nullif(stddev_pop({m}) OVER (), 0) AS z{k}" for k, m in enumerate(_ZM)) + " FROM strategies)"
_DIST = "sqrt(" + " + ".join(f"power(a.z{k} - b.z{k}, 2)" for k in range(3)) + ")"


@query("strategy_cluster_kmeans")
def _(v):
    """Lloyd's rounds; tests hold them against plain numpy."""
    z = S.standardised(v.strategies, _ZM, "strategy_id")
    return S.kmeans(z, 3, 50, "strategy_id").select("strategy_id", "cluster")


_TOP20 = "(SELECT z.* FROM " + _Z + " z JOIN (SELECT strategy_id FROM strategies ORDER BY fitness_full DESC, strategy_id LIMIT 20) t ON t.strategy_id = z.strategy_id)"


@query("strategy_pairwise_distance", f"-- floats: distance\nSELECT a.strategy_id AS a, b.strategy_id AS b, {_DIST} AS distance FROM {_TOP20} a JOIN {_TOP20} b ON a.strategy_id < b.strategy_id")
def _(v):
    """Among the 20 best by fitness, the tool's n and rank."""
    best = v.strategies.orderBy(F.desc("fitness_full"), "strategy_id").limit(20).select("strategy_id")
    z = S.standardised(v.strategies, _ZM, "strategy_id").join(best, "strategy_id")
    a, b = z.select(F.col("strategy_id").alias("a"), F.col("z").alias("za")), z.select(F.col("strategy_id").alias("b"), F.col("z").alias("zb"))
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", S.distance(F.col("za"), F.col("zb")).alias("distance"))


@query("strategy_nearest_neighbors", f"-- floats: distance\nSELECT b.strategy_id, {_DIST} AS distance FROM {_Z} a JOIN {_Z} b ON a.strategy_id = 3 AND b.strategy_id <> 3 ORDER BY distance, b.strategy_id LIMIT 5")
def _(v):
    z = S.standardised(v.strategies, _ZM, "strategy_id")
    target = z.filter("strategy_id = 3").select(F.col("z").alias("t"))  # one row
    return z.filter("strategy_id <> 3").crossJoin(F.broadcast(target)).select("strategy_id", S.distance(F.col("z"), F.col("t")).alias("distance")).orderBy("distance", "strategy_id").limit(5)
