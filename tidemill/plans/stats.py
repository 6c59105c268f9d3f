"""Registered queries: statistics, information, labels, mean reversion, pairs, signals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.common import bands, bands_sql, normal_cdf, ratio
from ..operators import stats as S
from ..operators.scan import quantiles
from .indicators import PAIRS, _pairs, _returns
from .registry import query

_R = "(SELECT series_id, idx, r FROM series WHERE r IS NOT NULL)"


def _p(df, z: str):
    """Two-sided normal p beside a statistic; the oracle holds the statistic, tests hold the p."""
    return df.withColumn("p", 2 * (1 - normal_cdf(F.abs(z))))


@query("hypothesis_paired_t_test", f"-- floats: mean t\nSELECT series_id, count(*) AS n, avg(a - b) AS mean, avg(a - b) / (stddev_samp(a - b) / sqrt(count(*))) AS t, abs(avg(a - b) / (stddev_samp(a - b) / sqrt(count(*)))) > 1.959963984540054 AS different FROM {PAIRS} GROUP BY series_id")
def _(v):
    return _p(S.paired_t(_pairs(v)), "t").withColumn("different", F.col("p") < 0.05).drop("p")


@query("hypothesis_sign_test", f"-- floats: z\nSELECT *, abs(z) > 1.959963984540054 AS different FROM (SELECT series_id, count(*) FILTER (a > b) AS plus, count(*) FILTER (a < b) AS minus, count(*) FILTER (a = b) AS ties, (count(*) FILTER (a > b) - count(*) FILTER (a <> b) / 2) / sqrt(count(*) FILTER (a <> b) / 4) AS z FROM {PAIRS} GROUP BY series_id)")
def _(v):
    return _p(S.sign_test(_pairs(v)), "z").withColumn("different", F.col("p") < 0.05).drop("p")


@query("hypothesis_wilcoxon_signed_rank", f"""-- floats: w_plus w_minus z
SELECT *, CASE WHEN n >= 5 THEN (least(w_plus, w_minus) - n * (n + 1) / 4) / sqrt(n * (n + 1) * (2 * n + 1) / 24) END AS z FROM (SELECT series_id, count(*) AS n, sum(CASE WHEN d > 0 THEN r ELSE 0 END) AS w_plus, sum(CASE WHEN d < 0 THEN r ELSE 0 END) AS w_minus FROM (
SELECT series_id, d, rank() OVER (PARTITION BY series_id ORDER BY abs(d)) + (count(*) OVER (PARTITION BY series_id, abs(d)) - 1) / 2 AS r FROM (SELECT series_id, a - b AS d FROM {PAIRS}) WHERE d <> 0) GROUP BY series_id)""")
def _(v):
    return S.wilcoxon(_pairs(v))


@query("hypothesis_unpaired_t_test", "-- floats: mean_a mean_b t\nSELECT symbol, count(*) FILTER (side = 'long') AS n_a, count(*) FILTER (side <> 'long') AS n_b, avg(pnl) FILTER (side = 'long') AS mean_a, avg(pnl) FILTER (side <> 'long') AS mean_b, (avg(pnl) FILTER (side = 'long') - avg(pnl) FILTER (side <> 'long')) / sqrt(var_samp(pnl) FILTER (side = 'long') / count(*) FILTER (side = 'long') + var_samp(pnl) FILTER (side <> 'long') / count(*) FILTER (side <> 'long')) AS t FROM trades GROUP BY symbol")
def _(v):
    return S.welch_t(v.trades.withColumn("is_long", F.col("side") == "long"), "pnl", "is_long", "symbol")


_M3 = "(m3 / power(s, 3) * sqrt(n * (n - 1)) / (n - 2))"
_M4 = "((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / power(s, 4) - 3) + 6))"
_MOM = "(SELECT symbol, CAST(count(*) AS DOUBLE) AS n, any_value(m) AS m, stddev_samp(pnl) AS s, avg(power(pnl - m, 3)) AS m3, avg(power(pnl - m, 4)) AS m4 FROM (SELECT symbol, pnl, avg(pnl) OVER (PARTITION BY symbol) AS m FROM trades) GROUP BY symbol)"
_SKEW = [(">", 0.5, "positive_skew"), ("<", -0.5, "negative_skew")]
_TAILS = [(">", 1.0, "fat_tails"), ("<", -1.0, "thin_tails")]


@query("stats_skewness", f"-- floats: skewness\nSELECT *, {bands_sql('skewness', _SKEW, 'symmetric')} AS verdict FROM (SELECT symbol, {_M3} AS skewness FROM {_MOM})")
def _(v):
    return v.trades.groupBy("symbol").agg(S.skewness(F.col("pnl")).alias("skewness")).withColumn("verdict", bands(F.col("skewness"), _SKEW, "symmetric"))


@query("stats_kurtosis", f"-- floats: kurtosis\nSELECT *, {bands_sql('kurtosis', _TAILS, 'normal_tails')} AS verdict FROM (SELECT symbol, {_M4} AS kurtosis FROM {_MOM})")
def _(v):
    return v.trades.groupBy("symbol").agg(S.kurtosis(F.col("pnl")).alias("kurtosis")).withColumn("verdict", bands(F.col("kurtosis"), _TAILS, "normal_tails"))


@query("stats_jarque_bera", f"-- floats: jb p\nSELECT symbol, jb, exp(-jb / 2) AS p FROM (SELECT symbol, n / 6 * (power({_M3}, 2) + power({_M4}, 2) / 4) AS jb FROM {_MOM})", digits=4)
def _(v):
    g = v.trades.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), S.skewness(F.col("pnl")).alias("s"), S.kurtosis(F.col("pnl")).alias("k"))
    return g.select("symbol", (F.col("n") / 6 * (F.col("s") ** 2 + F.col("k") ** 2 / 4)).alias("jb")).withColumn("p", F.exp(-F.col("jb") / 2))


@query("stats_autocorrelation", f"""-- floats: rho q p
SELECT *, exp(-q / 2) AS p FROM (SELECT *, n * (n + 2) * rho * rho / (n - 2) AS q FROM (SELECT series_id, count(*) AS n, sum(d * l) / sum(d * d) AS rho FROM (SELECT *, lag(d, 2) OVER (PARTITION BY series_id ORDER BY idx) AS l FROM (SELECT *, r - avg(r) OVER (PARTITION BY series_id) AS d FROM {_R})) GROUP BY series_id))""")
def _(v):
    return S.autocorrelation(_returns(v), "r", 2)


@query("stats_runs_test", f"""-- floats: expected z
SELECT series_id, runs, pos, n, p / n + 1 AS expected, (runs - (p / n + 1)) / sqrt(p * (p - n) / (CAST(n AS DOUBLE) * n * (n - 1))) AS z FROM (SELECT *, 2.0 * pos * (n - pos) AS p FROM (SELECT series_id, CAST(sum(CASE WHEN s <> l THEN 1 ELSE 0 END) + 1 AS BIGINT) AS runs, CAST(sum(s) AS BIGINT) AS pos, count(*) AS n FROM (SELECT *, lag(s) OVER (PARTITION BY series_id ORDER BY idx) AS l FROM (SELECT series_id, idx, CASE WHEN r > 0 THEN 1 ELSE 0 END AS s FROM {_R} WHERE r <> 0)) GROUP BY series_id))""")
def _(v):
    return S.runs_test(_returns(v), "r")


@query("stats_summary", f"-- floats: mean std low p25 median p75 high skewness kurtosis\nSELECT t.symbol, count(*) AS n, avg(pnl) AS mean, stddev_samp(pnl) AS std, min(pnl) AS low, quantile_cont(pnl, 0.25) AS p25, median(pnl) AS median, quantile_cont(pnl, 0.75) AS p75, max(pnl) AS high, any_value({_M3.replace('n *', 'g.n *').replace('(n - ', '(g.n - ').replace('sqrt(n', 'sqrt(g.n')}) AS skewness, any_value({_M4.replace('(n ', '(g.n ')}) AS kurtosis FROM trades t JOIN {_MOM} g ON g.symbol = t.symbol GROUP BY t.symbol")
def _(v):
    p = F.col("pnl")
    g = v.trades.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean"), F.stddev_samp(p).alias("std"), F.min(p).alias("low"), F.max(p).alias("high"), S.skewness(p).alias("skewness"), S.kurtosis(p).alias("kurtosis"))
    return g.join(quantiles(v.trades, ["symbol"], "pnl", {"p25": 0.25, "median": 0.5, "p75": 0.75}), "symbol")


_METRICS = ["net_profit", "drawdown_abs", "fitness_full", "fitness_oos"]


@query("portfolio_risk_metrics", f"""-- floats: mean median std p10 p90
SELECT metric, count(*) AS n, avg(value) AS mean, median(value) AS median, stddev_pop(value) AS std, quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.9) AS p90 FROM (UNPIVOT (SELECT {', '.join(_METRICS)} FROM strategies) ON {', '.join(_METRICS)} INTO NAME metric VALUE value) GROUP BY metric""", digits=4)
def _(v):
    u = v.strategies.unpivot("strategy_id", _METRICS, "metric", "value").filter("value is not null")
    g = u.groupBy("metric").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    return g.join(quantiles(u, ["metric"], "value", {"p10": 0.1, "median": 0.5, "p90": 0.9}), "metric")


@query("databank_metric_correlation", "-- floats: correlation\nSELECT project, databank, CASE WHEN count(*) >= 3 THEN corr(fitness_oos, drawdown_pct) END AS correlation, count(*) AS n FROM strategies WHERE fitness_oos IS NOT NULL GROUP BY ALL")
def _(v):
    g = v.strategies.filter("fitness_oos is not null").groupBy("project", "databank")
    return g.agg(F.when(F.count(F.lit(1)) >= 3, F.corr("fitness_oos", "drawdown_pct")).alias("correlation"), F.count(F.lit(1)).alias("n"))


def _bin(x: str, n: int, key: str = "series_id") -> str:
    w = f"OVER (PARTITION BY {key})"
    return f"CASE WHEN max({x}) {w} = min({x}) {w} THEN 0 ELSE least(floor(({x} - min({x}) {w}) / ((max({x}) {w} - min({x}) {w}) / {n})), {n} - 1) END"


@query("info_shannon_entropy", f"""-- floats: entropy share
SELECT *, {bands_sql('share', S.ENTROPY, 'concentrated')} AS verdict FROM (SELECT *, entropy / log2(20) AS share FROM (SELECT symbol, -sum(c / t * log2(c / t)) AS entropy FROM (SELECT symbol, count(*) AS c, sum(count(*)) OVER (PARTITION BY symbol) AS t FROM (SELECT symbol, {_bin('pnl', 20, 'symbol')} AS bin FROM trades) GROUP BY symbol, bin) GROUP BY symbol))""")
def _(v):
    return S.entropy(v.trades, "pnl", 20, "symbol")


_KL = """(WITH e AS (SELECT symbol, min(pnl) AS lo, max(pnl) AS hi FROM trades GROUP BY symbol), p AS (SELECT x.symbol AS a, y.symbol AS b, least(x.lo, y.lo) AS lo, greatest(x.hi, y.hi) AS hi FROM e x JOIN e y ON x.symbol < y.symbol),
c AS (SELECT a, b, least(floor((pnl - lo) / ((hi - lo) / 20)), 19) AS bin, count(*) FILTER (symbol = a) AS ca, count(*) FILTER (symbol = b) AS cb FROM p JOIN trades ON symbol = a OR symbol = b GROUP BY ALL), f AS (SELECT a, b, k, coalesce(ca, 0) AS ca, coalesce(cb, 0) AS cb FROM p, range(20) r(k) LEFT JOIN c USING (a, b) WHERE c.bin = k OR c.bin IS NULL),
g AS (SELECT p.a, p.b, r.k, coalesce(c.ca, 0) AS ca, coalesce(c.cb, 0) AS cb FROM p CROSS JOIN range(20) r(k) LEFT JOIN c ON c.a = p.a AND c.b = p.b AND c.bin = r.k),
h AS (SELECT a, b, (ca + 1e-12) / (sum(ca) OVER (PARTITION BY a, b) + 20e-12) AS p, (cb + 1e-12) / (sum(cb) OVER (PARTITION BY a, b) + 20e-12) AS q FROM g)
SELECT a, b, sum(p * ln(p / q)) AS ab, sum(q * ln(q / p)) AS ba, (sum(p * ln(p / q)) + sum(q * ln(q / p))) / 2 AS symmetrised FROM h GROUP BY a, b)""".replace(
    "f AS (SELECT a, b, k, coalesce(ca, 0) AS ca, coalesce(cb, 0) AS cb FROM p, range(20) r(k) LEFT JOIN c USING (a, b) WHERE c.bin = k OR c.bin IS NULL),\n", "\n"
)
_KLB = [("<", 0.05, "near_identical"), ("<", 0.2, "similar"), ("<", 1.0, "different")]


@query("info_kl_divergence", f"-- floats: ab ba symmetrised\nSELECT *, {bands_sql('ab', _KLB, 'very_different')} AS verdict FROM {_KL}")
def _(v):
    return S.kl_pairs(v.trades, "pnl", 20, "symbol").withColumn("verdict", bands(F.col("ab"), _KLB, "very_different"))


_DIV = [(">", 1.0, "highly_diversified"), (">", 0.3, "moderately_diversified"), (">", 0.1, "concentrated")]


@query("info_diversity_index", f"-- floats: diversity\nSELECT *, {bands_sql('diversity', _DIV, 'near_duplicates')} AS verdict FROM (SELECT avg(symmetrised) AS diversity, count(*) AS pairs FROM {_KL})")
def _(v):
    return S.kl_pairs(v.trades, "pnl", 20, "symbol").agg(F.avg("symmetrised").alias("diversity"), F.count(F.lit(1)).alias("pairs")).withColumn("verdict", bands(F.col("diversity"), _DIV, "near_duplicates"))


_MI = [("<", 0.05, "independent"), ("<", 0.2, "weakly_dependent"), ("<", 1.0, "dependent")]


@query("info_mutual_information", f"""-- floats: mi
SELECT *, {bands_sql('mi', _MI, 'strongly_dependent')} AS verdict FROM (SELECT series_id, sum(c / t * ln(c * t / (ta * tb))) AS mi FROM (SELECT series_id, c, CAST(sum(c) OVER (PARTITION BY series_id) AS DOUBLE) AS t, CAST(sum(c) OVER (PARTITION BY series_id, ia) AS DOUBLE) AS ta, CAST(sum(c) OVER (PARTITION BY series_id, ib) AS DOUBLE) AS tb FROM (
SELECT series_id, ia, ib, CAST(count(*) AS DOUBLE) AS c FROM (SELECT series_id, {_bin('a', 20)} AS ia, {_bin('b', 20)} AS ib FROM {PAIRS}) GROUP BY ALL)) GROUP BY series_id)""")
def _(v):
    return S.mutual_information(_pairs(v), 20).withColumn("verdict", bands(F.col("mi"), _MI, "strongly_dependent"))


_TE = [("<", 0.01, "none"), ("<", 0.05, "weak"), ("<", 0.2, "moderate")]


@query("info_transfer_entropy", f"""-- floats: te
SELECT *, {bands_sql('te', _TE, 'strong')} AS verdict FROM (SELECT series_id, sum(c / t * ln(c * ty / (tyx * tyy))) AS te FROM (SELECT series_id, c, sum(c) OVER (PARTITION BY series_id) AS t, sum(c) OVER (PARTITION BY series_id, y0) AS ty, sum(c) OVER (PARTITION BY series_id, y0, x0) AS tyx, sum(c) OVER (PARTITION BY series_id, y0, y1) AS tyy FROM (
SELECT series_id, x0, y0, y1, CAST(count(*) AS DOUBLE) AS c FROM (SELECT series_id, {_bin('b', 8)} AS x0, {_bin('a', 8)} AS y0, {_bin('f', 8)} AS y1 FROM (SELECT *, lead(a) OVER (PARTITION BY series_id ORDER BY idx) AS f FROM {PAIRS}) WHERE f IS NOT NULL) GROUP BY ALL)) GROUP BY series_id)""")
def _(v):
    return S.transfer_entropy(_pairs(v), 8).withColumn("verdict", bands(F.col("te"), _TE, "strong"))


@query("label_triple_barrier", """-- floats: return_pct
SELECT series_id, idx, CASE WHEN hit IS NULL THEN 0 WHEN hit.r >= 150 THEN 1 ELSE -1 END AS label, coalesce(hit.i, last.i, idx) AS exit_index, coalesce(hit.r, last.r, 0.0) AS return_pct FROM (
SELECT series_id, idx, list_filter(xs, lambda x: x.r >= 150 OR x.r <= -60)[1] AS hit, xs[len(xs)] AS last FROM (SELECT series_id, idx, list_transform(ys, lambda y: {'i': y.i, 'r': (y.p - "close") / "close" * 100}) AS xs FROM (SELECT series_id, idx, "close", list({'i': idx, 'p': "close"}) OVER (PARTITION BY series_id ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) AS ys FROM bars)))""")
def _(v):
    return S.triple_barrier(v.bars, 150.0, 60.0, 10).select("series_id", "idx", "label", "exit_index", "return_pct")


@query("label_meta_label_outcomes", "-- floats: accuracy\nSELECT strategy_id, count(*) FILTER (k <> 0) AS fired, count(*) FILTER (k <> 0 AND pnl > 0) AS correct, count(*) FILTER (k <> 0 AND pnl > 0) / nullif(count(*) FILTER (k <> 0), 0) AS accuracy FROM (SELECT *, seq % 3 - 1 AS k FROM trades) GROUP BY strategy_id")
def _(v):
    k = F.col("seq") % 3 - 1
    fired, good = F.count(F.when(k != 0, 1)), F.count(F.when((k != 0) & (F.col("pnl") > 0), 1))
    return v.trades.groupBy("strategy_id").agg(fired.alias("fired"), good.alias("correct"), ratio(good, fired).alias("accuracy"))


@query("bet_size_from_probability")
def _(v):
    """Size 2 cdf(z) - 1 of a strategy's win rate; tests hold it against the error function."""
    g = v.trades.groupBy("strategy_id").agg(F.avg((F.col("pnl") > 0).cast("double")).alias("p")).filter("p > 0 and p < 1")
    g = g.withColumn("z", (F.col("p") - 0.5) / F.sqrt(F.col("p") * (1 - F.col("p"))))
    return g.withColumn("size", 2 * normal_cdf("z") - 1).withColumn("stepped", F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.bround(F.col("size") / 0.05, 0) * 0.05)))


@query("bet_size_average_active", "-- floats: average\nSELECT series_id, t, avg(r) AS average, count(*) AS active FROM (SELECT series_id, r, unnest(range(idx, idx + greatest(idx % 5, 1))) AS t FROM (SELECT series_id, idx, r FROM series WHERE r IS NOT NULL)) GROUP BY ALL")
def _(v):
    return S.average_active(_returns(v).withColumnRenamed("r", "size"), F.col("idx") % 5)


_W = S.fracdiff_weights(0.4, 1e-2)


@query("fracdiff_weights", f"-- floats: w\nSELECT series_id, k, w FROM (SELECT DISTINCT series_id FROM series), (SELECT unnest(range({len(_W)})) AS k, unnest({_W}) AS w)", digits=9)
def _(v):
    rows = F.posexplode(F.array(*(F.lit(w) for w in _W)))
    return v.series.select("series_id").distinct().select("series_id", rows.alias("k", "w")).withColumn("k", F.col("k").cast("long"))


def _frac_sql(d: float, tol: float) -> str:
    w = S.fracdiff_weights(d, tol)
    terms = " + ".join(f"{x!r} * lag(v, {k}) OVER w" for k, x in enumerate(w))
    return f"(SELECT series_id, idx, {terms} AS x FROM series WINDOW w AS (PARTITION BY series_id ORDER BY idx) QUALIFY row_number() OVER w >= {len(w)})"


@query("fracdiff_apply", f"-- floats: fracdiff\nSELECT series_id, idx, x AS fracdiff FROM {_frac_sql(0.4, 1e-2)}", digits=3)
def _(v):
    return S.fracdiff(v.series, "v", 0.4, 1e-2).select("series_id", "idx", "fracdiff")


def _adf_sql(src: str, x: str, keys: str = "series_id") -> str:
    return f"""(SELECT {keys}, n, CASE WHEN n >= 30 THEN coalesce(sxy / sxx / sqrt(greatest(syy - sxy * sxy / sxx, 0) / (m - 2) / sxx), 0) ELSE 0 END AS adf FROM (SELECT {keys}, count(*) AS n, regr_count(y, x) AS m, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy, regr_syy(y, x) AS syy FROM (SELECT {keys}, l AS x, {x} - l AS y FROM (SELECT *, lag({x}) OVER (PARTITION BY {keys} ORDER BY idx) AS l FROM {src})) GROUP BY {keys}))"""


_GRID = [0.2, 0.4, 0.6]


@query("fracdiff_find_min_d", "-- floats: min_d\nSELECT series_id, min(d) FILTER (adf < -3) AS min_d FROM (" + " UNION ALL ".join(f"SELECT series_id, {d}::DOUBLE AS d, adf FROM {_adf_sql(_frac_sql(d, 1e-2), 'x')}" for d in _GRID) + ") GROUP BY series_id")
def _(v):
    """Lowest order of the grid whose differences pass the ADF heuristic."""
    out = None
    for d in _GRID:
        a = S.adf(S.fracdiff(v.series, "v", d, 1e-2), "fracdiff").select("series_id", F.lit(d).alias("d"), "adf")
        out = a if out is None else out.union(a)
    return out.groupBy("series_id").agg(F.min(F.when(F.col("adf") < -3, F.col("d"))).alias("min_d"))


@query("mean_reversion_hurst", f"""-- floats: hurst
WITH b AS (SELECT series_id, v, row_number() OVER (PARTITION BY series_id ORDER BY idx) - 1 AS i, count(*) OVER (PARTITION BY series_id) AS n FROM series), z AS (SELECT b.*, s.size, i // s.size AS chunk FROM b JOIN (SELECT unnest([8, 16, 32, 64, 128, 256, 512, 1024, 2048, 4096]) AS size) s ON s.size <= n // 2 AND i // s.size < n // s.size),
c AS (SELECT *, sum(d) OVER (PARTITION BY series_id, size, chunk ORDER BY i ROWS UNBOUNDED PRECEDING) AS c FROM (SELECT *, v - avg(v) OVER (PARTITION BY series_id, size, chunk) AS d FROM z)), r AS (SELECT series_id, size, (greatest(max(c), 0) - least(min(c), 0)) / stddev_pop(v) AS rs FROM c GROUP BY series_id, size, chunk HAVING stddev_pop(v) > 0), m AS (SELECT series_id, size, avg(rs) AS rs FROM r GROUP BY ALL)
SELECT *, {bands_sql('hurst', S.HURST, 'strongly_trending')} AS verdict FROM (SELECT series_id, count(*) AS sizes, CASE WHEN count(*) >= 3 THEN regr_slope(ln(rs), ln(size)) END AS hurst FROM m GROUP BY series_id)""", digits=5)
def _(v):
    return S.hurst(v.series, "v")


@query("mean_reversion_ou_half_life", f"""-- floats: theta half_life
SELECT *, CASE WHEN half_life IS NOT NULL THEN {bands_sql('half_life', S.HALF_LIFE, 'very_slow')} END AS verdict FROM (SELECT *, CASE WHEN n >= 30 AND theta > 0 AND theta < 1 THEN -ln(2) / ln(1 - theta) END AS half_life FROM (SELECT series_id, -regr_slope(v - l, l) AS theta, count(*) AS n FROM (SELECT *, lag(v) OVER (PARTITION BY series_id ORDER BY idx) AS l FROM series) GROUP BY series_id))""")
def _(v):
    return S.half_life(v.series, "v")


@query("mean_reversion_cusum_detector", """-- floats: value
SELECT series_id, idx, CASE WHEN h >= 8 THEN 'up' ELSE 'down' END AS direction, CASE WHEN h >= 8 THEN h ELSE l END AS value FROM (
WITH RECURSIVE x AS (SELECT series_id, idx, r - avg(r) OVER (PARTITION BY series_id) AS d FROM series WHERE r IS NOT NULL), f AS (SELECT series_id, 0::BIGINT AS idx, 0.0::DOUBLE AS h, 0.0::DOUBLE AS l FROM x GROUP BY series_id
UNION ALL SELECT x.series_id, x.idx, greatest(0.0, CASE WHEN f.h >= 8 THEN 0.0 ELSE f.h END + d), least(0.0, CASE WHEN f.h < 8 AND f.l <= -8 THEN 0.0 ELSE f.l END + d) FROM f JOIN x ON x.series_id = f.series_id AND x.idx = f.idx + 1) SELECT * FROM f) WHERE h >= 8 OR l <= -8""")
def _(v):
    return S.cusum(_returns(v), "r", 8.0)


@query("mean_reversion_cusum_summary", """-- floats: last_up last_down
SELECT series_id, count(*) FILTER (idx > 0 AND (h >= 2 OR l <= -2)) AS n_breaks, arg_max(CASE WHEN h >= 2 THEN 0.0 ELSE h END, idx) AS last_up, arg_max(CASE WHEN l <= -2 THEN 0.0 ELSE l END, idx) AS last_down, CASE WHEN count(*) FILTER (idx > 0 AND (h >= 2 OR l <= -2)) = 0 THEN 'stable' WHEN count(*) FILTER (idx > 0 AND (h >= 2 OR l <= -2)) <= 3 THEN 'occasional_breaks' ELSE 'frequent_breaks' END AS verdict FROM (
WITH RECURSIVE x AS (SELECT series_id, idx, r - 0.05 AS d FROM series WHERE r IS NOT NULL), f AS (SELECT series_id, 0::BIGINT AS idx, 0.0::DOUBLE AS h, 0.0::DOUBLE AS l FROM x GROUP BY series_id
UNION ALL SELECT x.series_id, x.idx, greatest(0.0, CASE WHEN f.h >= 2 THEN 0.0 ELSE f.h END + d), least(0.0, CASE WHEN f.l <= -2 THEN 0.0 ELSE f.l END + d) FROM f JOIN x ON x.series_id = f.series_id AND x.idx = f.idx + 1) SELECT * FROM f) GROUP BY series_id""")
def _(v):
    """Around a given level instead of the mean: breaks, final sums and a verdict for each series."""
    return S.cusum_summary(_returns(v), "r", 2.0, reference=0.05)


@query("mean_reversion_adf_heuristic", f"-- floats: adf\nSELECT *, {bands_sql('adf', S.ADF, 'none')} AS level FROM {_adf_sql('series', 'v')}", digits=5)
def _(v):
    return S.adf(v.series, "v")


def level_pairs(v):
    """Levels of every pair of series (a before b by name), aligned by idx."""
    x, y = (v.series.select(F.col("series_id").alias(s), "idx", F.col("v").alias(c)) for s, c in (("sym_a", "a"), ("sym_b", "b")))
    return x.join(y, "idx").filter("sym_a < sym_b")


_LP = "(SELECT x.series_id AS sym_a, y.series_id AS sym_b, x.idx, x.v AS a, y.v AS b FROM series x JOIN series y ON x.idx = y.idx AND x.series_id < y.series_id)"
_EG = f"""(WITH f AS (SELECT sym_a, sym_b, regr_slope(a, b) AS hedge_ratio, regr_intercept(a, b) AS intercept FROM {_LP} GROUP BY ALL), e AS (SELECT p.sym_a, p.sym_b, idx, a - hedge_ratio * b - intercept AS e FROM {_LP} p JOIN f USING (sym_a, sym_b))
SELECT f.*, n, adf, {bands_sql('adf', S.ADF, 'none')} AS level FROM f JOIN {_adf_sql('e', 'e', 'sym_a, sym_b')} USING (sym_a, sym_b))"""


@query("cointegration_engle_granger", f"-- floats: hedge_ratio intercept adf\nSELECT * FROM {_EG}", digits=4)
def _(v):
    return S.engle_granger(level_pairs(v), "sym_a", "sym_b")


@query("cointegration_pair_scan", f"-- floats: hedge_ratio intercept adf\nSELECT * FROM {_EG} ORDER BY adf, sym_a, sym_b LIMIT 5", digits=4)
def _(v):
    return S.engle_granger(level_pairs(v), "sym_a", "sym_b").orderBy("adf", "sym_a", "sym_b").limit(5)


_SP = f"(SELECT *, a - 0.5 * b AS s FROM {_LP})"


@query("cointegration_spread_series", f"-- floats: s mean std\nSELECT sym_a, sym_b, idx, s, avg(s) OVER w AS mean, stddev_samp(s) OVER w AS std FROM {_SP} WINDOW w AS (PARTITION BY sym_a, sym_b)", digits=3)
def _(v):
    w = Window.partitionBy("sym_a", "sym_b")
    return level_pairs(v).withColumn("s", F.col("a") - 0.5 * F.col("b")).select("sym_a", "sym_b", "idx", "s", F.avg("s").over(w).alias("mean"), F.stddev_samp("s").over(w).alias("std"))


_Z = [("<", -2.0, "long_y_short_x"), (">", 2.0, "short_y_long_x")]


@query("cointegration_zscore", f"""-- floats: z
SELECT *, CASE WHEN z < -2 THEN 'long_y_short_x' WHEN z > 2 THEN 'short_y_long_x' WHEN abs(z) > 1 THEN 'weak' ELSE 'none' END AS signal FROM (SELECT sym_a, sym_b, (s - avg(s) OVER w) / nullif(stddev_samp(s) OVER w, 0) AS z FROM {_SP} WINDOW w AS (PARTITION BY sym_a, sym_b ORDER BY idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) QUALIFY row_number() OVER (PARTITION BY sym_a, sym_b ORDER BY idx DESC) = 1)""")
def _(v):
    """z of the last spread against the 20 last."""
    last = F.row_number().over(Window.partitionBy("sym_a", "sym_b").orderBy(F.desc("idx")))
    s = level_pairs(v).withColumn("s", F.col("a") - 0.5 * F.col("b")).withColumn("_i", last).filter("_i <= 20")
    g = s.groupBy("sym_a", "sym_b").agg(ratio(F.max(F.when(F.col("_i") == 1, F.col("s"))) - F.avg("s"), F.stddev_samp("s")).alias("z"))
    z = F.col("z")
    return g.withColumn("signal", F.when(z < -2, "long_y_short_x").when(z > 2, "short_y_long_x").when(F.abs(z) > 1, "weak").otherwise("none"))


def _rank(x: str, keys: str) -> str:
    return f"(rank() OVER (PARTITION BY {keys} ORDER BY {x}) + (count(*) OVER (PARTITION BY {keys}, {x}) - 1) / 2)"


def _ic_sql(src: str, keys: str) -> str:
    return f"(SELECT *, ic * sqrt((n - 2) / greatest(1e-9, 1 - ic * ic)) AS t, {bands_sql('abs(ic)', S.IC, 'noise')} AS verdict FROM (SELECT {keys}, coalesce(corr(ra, rb), 0) AS ic, count(*) AS n FROM (SELECT {keys}, {_rank('a', keys)} AS ra, {_rank('b', keys)} AS rb FROM {src}) GROUP BY {keys}))"


@query("signal_information_coefficient", f"-- floats: ic t\nSELECT * FROM {_ic_sql('(SELECT series_id, idx, volume AS a, ' + chr(34) + 'close' + chr(34) + ' AS b FROM bars)', 'series_id')}")
def _(v):
    return S.spearman(v.bars.select("series_id", F.col("volume").alias("a"), F.col("close").alias("b")))


_HZ = [1, 2, 5]
_FWD = "(SELECT * FROM (" + " UNION ALL ".join(f'SELECT series_id, {h} AS horizon, volume AS a, lead("close", {h}) OVER (PARTITION BY series_id ORDER BY idx) / "close" - 1 AS b FROM bars' for h in _HZ) + ") WHERE b IS NOT NULL)"


@query("signal_ic_decay", f"-- floats: ic t\nSELECT * FROM {_ic_sql(_FWD, 'series_id, horizon')}")
def _(v):
    """Rank correlation of the signal with the return over each horizon."""
    w = Window.partitionBy("series_id").orderBy("idx")
    out = v.bars.withColumn("_f", F.array(*(F.struct(F.lit(h).alias("horizon"), F.lead("close", h).over(w).alias("f")) for h in _HZ))).select("series_id", F.col("volume").alias("a"), "close", F.inline("_f"))
    return S.spearman(out.filter("f is not null").withColumn("b", F.col("f") / F.col("close") - 1), "series_id", "horizon")


@query("signal_hit_rate_by_quantile", """-- floats: mean_signal mean_return hit_rate
SELECT symbol AS series_id, CAST(least(i // (n // 5), 4) + 1 AS BIGINT) AS quantile, count(*) AS n, avg(hold_hours) AS mean_signal, avg(pnl) AS mean_return, avg(CASE WHEN pnl > 0 THEN 1.0 ELSE 0 END) AS hit_rate FROM (SELECT symbol, hold_hours, pnl, row_number() OVER (PARTITION BY symbol ORDER BY hold_hours, pnl) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM trades) t GROUP BY symbol, least(i // (t.n // 5), 4)""")
def _(v):
    return S.quantile_returns(v.trades.select(F.col("symbol").alias("series_id"), F.col("hold_hours").alias("a"), F.col("pnl").alias("b")), 5)


_SNR = [(">", 10, "excellent"), (">", 3, "good"), (">", 0, "marginal")]


@query("signal_to_noise_ratio", f"-- floats: snr db\nSELECT *, {bands_sql('db', _SNR, 'noise_dominated')} AS verdict FROM (SELECT series_id, var_samp(a) / nullif(var_samp(b), 0) AS snr, 10 * log10(var_samp(a) / nullif(var_samp(b), 0)) AS db FROM {PAIRS} GROUP BY series_id)")
def _(v):
    g = _pairs(v).groupBy("series_id").agg(ratio(F.var_samp("a"), F.var_samp("b")).alias("snr"))
    return g.withColumn("db", 10 * F.log10("snr")).withColumn("verdict", bands(F.col("db"), _SNR, "noise_dominated"))


_TURN = [("<", 0.05, "low"), ("<", 0.2, "moderate"), ("<", 0.5, "high")]


@query("signal_turnover", f"-- floats: turnover\nSELECT *, {bands_sql('turnover', _TURN, 'extreme')} AS verdict FROM (SELECT series_id, avg(abs(r - l)) / avg(abs(r)) AS turnover FROM (SELECT *, lag(r) OVER (PARTITION BY series_id ORDER BY idx) AS l FROM {_R}) GROUP BY series_id)")
def _(v):
    d = F.abs(F.col("r") - F.lag("r").over(Window.partitionBy("series_id").orderBy("idx")))
    g = _returns(v).withColumn("d", d).groupBy("series_id").agg(ratio(F.avg("d"), F.avg(F.abs("r"))).alias("turnover"))
    return g.withColumn("verdict", bands(F.col("turnover"), _TURN, "extreme"))
