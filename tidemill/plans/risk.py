"""Registered queries: returns, risk, drawdowns, benchmarks, exposure, attribution, sizing."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.common import bands, bands_sql, halves_up, hhi, normal_quantile, ratio, with_total
from ..operators import pairs as P
from ..operators import risk as R
from ..operators.scan import quantiles
from .indicators import PAIRS, _pairs, _returns
from .registry import query

_R = "(SELECT series_id, idx, r FROM series WHERE r IS NOT NULL)"
_DD = "(SELECT *, (peak - v) / peak AS dd FROM (SELECT *, max(v) OVER (PARTITION BY series_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS peak FROM series))"


def _agg(name: str, col: str, sql: str, value):
    @query(name, f"-- floats: {col}\nSELECT series_id, {sql} AS {col} FROM {_R} GROUP BY series_id")
    def _(v):
        return _returns(v).groupBy("series_id").agg(value().alias(col))


_agg("ratios_sharpe", "sharpe", "avg(r) / nullif(stddev_samp(r), 0) * sqrt(252.0)", lambda: R.sharpe(F.col("r")))
_agg("ratios_sortino", "sortino", "avg(r - 0.02 / 252) / sqrt(sum(CASE WHEN r < 0.02 / 252 THEN (r - 0.02 / 252) ** 2 END) / (count(*) FILTER (r < 0.02 / 252) - 1)) * sqrt(252.0)", lambda: R.sortino(F.col("r"), rf=0.02))
_agg("ratios_omega", "omega", "sum(greatest(r - 0.01, 0)) / nullif(sum(greatest(0.01 - r, 0)), 0)", lambda: R.omega(F.col("r"), 0.01))
_agg("tail_risk_parametric_var", "var", f"-(avg(r) + {normal_quantile(0.05)!r} * stddev_samp(r))", lambda: R.parametric_var(F.col("r"), 0.95))
_agg("stats_time_weighted_return", "twr", "product(1 + r / 10000) - 1", lambda: F.product(1 + F.col("r") / 10000) - 1)


@query("strategy_risk_adjusted_metrics", f"""-- floats: sharpe sortino
SELECT series_id, avg(r) / nullif(stddev_pop(r), 0) * sqrt(252.0) AS sharpe, avg(r) / nullif(sqrt(sum(CASE WHEN r < 0 THEN r * r ELSE 0 END) / count(*)), 0) * sqrt(252.0) AS sortino FROM {_R} GROUP BY series_id""")
def _(v):
    return _returns(v).groupBy("series_id").agg(R.sharpe(F.col("r"), population=True).alias("sharpe"), R.sortino(F.col("r"), population=True).alias("sortino"))


@query("ratios_information", f"-- floats: information_ratio tracking_error\nSELECT series_id, avg(a - b) / nullif(stddev_samp(a - b), 0) * sqrt(252.0) AS information_ratio, stddev_samp(a - b) AS tracking_error FROM {PAIRS} GROUP BY series_id")
def _(v):
    d = F.col("a") - F.col("b")
    return _pairs(v).groupBy("series_id").agg(R.sharpe(d).alias("information_ratio"), F.stddev_samp(d).alias("tracking_error"))


_GROW = f"(SELECT series_id, arg_min(v, idx) AS a, arg_max(v, idx) AS z, max(dd) * 100 AS max_drawdown_pct, count(*) / 252 AS years FROM {_DD} GROUP BY series_id)"
for _name in ("ratios_calmar", "ratios_mar"):

    @query(_name, f"-- floats: max_drawdown_pct cagr_pct calmar\nSELECT *, cagr_pct / nullif(max_drawdown_pct, 0) AS calmar FROM (SELECT series_id, max_drawdown_pct, ((z / a) ** (1 / years) - 1) * 100 AS cagr_pct FROM {_GROW})")
    def _(v):
        return R.growth(v.series).select("series_id", "max_drawdown_pct", "cagr_pct", "calmar")


@query("ratios_pain_index", f"-- floats: pain_index max_drawdown\nSELECT series_id, avg(dd) AS pain_index, max(dd) AS max_drawdown FROM {_DD} GROUP BY series_id")
def _(v):
    return R.with_drawdown(v.series).groupBy("series_id").agg(F.avg("dd").alias("pain_index"), F.max("dd").alias("max_drawdown"))


@query("ratios_ulcer_index", f"-- floats: ulcer_index\nSELECT series_id, sqrt(avg(dd * dd)) AS ulcer_index FROM {_DD} GROUP BY series_id")
def _(v):
    return R.with_drawdown(v.series).groupBy("series_id").agg(F.sqrt(F.avg(F.col("dd") ** 2)).alias("ulcer_index"))


@query("tail_risk_historical_var", f"-- floats: var\nWITH q AS (SELECT series_id, -quantile_cont(r, 0.05) AS var FROM {_R} GROUP BY series_id) SELECT series_id, any_value(var) AS var, count(*) FILTER (var > 0 AND r <= -var) AS tail_size FROM {_R} JOIN q USING (series_id) GROUP BY series_id")
def _(v):
    q = quantiles(_returns(v), ["series_id"], "r", {"q": 0.05}).select("series_id", (-F.col("q")).alias("var"))
    return _returns(v).join(q, "series_id").groupBy("series_id").agg(F.max("var").alias("var"), F.count(F.when((F.col("var") > 0) & (F.col("r") <= -F.col("var")), 1)).alias("tail_size"))


@query("tail_risk_cvar", f"""-- floats: cvar var
SELECT series_id, -avg(r) AS cvar, -max(r) AS var, count(*) AS tail_size FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY r) AS i, count(*) OVER (PARTITION BY series_id) AS n FROM {_R}) WHERE i <= greatest(round_even(0.05 * n, 0), 1) GROUP BY series_id""")
def _(v):
    return R.worst_share(_returns(v), "r", 0.95)


@query("tail_risk_tail_ratio", f"-- floats: tail_ratio\nSELECT *, {bands_sql('tail_ratio', [('>', 1.2, 'fat_upside'), ('<', 0.8, 'fat_downside')], 'symmetric')} AS verdict FROM (SELECT series_id, abs(quantile_cont(r, 0.95)) / nullif(abs(quantile_cont(r, 0.05)), 0) AS tail_ratio FROM {_R} GROUP BY series_id)")
def _(v):
    g = quantiles(_returns(v), ["series_id"], "r", {"high": 0.95, "low": 0.05}).select("series_id", ratio(F.abs("high"), F.abs("low")).alias("tail_ratio"))
    return g.withColumn("verdict", bands(F.col("tail_ratio"), [(">", 1.2, "fat_upside"), ("<", 0.8, "fat_downside")], "symmetric"))


@query("tail_risk_gain_to_pain", f"-- floats: gain_to_pain\nSELECT *, {bands_sql('gain_to_pain', [('>', 2, 'robust'), ('>', 1, 'acceptable')], 'weak')} AS verdict FROM (SELECT series_id, sum(greatest(r, 0)) / nullif(sum(greatest(-r, 0)), 0) AS gain_to_pain FROM {_R} GROUP BY series_id)")
def _(v):
    return _returns(v).groupBy("series_id").agg(R.omega(F.col("r")).alias("gain_to_pain")).withColumn("verdict", bands(F.col("gain_to_pain"), [(">", 2, "robust"), (">", 1, "acceptable")], "weak"))


_EP = """(WITH m AS (SELECT series_id, idx, v, CASE WHEN v >= coalesce(max(v) OVER (PARTITION BY series_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), v) THEN 1 ELSE 0 END AS new FROM series), i AS (SELECT *, sum(new) OVER (PARTITION BY series_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS island FROM m),
g AS (SELECT series_id, island, min(idx) AS start, max(idx) AS last, count(*) AS n, max(v) FILTER (new = 1) AS peak, min(v) AS low, min(idx) FILTER (new = 0 AND v = lo) AS trough FROM (SELECT *, min(v) OVER (PARTITION BY series_id, island) AS lo FROM i) GROUP BY series_id, island),
h AS (SELECT *, lead(start) OVER (PARTITION BY series_id ORDER BY island) AS recovery FROM g)
SELECT series_id, start, trough, recovery, (peak - low) / peak * 100 AS depth_pct, coalesce(recovery, last + 1) - start AS duration, trough - start AS drop_bars, recovery - trough AS recovery_bars FROM h WHERE n > 1)"""
for _name in ("drawdown_periods", "strategy_drawdown_periods"):

    @query(_name, f"-- floats: depth_pct\nSELECT * FROM {_EP}")
    def _(v):
        return R.drawdown_episodes(v.series)


@query("drawdown_recovery_curve", f"-- floats: mean_duration mean_recovery\nSELECT series_id, count(recovery) AS n_recovered, count(*) - count(recovery) AS ongoing, avg(CASE WHEN recovery IS NOT NULL THEN duration END) AS mean_duration, max(CASE WHEN recovery IS NOT NULL THEN duration END) AS max_duration, avg(recovery_bars) AS mean_recovery, max(recovery_bars) AS max_recovery FROM {_EP} GROUP BY series_id")
def _(v):
    closed = F.when(F.col("recovery").isNotNull(), F.col("duration"))
    return R.drawdown_episodes(v.series).groupBy("series_id").agg(F.count("recovery").alias("n_recovered"), (F.count(F.lit(1)) - F.count("recovery")).alias("ongoing"), F.avg(closed).alias("mean_duration"), F.max(closed).alias("max_duration"), F.avg("recovery_bars").alias("mean_recovery"), F.max("recovery_bars").alias("max_recovery"))


@query("drawdown_time_underwater", f"-- floats: share\nSELECT *, {bands_sql('share', R.UNDERWATER, 'almost_always_underwater')} AS verdict FROM (SELECT series_id, avg(CASE WHEN dd > 0 THEN 1.0 ELSE 0 END) AS share FROM {_DD} GROUP BY series_id)")
def _(v):
    g = R.with_drawdown(v.series).groupBy("series_id").agg(F.avg((F.col("dd") > 0).cast("double")).alias("share"))
    return g.withColumn("verdict", bands(F.col("share"), R.UNDERWATER, "almost_always_underwater"))


@query("drawdown_pain_decomposition", f"-- floats: bucket pain\nSELECT series_id, bucket, sum(dd) * 100 AS pain, count(*) AS bars FROM (SELECT *, CASE WHEN dd >= 0.9 THEN 90.0 WHEN dd >= 0.7 THEN 70.0 WHEN dd >= 0.5 THEN 50.0 WHEN dd >= 0.2 THEN 20.0 END AS bucket FROM {_DD}) WHERE bucket IS NOT NULL GROUP BY ALL", digits=4)
def _(v):
    return R.pain_buckets(v.series, [20, 50, 70, 90])


@query("strategy_equity_curve_stats", f"""-- floats: max_drawdown_abs max_drawdown_pct recovery_factor hit_ratio
WITH s AS (SELECT *, v - lag(v) OVER (PARTITION BY series_id ORDER BY idx) AS d FROM {_DD}), u AS (SELECT series_id, max(c) AS longest_underwater FROM (SELECT series_id, g, count(*) AS c FROM (SELECT series_id, dd, idx - row_number() OVER (PARTITION BY series_id, dd > 0 ORDER BY idx) AS g FROM {_DD}) WHERE dd > 0 GROUP BY ALL) GROUP BY series_id)
SELECT s.series_id, max(peak - v) AS max_drawdown_abs, max(dd) * 100 AS max_drawdown_pct, (arg_max(v, idx) - arg_min(v, idx)) / nullif(max(peak - v), 0) AS recovery_factor, arg_max(v, idx) >= max(peak) AS ends_at_high, count(*) FILTER (d > 0) / count(d) AS hit_ratio, any_value(longest_underwater) AS longest_underwater FROM s JOIN u USING (series_id) GROUP BY s.series_id""", digits=4)
def _(v):
    d = R.with_drawdown(v.series).withColumn("d", F.col("v") - F.lag("v").over(Window.partitionBy("series_id").orderBy("idx")))
    under = R.longest_runs(d, F.when(F.col("dd") > 0, F.lit("under")), "series_id", "idx").select("series_id", F.col("longest").alias("longest_underwater"))
    last, worst = F.max_by("v", "idx"), F.max(F.col("peak") - F.col("v"))
    g = d.groupBy("series_id").agg(worst.alias("max_drawdown_abs"), (F.max("dd") * 100).alias("max_drawdown_pct"), ratio(last - F.min_by("v", "idx"), worst).alias("recovery_factor"), (last >= F.max("peak")).alias("ends_at_high"), (F.count(F.when(F.col("d") > 0, 1)) / F.count("d")).alias("hit_ratio"))
    return g.join(under, "series_id")


@query("strategy_monthly_returns_estimate", """-- floats: return_pct
SELECT series_id, bucket, return_pct FROM (SELECT series_id, bucket, (v - lag(v) OVER w) / abs(lag(v) OVER w) * 100 AS return_pct FROM series JOIN (SELECT series_id, CAST(i AS BIGINT) AS bucket, CAST(floor(i * n / 24) AS BIGINT) AS idx FROM (SELECT series_id, count(*) AS n FROM series GROUP BY series_id), range(24) r(i)) USING (series_id, idx) WINDOW w AS (PARTITION BY series_id ORDER BY bucket)) WHERE return_pct IS NOT NULL""")
def _(v):
    n = v.series.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))
    at = n.select("series_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(23).cast("long"))).alias("bucket"), "n").withColumn("idx", F.floor(F.col("bucket") * F.col("n") / 24))
    prev = F.lag("v").over(Window.partitionBy("series_id").orderBy("bucket"))
    return v.series.join(at, ["series_id", "idx"]).select("series_id", "bucket", ((F.col("v") - prev) / F.abs(prev) * 100).alias("return_pct")).filter("return_pct is not null")


_WEIGHTS = "(SELECT series_id, greatest(w, 0) / sum(greatest(w, 0)) OVER () AS w FROM (SELECT series_id, CASE WHEN series_id = 'BUILDING' THEN -1.0 ELSE len(series_id) END AS w FROM (SELECT DISTINCT series_id FROM series)))"


def _weights(v, uniform=False):
    w = F.lit(1.0) if uniform else F.when(F.col("series_id") == "BUILDING", -1.0).otherwise(F.length("series_id").cast("double"))
    return v.series.select("series_id").distinct().withColumn("w", w)


for _name, _uniform in (("portfolio_combined_equity", True), ("portfolio_combined_equity_explicit", False)):

    @query(_name, f"-- floats: v\nSELECT idx, sum(v * w) AS v FROM series JOIN {'(SELECT series_id, 1.0 / count(*) OVER () AS w FROM (SELECT DISTINCT series_id FROM series))' if _uniform else _WEIGHTS} USING (series_id) WHERE idx <= (SELECT min(m) FROM (SELECT max(idx) AS m FROM series GROUP BY series_id)) GROUP BY idx", digits=3)
    def _(v, uniform=_uniform):
        return R.combined_curve(v.series, _weights(v, uniform))


_TOTALS = f"(SELECT series_id, (arg_max(v, idx) / arg_min(v, idx) - 1) * 100 AS ret, max(dd) * 100 AS dd FROM {_DD} GROUP BY series_id)"


@query("portfolio_contribution", f"-- floats: contribution dd_contribution share\nSELECT series_id, ret * w AS contribution, dd * w AS dd_contribution, ret * w / sum(ret * w) OVER () AS share FROM {_TOTALS} JOIN {_WEIGHTS} USING (series_id)")
def _(v):
    w = _weights(v).withColumn("w", F.greatest("w", F.lit(0.0)))
    w = with_total(w, _total=F.sum("w")).select("series_id", (F.col("w") / F.col("_total")).alias("w"))
    g = R.with_drawdown(v.series).groupBy("series_id").agg(((F.max_by("v", "idx") / F.min_by("v", "idx") - 1) * 100).alias("ret"), (F.max("dd") * 100).alias("dd")).join(w, "series_id")
    c = F.col("ret") * F.col("w")
    return with_total(g, _total=F.sum(c)).select("series_id", c.alias("contribution"), (F.col("dd") * F.col("w")).alias("dd_contribution"), (c / F.col("_total")).alias("share"))


@query("attribution_by_strategy", f"-- floats: contribution share_pct\nSELECT series_id, ret * w AS contribution, ret * w / nullif(sum(ret * w) OVER (), 0) * 100 AS share_pct FROM (SELECT series_id, sum(r) AS ret, 1.0 / len(series_id) AS w FROM {_R} GROUP BY series_id)")
def _(v):
    g = _returns(v).groupBy("series_id").agg(F.sum("r").alias("ret"))
    c = F.col("ret") * (1.0 / F.length("series_id"))
    return with_total(g, _total=F.sum(c)).select("series_id", c.alias("contribution"), (ratio(c, F.col("_total")) * 100).alias("share_pct"))


_BUCKET = "(SELECT series_id, bucket, coalesce((arg_max(v, idx) - arg_min(v, idx)) / nullif(abs(arg_min(v, idx)), 0), 0) * 100 AS return_pct FROM (SELECT *, least((row_number() OVER (PARTITION BY series_id ORDER BY idx) - 1) // (count(*) OVER (PARTITION BY series_id) // {n}), {n} - 1) AS bucket FROM series) GROUP BY ALL)"


@query("attribution_by_month_from_curves", f"-- floats: return_pct portfolio_pct\nSELECT *, sum(return_pct) OVER (PARTITION BY bucket) * 0.2 AS portfolio_pct FROM {_BUCKET.format(n=12)}", digits=4)
def _(v):
    b = R.bucket_returns(v.series, 12)
    return b.withColumn("portfolio_pct", F.sum("return_pct").over(Window.partitionBy("bucket")) * 0.2)


@query("attribution_regime_split", f"-- floats: calm volatile\nWITH b AS {_BUCKET.format(n=12)}, g AS (SELECT bucket, abs(sum(return_pct) * 0.2) > 20 AS hot FROM b GROUP BY bucket) SELECT series_id, avg(return_pct) FILTER (NOT hot) AS calm, avg(return_pct) FILTER (hot) AS volatile FROM b JOIN g USING (bucket) GROUP BY series_id", digits=4)
def _(v):
    b = R.bucket_returns(v.series, 12)
    regime = b.groupBy("bucket").agg(F.when(F.abs(F.sum("return_pct") * 0.2) > 20, "volatile").otherwise("calm").alias("regime"))
    return b.join(regime, "bucket").groupBy("series_id").pivot("regime", ["calm", "volatile"]).avg("return_pct")


@query("attribution_concentration_index", "-- floats: hhi hhi_scaled top_share\nSELECT project, sum(s * s) AS hhi, CASE WHEN count(*) > 1 THEN (sum(s * s) - 1 / count(*)) / (1 - 1 / count(*)) ELSE 1 END AS hhi_scaled, count(*) AS n, max(s) AS top_share FROM (SELECT project, abs(net_profit) / sum(abs(net_profit)) OVER (PARTITION BY project) AS s FROM strategies) GROUP BY project")
def _(v):
    return R.concentration(v.strategies, "project", "strategy_id", F.abs("net_profit"))


@query("benchmark_compare_curves", f"""-- floats: return_pct max_drawdown_pct sharpe excess_return_pct
WITH g AS (SELECT d.series_id, (arg_max(v, idx) / arg_min(v, idx) - 1) * 100 AS return_pct, max(dd) * 100 AS max_drawdown_pct, avg(r) / nullif(stddev_samp(r), 0) * sqrt(252.0) AS sharpe FROM {_DD} d GROUP BY d.series_id) SELECT g.*, g.return_pct - b.return_pct AS excess_return_pct FROM g, (SELECT return_pct FROM g WHERE series_id = 'BUILDING') b""")
def _(v):
    g = R.with_drawdown(v.series).groupBy("series_id").agg(((F.max_by("v", "idx") / F.min_by("v", "idx") - 1) * 100).alias("return_pct"), (F.max("dd") * 100).alias("max_drawdown_pct"), R.sharpe(F.col("r")).alias("sharpe"))
    b = g.filter("series_id = 'BUILDING'").select(F.col("return_pct").alias("_b"))  # one row
    return g.join(F.broadcast(b)).withColumn("excess_return_pct", F.col("return_pct") - F.col("_b")).drop("_b")


@query("benchmark_alpha_beta", f"-- floats: beta alpha correlation\nSELECT series_id, regr_slope(a, b) AS beta, regr_intercept(a, b) AS alpha, corr(a, b) AS correlation FROM {PAIRS} GROUP BY series_id")
def _(v):
    return _pairs(v).groupBy("series_id").agg(F.regr_slope("a", "b").alias("beta"), F.regr_intercept("a", "b").alias("alpha"), F.corr("a", "b").alias("correlation"))


@query("benchmark_excess_return_series", f"-- floats: excess mean_excess\nSELECT series_id, idx, a - b AS excess, avg(a - b) OVER (PARTITION BY series_id) AS mean_excess FROM {PAIRS}")
def _(v):
    d = F.col("a") - F.col("b")
    return _pairs(v).select("series_id", "idx", d.alias("excess"), F.avg(d).over(Window.partitionBy("series_id")).alias("mean_excess"))


_RUN = "SELECT {key}, kind, max(c) AS longest FROM (SELECT {key}, kind, g, count(*) AS c FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) - row_number() OVER (PARTITION BY {key}, kind ORDER BY {order}) AS g FROM {src}) WHERE kind IS NOT NULL GROUP BY ALL) GROUP BY ALL"


@query("benchmark_outperformance_periods", _RUN.format(key="series_id", order="idx", src=f"(SELECT *, CASE WHEN a > b THEN 'above' WHEN a < b THEN 'below' END AS kind FROM {PAIRS})"))
def _(v):
    return R.longest_runs(_pairs(v), F.when(F.col("a") > F.col("b"), "above").when(F.col("a") < F.col("b"), "below"), "series_id", "idx")


@query("perp_funding_adjusted_pnl", f"""-- floats: gross funding net impact_pct
SELECT strategy_id, gross, {halves_up('funding')} AS funding, {halves_up('net')} AS net, {halves_up('impact_pct')} AS impact_pct, round(impact_pct, 9) > 10 AS warning FROM (SELECT strategy_id, gross, funding, gross - funding AS net, abs(funding) / nullif(abs(gross), 0) * 100 AS impact_pct FROM (SELECT strategy_id, round(sum(pnl), 6) AS gross, round(sum(f), 10) AS funding FROM (SELECT *, CASE WHEN side = 'long' THEN 1 ELSE -1 END * 0.0001 * hold_hours / 8 * notional AS f FROM trades) GROUP BY strategy_id))""")
def _(v):
    """Sums are settled before they are set against each other (profit to a millionth, funding to 10 digits), so that the order of a sum leaves no profit where there is none."""
    f = F.when(F.col("side") == "long", 1).otherwise(-1) * 0.0001 * F.col("hold_hours") / 8 * F.col("notional")
    g = v.trades.withColumn("f", f).groupBy("strategy_id").agg(F.round(F.sum("pnl"), 6).alias("gross"), F.round(F.sum("f"), 10).alias("funding")).withColumn("net", F.round(F.col("gross") - F.col("funding"), 10))
    return g.withColumn("impact_pct", F.round(ratio(F.abs("funding"), F.abs("gross")) * 100, 10)).withColumn("warning", F.round("impact_pct", 9) > 10)


_LIQ = "price * (1 + CASE WHEN side = 'buy' THEN -1 ELSE 1 END * (1.0 / 5 - 0.005))"


def _liquidation():
    return R.liquidation_price(F.col("price"), F.lit(5.0), F.col("side") == "buy", F.lit(0.5))


@query("perp_liquidation_price", f"-- floats: liquidation distance_pct\nSELECT seq, {_LIQ} AS liquidation, abs(price - {_LIQ}) / price * 100 AS distance_pct FROM ticks")
def _(v):
    """The distance of an entry at a price of zero is no number."""
    price = F.col("price")
    distance = F.when(price == 0, float("nan")).otherwise(F.abs(price - _liquidation()) / F.nullif(price, F.lit(0.0)) * 100)
    return v.ticks.select("seq", _liquidation().alias("liquidation"), distance.alias("distance_pct"))


@query("perp_liquidation_distance_pct", "-- floats: distance_pct\nSELECT seq, side, 2 + seq % 124 AS leverage, 100 * abs(1.0 / (2 + seq % 124) - (0.1 + 0.1 * (seq % 7)) / 100) AS distance_pct FROM ticks WHERE price > 0")
def _(v):
    """Of positions whose leverage and maintenance margin are their own."""
    k = v.ticks.filter("price > 0").withColumns({"leverage": 2 + F.col("seq") % 124, "margin_pct": 0.1 + 0.1 * (F.col("seq") % 7)})
    price = R.liquidation_price(F.col("price"), F.col("leverage"), F.col("side") == "buy", F.col("margin_pct"))
    return k.select("seq", "side", "leverage", (100 * F.abs(price - F.col("price")) / F.col("price")).alias("distance_pct"))


_LIQ_BANDS = [("<=", 0.0, "safe"), ("<", 0.01, "marginal"), ("<", 0.05, "dangerous")]


@query("perp_liquidation_stress_test", f"""-- floats: rate
SELECT *, {bands_sql('rate', _LIQ_BANDS, 'unfeasible')} AS verdict FROM (SELECT k.series_id, count(*) AS n, avg(CASE WHEN CASE WHEN side = 'buy' THEN low <= {_LIQ} ELSE high >= {_LIQ} END THEN 1.0 ELSE 0 END) AS rate FROM ticks k JOIN bars b ON b.series_id = k.series_id AND b.t = k.epoch - k.epoch % 3600 GROUP BY k.series_id)""")
def _(v):
    """Each entry against the bar that holds it."""
    k = v.ticks.select("series_id", "side", "price", (F.col("epoch") - F.pmod("epoch", F.lit(3600))).alias("t"))
    hit = F.when(F.col("side") == "buy", F.col("low") <= _liquidation()).otherwise(F.col("high") >= _liquidation())
    g = k.join(v.bars.select("series_id", "t", "high", "low"), ["series_id", "t"]).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.avg(hit.cast("double")).alias("rate"))
    return g.withColumn("verdict", bands(F.col("rate"), _LIQ_BANDS, "unfeasible"))


@query("position_sizing_calc", """-- floats: lots notional margin
SELECT seq, lots, lots * price AS notional, lots * price / 5 AS margin FROM (SELECT seq, price, greatest(0.01, least(100.0, floor(10000.0 * 1 / 100 / nullif(abs(price - (price - 1 - volume / 10)), 0) / 0.01) * 0.01)) AS lots FROM ticks)""")
def _(v):
    lots = R.lot_size(F.lit(10000.0), F.lit(1.0), F.col("price"), F.col("price") - 1 - F.col("volume") / 10)
    return v.ticks.withColumn("lots", lots).select("seq", "lots", (F.col("lots") * F.col("price")).alias("notional"), (F.col("lots") * F.col("price") / 5).alias("margin"))


_WL = "(SELECT strategy_id, avg(CASE WHEN pnl > 0 THEN 1.0 ELSE 0 END) AS p, avg(pnl) FILTER (pnl > 0) AS w, avg(-pnl) FILTER (pnl < 0) AS l FROM trades GROUP BY strategy_id)"


def _win_loss(v):
    return v.trades.groupBy("strategy_id").agg(F.avg((F.col("pnl") > 0).cast("double")).alias("p"), F.avg(F.when(F.col("pnl") > 0, F.col("pnl"))).alias("w"), F.avg(F.when(F.col("pnl") < 0, -F.col("pnl"))).alias("l"))


@query("kelly_criterion", f"-- floats: kelly quarter\nSELECT *, kelly / 4 AS quarter, {bands_sql('kelly', [('<=', 0, 'none'), ('>', 0.5, 'extreme')], 'moderate')} AS verdict FROM (SELECT strategy_id, greatest(coalesce(p - (1 - p) / nullif(w / nullif(l, 0), 0), 0), 0) AS kelly FROM {_WL})")
def _(v):
    g = _win_loss(v).select("strategy_id", R.kelly(F.col("p"), F.col("w"), F.col("l")).alias("kelly"))
    return g.select("*", (F.col("kelly") / 4).alias("quarter"), bands(F.col("kelly"), [("<=", 0, "none"), (">", 0.5, "extreme")], "moderate").alias("verdict"))


@query("position_sizing_risk_of_ruin", f"-- floats: ruin\nSELECT *, {bands_sql('ruin', [('<', 0.01, 'low'), ('<', 0.1, 'moderate')], 'high')} AS verdict FROM (SELECT strategy_id, CASE WHEN p * w / l - (1 - p) <= 0 THEN 1.0 ELSE least(1.0, greatest(0.0, ((1 - (p * w / l - (1 - p))) / (1 + (p * w / l - (1 - p)))) ** 10)) END AS ruin FROM {_WL} WHERE w IS NOT NULL AND l IS NOT NULL)")
def _(v):
    g = _win_loss(v).filter("w is not null and l is not null").select("strategy_id", R.ruin(F.col("p"), F.col("w") / F.col("l"), 5.0).alias("ruin"))
    return g.withColumn("verdict", bands(F.col("ruin"), [("<", 0.01, "low"), ("<", 0.1, "moderate")], "high"))


@query("position_sizing_pyramid", """-- floats: cumulative_size avg_entry r_multiple
SELECT series_id, seq, sum(volume + 1.1) OVER w AS cumulative_size, sum((volume + 1.1) * price) OVER w / sum(volume + 1.1) OVER w AS avg_entry, (price - first_value(price) OVER w) / 10 AS r_multiple FROM ticks WINDOW w AS (PARTITION BY series_id ORDER BY seq ROWS UNBOUNDED PRECEDING)""", digits=5)
def _(v):
    """Tiers in order of arrival; the stop lies 10 below the first entry."""
    w = Window.partitionBy("series_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    size = F.col("volume") + 1.1
    return v.ticks.select("series_id", "seq", F.sum(size).over(w).alias("cumulative_size"), (F.sum(size * F.col("price")).over(w) / F.sum(size).over(w)).alias("avg_entry"), ((F.col("price") - F.first("price").over(w)) / 10).alias("r_multiple"))


@query("stats_irr")
def _(v):
    """Accounts put in 40 a trade and take out its value; tests hold the rate against its net present value."""
    w = Window.partitionBy("strategy_id").orderBy("seq")
    return R.irr(v.trades.select(F.col("strategy_id").alias("account"), F.row_number().over(w).alias("t"), F.when(F.row_number().over(w) == 1, F.lit(-500.0)).otherwise(F.col("pnl") + 20).alias("flow")))


_EXPO = "SELECT book_id, symbol, sum(CASE WHEN side = 'long' THEN notional ELSE 0 END) AS long, sum(CASE WHEN side = 'long' THEN 0 ELSE notional END) AS short, count(*) AS n FROM positions GROUP BY GROUPING SETS ((book_id, symbol), (book_id))"


@query("exposure_summary", f"-- floats: long short net gross\nSELECT *, CASE WHEN gross <= 0 THEN 'no_exposure' ELSE {bands_sql('(net / gross)', R.BIAS, 'strongly_short')} END AS bias FROM (SELECT *, long - short AS net, long + short AS gross FROM ({_EXPO}))")
def _(v):
    return R.exposure(v.positions)


@query("exposure_concentration_hhi", f"-- floats: hhi hhi_scaled top_share\nSELECT *, {bands_sql('hhi_scaled', R.CONCENTRATION, 'diversified')} AS verdict FROM (SELECT book_id, sum(s * s) AS hhi, CASE WHEN count(*) > 1 THEN (sum(s * s) - 1 / count(*)) / (1 - 1 / count(*)) ELSE 1 END AS hhi_scaled, count(*) AS n, max(s) AS top_share FROM (SELECT book_id, sum(notional) / sum(sum(notional)) OVER (PARTITION BY book_id) AS s FROM positions GROUP BY book_id, symbol) GROUP BY book_id)")
def _(v):
    return R.concentration(v.positions, "book_id", "symbol", F.col("notional")).withColumn("verdict", bands(F.col("hhi_scaled"), R.CONCENTRATION, "diversified"))


_LEV = [(">", 4.5, "critical_breach"), (">", 3.0, "breach"), (">", 2.7, "near_limit")]


@query("exposure_leverage_check", f"-- floats: gross_leverage net_leverage\nSELECT *, {bands_sql('gross_leverage', _LEV, 'safe')} AS verdict FROM (SELECT book_id, (long + short) / 100000 AS gross_leverage, abs(long - short) / 100000 AS net_leverage FROM ({_EXPO}) WHERE symbol IS NULL)")
def _(v):
    g = R.exposure(v.positions).filter("symbol is null").select("book_id", (F.col("gross") / 100000).alias("gross_leverage"), (F.abs("net") / 100000).alias("net_leverage"))
    return g.withColumn("verdict", bands(F.col("gross_leverage"), _LEV, "safe"))


_CORR = f"(SELECT x.series_id AS sym_a, y.series_id AS sym_b, corr(x.r, y.r) AS rho FROM {_R} x JOIN {_R} y ON x.idx = y.idx AND x.series_id < y.series_id GROUP BY ALL)"
_SIGNED = "(SELECT book_id, symbol, sum(CASE WHEN side = 'long' THEN notional ELSE -notional END) AS w FROM positions GROUP BY ALL)"


def correlations(v):
    """Pearson correlation of the returns of every pair of series, aligned by idx."""
    return P.correlations(_returns(v), "r")


_FORM = "SELECT a.book_id, a.symbol, sum(a.w * b.w * CASE WHEN a.symbol = b.symbol THEN 1.0 ELSE coalesce(c.rho, 0) END) AS term FROM {w} a JOIN {w} b USING (book_id) LEFT JOIN " + _CORR + " c ON least(a.symbol, b.symbol) = c.sym_a AND greatest(a.symbol, b.symbol) = c.sym_b GROUP BY ALL"


@query("exposure_correlation_risk", f"""-- floats: effective benefit_pct
WITH s AS (SELECT book_id, symbol, w / sum(abs(w)) OVER (PARTITION BY book_id) AS w FROM {_SIGNED}) SELECT *, (1 - effective) * 100 AS benefit_pct, {bands_sql('effective', R.CORRELATED, 'highly_correlated')} AS verdict FROM (SELECT book_id, sqrt(greatest(sum(term), 0)) AS effective FROM ({_FORM.format(w='s')}) GROUP BY book_id)""")
def _(v):
    w = R.signed_weights(v.positions)
    w = w.withColumn("w", F.col("w") / F.sum(F.abs("w")).over(Window.partitionBy("book_id")))
    g = R.quadratic_form(w, correlations(v)).groupBy("book_id").agg(F.sqrt(F.greatest(F.sum("term"), F.lit(0.0))).alias("effective"))
    return g.select("*", ((1 - F.col("effective")) * 100).alias("benefit_pct"), bands(F.col("effective"), R.CORRELATED, "highly_correlated").alias("verdict"))


@query("exposure_var_decomposition", f"""-- floats: var_value share
WITH s AS (SELECT book_id, symbol, w * sd AS w FROM {_SIGNED} JOIN (SELECT series_id AS symbol, stddev_samp(r) / 1000 AS sd FROM {_R} GROUP BY series_id) USING (symbol)), f AS ({_FORM.format(w='s')})
SELECT book_id, symbol, {normal_quantile(0.95)!r} * sqrt(greatest(sum(term) OVER (PARTITION BY book_id), 0)) AS var_value, term / nullif(sum(term) OVER (PARTITION BY book_id), 0) AS share FROM f""", digits=4)
def _(v):
    sd = _returns(v).groupBy(F.col("series_id").alias("symbol")).agg((F.stddev_samp("r") / 1000).alias("sd"))
    w = R.signed_weights(v.positions).join(sd, "symbol").select("book_id", "symbol", (F.col("w") * F.col("sd")).alias("w"))
    total = F.sum("term").over(Window.partitionBy("book_id"))
    return R.quadratic_form(w, correlations(v)).select("book_id", "symbol", (normal_quantile(0.95) * F.sqrt(F.greatest(total, F.lit(0.0)))).alias("var_value"), ratio(F.col("term"), total).alias("share"))


@query("cross_instrument_group_by_symbol", "-- floats: weight mean_fitness share\nSELECT *, weight / sum(weight) OVER () AS share FROM (SELECT symbol, count(*) AS n, sum(trades) + 0.0 AS weight, avg(fitness_full) AS mean_fitness FROM strategies GROUP BY symbol)")
def _(v):
    g = v.strategies.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("trades").cast("double").alias("weight"), F.avg("fitness_full").alias("mean_fitness"))
    return with_total(g, _total=F.sum("weight")).withColumn("share", F.col("weight") / F.col("_total")).drop("_total")


_SHARE = "(SELECT project, symbol, sum(trades) / sum(sum(trades)) OVER (PARTITION BY project) AS s FROM strategies GROUP BY project, symbol)"


@query("cross_instrument_diversification_score", f"-- floats: score\nSELECT project, 100 * (1 - CASE WHEN count(*) > 1 THEN (sum(s * s) - 1 / count(*)) / (1 - 1 / count(*)) ELSE 1 END) AS score FROM {_SHARE} GROUP BY project")
def _(v):
    return R.concentration(v.strategies, "project", "symbol", F.col("trades")).select("project", (100 * (1 - F.col("hhi_scaled"))).alias("score"))


@query("cross_instrument_recommend_caps", f"-- floats: share_pct excess_pct\nSELECT project, symbol, s * 100 AS share_pct, s * 100 - 10 AS excess_pct FROM {_SHARE} WHERE s * 100 > 10")
def _(v):
    g = v.strategies.groupBy("project", "symbol").agg(F.sum("trades").alias("t"))
    g = g.withColumn("share_pct", F.col("t") / F.sum("t").over(Window.partitionBy("project")) * 100).filter("share_pct > 10")
    return g.select("project", "symbol", "share_pct", (F.col("share_pct") - 10).alias("excess_pct"))


_CLASS = "CASE WHEN regexp_matches(symbol, '^(EUR|GBP|USD|JPY)') THEN 'forex' WHEN regexp_matches(symbol, '(USDT|BTC|ETH)$') THEN 'crypto' WHEN regexp_matches(symbol, '[0-9]$') THEN 'futures' ELSE 'unknown' END"


@query("cross_instrument_asset_class_split", f"-- floats: share\nSELECT *, n / sum(n) OVER () AS share FROM (SELECT {_CLASS} AS asset_class, count(*) AS n FROM (SELECT upper(replace(symbol, '_', '')) AS symbol FROM strategies) GROUP BY ALL)")
def _(v):
    s = F.upper(F.translate("symbol", "_", ""))
    kind = F.when(s.rlike("^(EUR|GBP|USD|JPY)"), "forex").when(s.rlike("(USDT|BTC|ETH)$"), "crypto").when(s.rlike("[0-9]$"), "futures").otherwise("unknown")
    g = v.strategies.groupBy(kind.alias("asset_class")).agg(F.count(F.lit(1)).alias("n"))
    return with_total(g, _total=F.sum("n")).withColumn("share", F.col("n") / F.col("_total")).drop("_total")


@query("cross_instrument_correlation_groups", "SELECT CASE WHEN regexp_matches(symbol, '_1[0-9]?$') THEN 'ones' WHEN regexp_matches(symbol, '_2[0-9]?$') THEN 'twos' ELSE 'rest' END AS cluster, array_to_string(list_sort(list(DISTINCT symbol)), ',') AS symbols FROM strategies GROUP BY ALL")
def _(v):
    cluster = F.when(F.col("symbol").rlike("_1[0-9]?$"), "ones").when(F.col("symbol").rlike("_2[0-9]?$"), "twos").otherwise("rest")
    return v.strategies.groupBy(cluster.alias("cluster")).agg(F.array_join(F.sort_array(F.collect_set("symbol")), ",").alias("symbols"))
