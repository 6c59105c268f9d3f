"""Registered queries: indicators, rolling metrics, regimes, volatility estimators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import indicators as I
from .registry import query

_W = "WINDOW w AS (PARTITION BY series_id ORDER BY idx ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


def _roll(n: int) -> str:
    return _W.format(n=n - 1)


def smooth_sql(source: str, col: str, span: int, keep: float, name: str, first: int = 0) -> str:
    """Seeded exponential smoothing by recursion; ``first`` is the first idx that has a value."""
    return f"""(WITH RECURSIVE b AS (SELECT series_id, idx, {col} AS x FROM {source}), f AS (SELECT series_id, CAST({first + span - 1} AS BIGINT) AS idx, sum(x) / {span} AS {name} FROM b WHERE idx BETWEEN {first} AND {first + span - 1} GROUP BY series_id HAVING count(*) = {span}
UNION ALL SELECT b.series_id, b.idx, {1 - keep!r} * b.x + {keep!r} * f.{name} FROM f JOIN b ON b.series_id = f.series_id AND b.idx = f.idx + 1) SELECT series_id, idx, {name} FROM f)"""


_TR = """(SELECT *, CASE WHEN idx = 0 THEN high - low ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr FROM (SELECT *, lag("close") OVER (PARTITION BY series_id ORDER BY idx) AS pc FROM bars))"""
_KEY = ["series_id", "idx"]


@query("indicator_bollinger", f"""-- floats: middle upper lower position
SELECT series_id, idx, middle, middle + 2 * s AS upper, middle - 2 * s AS lower, ("close" - (middle - 2 * s)) / nullif(4 * s, 0) AS position FROM (SELECT series_id, idx, "close", CASE WHEN idx >= 19 THEN avg("close") OVER w END AS middle, CASE WHEN idx >= 19 THEN stddev_pop("close") OVER w END AS s FROM bars {_roll(20)})""")
def _(v):
    return I.bollinger(v.bars).select(*_KEY, "middle", "upper", "lower", "position")


_DON = f"SELECT series_id, idx, CASE WHEN idx >= 19 THEN max(high) OVER w END AS upper, CASE WHEN idx >= 19 THEN min(low) OVER w END AS lower FROM bars {_roll(20)}"


@query("indicator_donchian", f"-- floats: upper lower middle\nSELECT *, (upper + lower) / 2 AS middle FROM ({_DON})")
def _(v):
    return I.donchian(v.bars).select(*_KEY, "upper", "lower", "middle")


@query("indicator_keltner", f"""-- floats: middle atr upper lower
SELECT series_id, idx, middle, atr, middle + 2 * atr AS upper, middle - 2 * atr AS lower FROM bars LEFT JOIN {smooth_sql('bars', '"close"', 20, 1 - 2 / 21, 'middle')} e USING (series_id, idx) LEFT JOIN {smooth_sql(_TR, 'tr', 20, 1 - 1 / 20, 'atr')} a USING (series_id, idx)""", digits=5)
def _(v):
    return I.keltner(v.bars).select(*_KEY, "middle", "atr", "upper", "lower")


@query("indicator_atr", f"""-- floats: tr atr
SELECT series_id, idx, tr, atr FROM {_TR} t LEFT JOIN {smooth_sql(_TR, 'tr', 14, 1 - 1 / 14, 'atr')} a USING (series_id, idx)""", digits=5)
def _(v):
    return I.atr(v.bars, 14).select(*_KEY, "tr", "atr")


@query("indicator_atr_stop", f"""-- floats: stop distance distance_pct
SELECT seq, CASE WHEN side = 'buy' THEN price - 2 * atr ELSE price + 2 * atr END AS stop, 2 * atr AS distance, 2 * atr / price * 100 AS distance_pct FROM ticks JOIN (SELECT series_id, arg_max(atr, idx) AS atr FROM {smooth_sql(_TR, 'tr', 14, 1 - 1 / 14, 'atr')} a GROUP BY series_id) USING (series_id)""", digits=5)
def _(v):
    last = I.atr(v.bars, 14).groupBy("series_id").agg(F.max_by("atr", "idx").alias("atr"))
    stop, d, pct = I.atr_stop(F.col("price"), F.col("atr"), F.when(F.col("side") == "buy", "long").otherwise("short"))
    return v.ticks.join(last, "series_id").select("seq", stop.alias("stop"), d.alias("distance"), pct.alias("distance_pct"))


@query("indicator_chandelier_stop", f"""-- floats: long_stop short_stop
SELECT series_id, idx, upper - 3 * atr AS long_stop, lower + 3 * atr AS short_stop FROM (SELECT series_id, idx, CASE WHEN idx >= 21 THEN max(high) OVER w END AS upper, CASE WHEN idx >= 21 THEN min(low) OVER w END AS lower FROM bars {_roll(22)}) LEFT JOIN {smooth_sql(_TR, 'tr', 22, 1 - 1 / 22, 'atr')} a USING (series_id, idx)""", digits=5)
def _(v):
    return I.chandelier(v.bars).select(*_KEY, "long_stop", "short_stop")


_D = """(SELECT series_id, idx, "close" - lag("close") OVER (PARTITION BY series_id ORDER BY idx) AS d FROM bars)"""


@query("oscillator_rsi", f"""-- floats: rsi
SELECT *, CASE WHEN rsi > 70 THEN 'overbought' WHEN rsi < 30 THEN 'oversold' ELSE 'neutral' END AS signal FROM (SELECT series_id, idx, CASE WHEN al = 0 THEN 100.0 ELSE 100 - 100 / (1 + ag / al) END AS rsi FROM bars
LEFT JOIN {smooth_sql(_D, 'greatest(d, 0)', 14, 1 - 1 / 14, 'ag', 1)} g USING (series_id, idx) LEFT JOIN {smooth_sql(_D, 'greatest(-d, 0)', 14, 1 - 1 / 14, 'al', 1)} l USING (series_id, idx))""", digits=5)
def _(v):
    return I.rsi(v.bars).select(*_KEY, "rsi", "signal")


_MACD = f"(SELECT series_id, idx, ef - es AS macd FROM {smooth_sql('bars', chr(34) + 'close' + chr(34), 12, 1 - 2 / 13, 'ef')} a JOIN {smooth_sql('bars', chr(34) + 'close' + chr(34), 26, 1 - 2 / 27, 'es')} b USING (series_id, idx))"


@query("oscillator_macd", f"""-- floats: macd signal histogram
SELECT series_id, idx, macd, signal, macd - signal AS histogram FROM bars LEFT JOIN {_MACD} m USING (series_id, idx) LEFT JOIN {smooth_sql(_MACD, 'macd', 9, 1 - 2 / 10, 'signal', 25)} s USING (series_id, idx)""", digits=5)
def _(v):
    return I.macd(v.bars).select(*_KEY, "macd", "signal", "histogram")


@query("oscillator_stochastic", f"""-- floats: k d
SELECT series_id, idx, k, CASE WHEN idx >= 15 THEN avg(k) OVER (PARTITION BY series_id ORDER BY idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS d, CASE WHEN k > 80 THEN 'overbought' WHEN k < 20 THEN 'oversold' ELSE 'neutral' END AS signal
FROM (SELECT series_id, idx, CASE WHEN idx >= 13 THEN CASE WHEN max(high) OVER w = min(low) OVER w THEN 50.0 ELSE round(100 * ("close" - min(low) OVER w) / (max(high) OVER w - min(low) OVER w), 4) END END AS k FROM bars {_roll(14)})""", digits=4)
def _(v):
    return I.stochastic(v.bars).select(*_KEY, "k", "d", "signal")


@query("oscillator_cci", f"""-- floats: cci
SELECT *, CASE WHEN cci > 200 THEN 'strong_overbought' WHEN cci > 100 THEN 'overbought' WHEN cci < -100 THEN 'oversold' ELSE 'neutral' END AS signal FROM (
SELECT series_id, idx, CASE WHEN idx >= 19 THEN (tp - m) / (0.015 * list_avg(list_transform(xs, lambda x: abs(x - m)))) END AS cci FROM (SELECT series_id, idx, tp, avg(tp) OVER w AS m, list(tp) OVER w AS xs FROM (SELECT *, (high + low + "close") / 3 AS tp FROM bars) {_roll(20)}))""", digits=5)
def _(v):
    return I.cci(v.bars).select(*_KEY, "cci", "signal")


@query("oscillator_williams_r", f"""-- floats: williams_r
SELECT *, CASE WHEN williams_r > -20 THEN 'overbought' WHEN williams_r < -80 THEN 'oversold' ELSE 'neutral' END AS signal FROM (
SELECT series_id, idx, CASE WHEN idx >= 13 THEN CASE WHEN max(high) OVER w = min(low) OVER w THEN -50.0 ELSE -100 * (max(high) OVER w - "close") / (max(high) OVER w - min(low) OVER w) END END AS williams_r FROM bars {_roll(14)})""")
def _(v):
    return I.williams_r(v.bars).select(*_KEY, "williams_r", "signal")


def _returns(v):
    return v.series.filter("r is not null")


_R = "(SELECT series_id, idx, r FROM series WHERE r IS NOT NULL)"


@query("rolling_sharpe", f"-- floats: sharpe\nSELECT series_id, idx, CASE WHEN idx >= 30 THEN avg(r) OVER w / nullif(stddev_samp(r) OVER w, 0) * sqrt(252.0) END AS sharpe FROM {_R} {_roll(30)}")
def _(v):
    return I.rolling_sharpe(_returns(v), "r", 30).select(*_KEY, "sharpe")


@query("rolling_volatility", f"-- floats: volatility\nSELECT series_id, idx, CASE WHEN idx >= 30 THEN stddev_samp(r) OVER w * sqrt(252.0) END AS volatility FROM {_R} {_roll(30)}")
def _(v):
    return I.rolling_volatility(_returns(v), "r", 30).select(*_KEY, "volatility")


def _pairs(v):
    """Returns of each series (a) beside those of BUILDING (b), aligned by idx."""
    b = _returns(v).filter("series_id = 'BUILDING'").select("idx", F.col("r").alias("b"))
    return _returns(v).filter("series_id <> 'BUILDING'").select("series_id", "idx", F.col("r").alias("a")).join(b, "idx")


PAIRS = f"(SELECT x.series_id, x.idx, x.r AS a, y.r AS b FROM {_R} x JOIN {_R} y ON x.idx = y.idx AND y.series_id = 'BUILDING' AND x.series_id <> 'BUILDING')"


@query("rolling_correlation", f"-- floats: correlation\nSELECT series_id, idx, CASE WHEN idx >= 40 THEN corr(a, b) OVER w END AS correlation FROM {PAIRS} {_roll(40)}")
def _(v):
    return I.rolling_correlation(_pairs(v), 40).select(*_KEY, "correlation")


@query("rolling_beta_alpha", f"-- floats: beta alpha\nSELECT series_id, idx, CASE WHEN idx >= 40 THEN regr_slope(a, b) OVER w END AS beta, CASE WHEN idx >= 40 THEN regr_intercept(a, b) OVER w END AS alpha FROM {PAIRS} {_roll(40)}")
def _(v):
    return I.rolling_beta_alpha(_pairs(v), 40).select(*_KEY, "beta", "alpha")


@query("rolling_drawdown", f"""-- floats: drawdown_pct
SELECT series_id, idx, CASE WHEN idx >= 19 THEN list_max(list_transform(range(1, len(xs) + 1), lambda i: (list_max(xs[1:i]) - xs[i]) / list_max(xs[1:i]) * 100)) END AS drawdown_pct FROM (SELECT series_id, idx, list(v) OVER w AS xs FROM series {_roll(20)})""")
def _(v):
    return I.rolling_drawdown(v.series, "v", 20).select(*_KEY, "drawdown_pct")


@query("rolling_win_rate", """-- floats: win_rate
SELECT strategy_id, seq, CASE WHEN row_number() OVER (PARTITION BY strategy_id ORDER BY seq) >= 10 THEN avg(CASE WHEN pnl > 0 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY strategy_id ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) END AS win_rate FROM trades""")
def _(v):
    return I.rolling_win_rate(v.trades.withColumnRenamed("strategy_id", "series_id"), "pnl", 10, "seq").select(F.col("series_id").alias("strategy_id"), "seq", "win_rate")


def _tertiles(src: str, names: tuple[str, str, str]) -> str:
    return f"""-- floats: measure
WITH m AS ({src}), k AS (SELECT series_id, list(measure ORDER BY measure) AS xs FROM m WHERE measure IS NOT NULL GROUP BY series_id)
SELECT m.series_id, idx, measure, CASE WHEN measure IS NULL OR coalesce(len(xs), 0) < 6 THEN 'unknown' WHEN measure <= xs[len(xs) // 3 + 1] THEN '{names[0]}' WHEN measure <= xs[2 * len(xs) // 3 + 1] THEN '{names[1]}' ELSE '{names[2]}' END AS regime FROM m LEFT JOIN k USING (series_id)"""


@query("regime_classify_volatility", _tertiles(f"""SELECT series_id, idx, CASE WHEN idx >= 19 THEN stddev_samp("close") OVER w END AS measure FROM bars {_roll(20)}""", ("low", "normal", "high")))
def _(v):
    return I.volatility_regimes(v.bars, "close").select(*_KEY, "measure", "regime")


@query("regime_classify_trend", _tertiles(f"""SELECT series_id, idx, CASE WHEN idx >= 49 THEN regr_slope("close", CAST(idx AS DOUBLE)) OVER w END AS measure FROM bars {_roll(50)}""", ("bear", "neutral", "bull")))
def _(v):
    return I.trend_regimes(v.bars, "close").select(*_KEY, "measure", "regime")


@query("perp_funding_regime_classifier", """-- floats: contango backwardation neutral annualised
SELECT *, CASE WHEN contango > 2 * backwardation THEN 'bullish' WHEN backwardation > 2 * contango THEN 'bearish' ELSE 'balanced' END AS verdict FROM (SELECT strategy_id, avg(CASE WHEN f > 0.0001 THEN 1.0 ELSE 0 END) AS contango, avg(CASE WHEN f < -0.0001 THEN 1.0 ELSE 0 END) AS backwardation, avg(CASE WHEN f BETWEEN -0.0001 AND 0.0001 THEN 1.0 ELSE 0 END) AS neutral, avg(f) * 3 * 365 AS annualised FROM (SELECT strategy_id, pnl / 100000 AS f FROM trades) GROUP BY ALL)""", digits=9)
def _(v):
    f = v.trades.withColumn("f", F.col("pnl") / 100000)
    kind = F.when(F.col("f") > 0.0001, "contango").when(F.col("f") < -0.0001, "backwardation").otherwise("neutral")
    share = lambda k: F.avg((F.col("kind") == k).cast("double")).alias(k)
    out = f.withColumn("kind", kind).groupBy("strategy_id").agg(share("contango"), share("backwardation"), share("neutral"), (F.avg("f") * 3 * 365).alias("annualised"))
    verdict = F.when(F.col("contango") > 2 * F.col("backwardation"), "bullish").when(F.col("backwardation") > 2 * F.col("contango"), "bearish").otherwise("balanced")
    return out.withColumn("verdict", verdict)


# Bars with a price at or below zero add nothing but count as bars; Yang-Zhang leaves them out, and those after such a close.
_PAID, _RS = "least(o, h, l, c) > 0", "ln(h / o) * ln(h / c) + ln(l / o) * ln(l / c)"
_both = lambda x: f"CASE WHEN {_PAID} AND pc > 0 THEN {x} END"
_K = f"(0.34 / (1.34 + (count({_both('1')}) + 1.0) / (count({_both('1')}) - 1.0)))"
_VOL = {
    "close_to_close": "stddev_samp(ln(c / pc)) * sqrt(252.0)", "parkinson": f"sqrt(avg(CASE WHEN {_PAID} THEN ln(h / l) ** 2 ELSE 0 END) / (4 * ln(2)) * 252)", "garman_klass": f"sqrt(greatest(avg(CASE WHEN {_PAID} THEN 0.5 * ln(h / l) ** 2 - (2 * ln(2) - 1) * ln(c / o) ** 2 ELSE 0 END), 0) * 252)",
    "rogers_satchell": f"sqrt(greatest(avg(CASE WHEN {_PAID} THEN {_RS} ELSE 0 END), 0) * 252)",
    "yang_zhang": f"CASE WHEN count({_both('1')}) >= 2 THEN sqrt(greatest(var_samp({_both('ln(o / pc)')}) + {_K} * var_samp({_both('ln(c / o)')}) + (1 - {_K}) * avg({_both(_RS)}), 0) * 252) END",
}
_CLOSES = "stddev_samp(CASE WHEN c > 0 AND pc > 0 THEN ln(c / pc) WHEN pc IS NOT NULL THEN 0 END) * sqrt(252.0)"
_SRC = """(SELECT series_id, open AS o, high AS h, low AS l, "close" AS c, lag("close") OVER (PARTITION BY series_id ORDER BY idx) AS pc FROM bars)"""

for _k, _e in _VOL.items():

    @query(f"vol_{_k}", f"-- floats: {_k}\nSELECT series_id, {_e} AS {_k} FROM {_SRC} GROUP BY series_id")
    def _(v, k=_k):
        return I.volatilities(v.bars).select("series_id", k)


@query("vol_estimator_comparison", "-- floats: volatility\nSELECT * FROM (SELECT series_id, " + ", ".join(f"{e} AS {k}" for k, e in (_VOL | {"close_to_close": _CLOSES}).items()) + f" FROM {_SRC} GROUP BY series_id) UNPIVOT INCLUDE NULLS (volatility FOR estimator IN ({', '.join(_VOL)}))")
def _(v):
    return I.volatilities(v.bars).unpivot("series_id", list(_VOL), "estimator", "volatility")
