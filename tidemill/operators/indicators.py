"""Rolling and recursive indicators over keyed series, and range-based volatility estimators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import small
from ..session import materialise
from .scan import BLOCK, BLOCK_ROWS, NUMBER, Series, rolling, running

ORDER = "idx"


def _by(order: str = ORDER):
    return Window.partitionBy("series_id").orderBy(order)


def last_rows(w: int, order: str = ORDER):
    return _by(order).rowsBetween(-(w - 1), 0)


def full(value: Column, w: int, order: str = ORDER) -> Column:
    """``value`` from the w-th row of a series on, null before."""
    return F.when(F.row_number().over(_by(order)) >= w, value)


#: Values that are smoothed by one matrix product.
_LANE = 128


def decayed(x: np.ndarray, keep: float, y: float) -> np.ndarray:
    """y = keep * y + (1 - keep) * x along ``x``: inside a lane as a triangular matrix of powers, from lane to lane by its last value."""
    if not len(x):
        return x
    if not np.isfinite(x).all():  # what is not finite must not reach earlier values through a product with zero
        out = []
        for v in x.tolist():
            y = keep * y + (1 - keep) * v
            out.append(y)
        return np.array(out)
    lane = min(_LANE, len(x))
    back = np.subtract.outer(np.arange(lane), np.arange(lane))
    weights = np.where(back >= 0, (1 - keep) * keep ** np.maximum(back, 0), 0.0)
    own = np.pad(x, (0, -len(x) % lane)).reshape(-1, lane) @ weights.T
    powers, came = keep ** np.arange(1.0, lane + 1), []
    for last in own[:, -1].tolist():
        came.append(y)
        y = last + powers[-1] * y
    return (own + np.outer(came, powers)).ravel()[: len(x)]


class _Seeded:
    """y = keep * y + (1 - keep) * x over the values after the nulls at the start, from the mean of the first ``span`` of them; carried from batch to batch."""

    def __init__(self, span: int, keep: float, n: int = 0, y: float = 0.0):
        self.span, self.keep, self.n, self.y = span, keep, n, y

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out, at = np.full(len(x), np.nan), 0
        if self.n < self.span and len(x):
            known = np.flatnonzero(~np.isnan(x))
            at = 0 if self.n else int(known[0]) if len(known) else len(x)
            take = x[at : at + self.span - self.n]
            self.n, self.y, at = self.n + len(take), self.y + float(take.sum()), at + len(take)  # a sum, until there are enough for the mean
            if self.n == self.span and len(take):
                out[at - 1] = self.y = self.y / self.span
        if at < len(x):
            out[at:] = decayed(x[at:], self.keep, self.y)
            self.y = float(out[-1])
        return out


def _smoothed(b: pa.RecordBatch, specs: list[tuple[str, str, int, float]], part: slice, states: list[_Seeded]) -> dict[str, np.ndarray]:
    """The new columns over rows ``part`` of a batch; a later spec may read an earlier one."""
    new: dict[str, np.ndarray] = {}
    for state, (name, source, _, _) in zip(states, specs):
        read = [new[c] if c in new else b.column(b.schema.get_field_index(c)).slice(part.start, part.stop - part.start).to_numpy(zero_copy_only=False).astype(float) for c in source.split("-")]
        new[name] = state(read[0] if len(read) == 1 else read[0] - read[1])
    return new


def smooth(rows: DataFrame | Series, specs: list[tuple[str, str, int, float]], order: str = ORDER, block_rows: int | None = None) -> DataFrame:
    """Adds a column for each (name, source, span, keep): exponential smoothing seeded by a simple mean.

    A later spec may read an earlier one, or ``a-b``, the difference of two columns. A series that fits a block is folded in order in one
    task, all specs in one pass. In a longer one the state after a block is an affine map of that before it (``_smooth_blocks``), so its blocks are folded side by side.
    """
    series = rows if isinstance(rows, Series) else Series(rows, ["series_id"], order, block_rows)
    if series.cut:
        return _smooth_blocks(series, specs, order, block_rows or BLOCK_ROWS)
    rows = series.frame()
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), *(f"`{s[0]}` double" for s in specs)])
    key, columns = rows.columns.index("series_id"), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, states = object(), []
        for b in batches:
            keys, new = b.column(key).to_pylist(), {s[0]: [np.empty(0)] for s in specs}
            heads = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for i, j in zip(heads, heads[1:]):
                if i < j and keys[i] != now:
                    now, states = keys[i], [_Seeded(span, keep) for _, _, span, keep in specs]
                for name, x in _smoothed(b, specs, slice(i, j), states).items():
                    new[name].append(x)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(np.concatenate(x)) for x in new.values())], names=[*columns, *new])

    out = rows.repartition("series_id").sortWithinPartitions("series_id", order).mapInArrow(run, schema)
    return out.withColumns({s[0]: F.when(~F.isnan(s[0]), F.col(s[0])) for s in specs})


def _smooth_blocks(series: Series, specs: list[tuple[str, str, int, float]], order: str, size: int) -> DataFrame:
    """``smooth`` for series of any length.

    Rows are numbered. Those before the first known value have no result; those up to the row at which the last spec has its seed are block 0, the
    others blocks of ``size`` rows. Beyond block 0 a step is y = M y + c(x) with one constant matrix M over all specs, so a block of m rows is
    (M^m, b), with b its end from zero. The maps of a series, a row a block, are applied one after the other, and each block is folded from its true start.
    """
    names = [s[0] for s in specs]
    first: dict[str, Column] = {}
    base = sorted({c for s in specs for c in s[1].split("-")} - set(names))
    rows = series.running(**{NUMBER: ("count", F.lit(1))}).frame()
    known = lambda c: F.min(F.when(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")), F.col(NUMBER))).alias(c)
    starts = rows.groupBy("series_id").agg(*(known(c) for c in base))
    for c in base:
        first[c] = F.col(c)
    for name, source, span, _ in specs:  # the row of a spec's seed; null if it never has one
        read = [first[c] for c in source.split("-")]
        first[name] = (F.greatest(*read) if len(read) > 1 else read[0]) + span - 1
    starts = starts.select("series_id", F.least(*(first[c] for c in base), F.lit(1 << 62)).alias("_begin"), F.greatest(*(first[n] for n in names), F.lit(0)).alias("_warm"))
    block = F.when(F.col(NUMBER) < F.col("_begin"), -1 - F.floor(F.col(NUMBER) / size)).when(F.col(NUMBER) <= F.col("_warm"), 0).otherwise(1 + F.floor((F.col(NUMBER) - F.col("_warm") - 1) / size))
    starts = starts.withColumnRenamed("series_id", "_k")
    rows = rows.join(small(starts), F.col("series_id").eqNullSafe(F.col("_k"))).withColumn(BLOCK, block).drop("_begin", "_warm", "_k")
    rows = materialise(rows, "smooth-blocks")

    step = np.zeros((len(specs), len(specs)))  # how one row without input takes the state on
    for i, (_, source, _, keep) in enumerate(specs):
        step[i, i] = keep
        for sign, c in zip((1, -1), source.split("-")):
            if c in names:
                step[i] += sign * (1 - keep) * step[names.index(c)]

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """series_id, block, rows, n and y of every spec at the end of each block, folded from zero (block 0: from its start)."""
        now, states, m = None, [], 0
        row = lambda: pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((now[0], now[1], m, [s.n for s in states], [s.y for s in states]), kinds)], names=["series_id", BLOCK, "m", "n", "y"])
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()))
        for b in batches:
            keys = list(zip(b.column("series_id").to_pylist(), b.column(BLOCK).to_pylist()))
            heads = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for i, j in zip(heads, heads[1:]):
                if i < j and keys[i] != now:
                    if now:
                        yield row()
                    now, m, states = keys[i], 0, [_Seeded(span, keep, span if keys[i][1] else 0) for _, _, span, keep in specs]
                _smoothed(b, specs, slice(i, j), states)
                m += j - i
        if now:
            yield row()

    dealt = rows.filter(F.col(BLOCK) >= 0).select(F.col("series_id").cast("string").alias("series_id"), BLOCK, NUMBER, *(F.col(c).cast("double").alias(c) for c in base)).repartition("series_id", BLOCK).sortWithinPartitions("series_id", BLOCK, NUMBER)
    summary = materialise(dealt.mapInArrow(ends, f"series_id string, {BLOCK} long, m long, n array<long>, y array<double>"), "smooth-ends")

    def carry(p: pd.DataFrame) -> pd.DataFrame:
        out, n, y = [], np.zeros(len(specs), np.int64), np.zeros(len(specs))
        for r in p.sort_values(BLOCK).itertuples():
            if r[2] == 0:
                n, y = np.array(r.n), np.array(r.y)
                continue
            out.append((r.series_id, r[2], n.tolist(), np.where(n > 0, y, 0.0).tolist()))
            seeded = n > 0  # beyond block 0 a spec has its seed or never will have one
            y = np.where(seeded, np.linalg.matrix_power(step, int(r.m)) @ np.where(seeded, y, 0.0) + np.where(seeded, np.array(r.y), 0.0), 0.0)
        return pd.DataFrame(out, columns=["series_id", BLOCK, "n", "y"])

    carries = summary.groupBy("series_id").applyInPandas(carry, f"series_id string, {BLOCK} long, n array<long>, y array<double>")
    carries = carries.select(F.col("series_id").alias("_k"), F.col(BLOCK).alias("_b"), F.col("n").alias("_n"), F.col("y").alias("_y"))
    joined = rows.join(small(materialise(carries, "smooth-carries")), F.col("series_id").cast("string").eqNullSafe(F.col("_k")) & (F.col(BLOCK) == F.col("_b")), "left").drop("_k", "_b")
    columns = [c for c in rows.columns if c not in (BLOCK, NUMBER)]
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.select(*columns).dtypes), *(f"`{n}` double" for n in names)])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, states = None, []
        for b in batches:
            keys = list(zip(b.column("series_id").to_pylist(), b.column(BLOCK).to_pylist()))
            heads, new = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)], {n: [np.empty(0)] for n in names}
            for i, j in zip(heads, heads[1:]):
                if i < j and keys[i] != now:
                    now, n, y = keys[i], b.column("_n")[i].as_py(), b.column("_y")[i].as_py()
                    states = [_Seeded(span, keep, *((min(n[k], span), y[k]) if n else ())) for k, (_, _, span, keep) in enumerate(specs)]
                for name, x in _smoothed(b, specs, slice(i, j), states).items():
                    new[name].append(x)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), *(pa.array(np.concatenate(x)) for x in new.values())], names=[*columns, *names])

    out = joined.repartition("series_id", BLOCK).sortWithinPartitions("series_id", BLOCK, NUMBER).mapInArrow(fold, schema)
    return out.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in names})


def ema(name: str, source: str, span: int) -> tuple[str, str, int, float]:
    return name, source, span, 1 - 2 / (span + 1)


def wilder(name: str, source: str, span: int) -> tuple[str, str, int, float]:
    return name, source, span, 1 - 1 / span


def true_range(bars: DataFrame, block_rows: int | None = None) -> Series:
    """``bars`` with ``tr``."""
    series = Series(bars, ["series_id"], ORDER, block_rows).running(_c=("lag", F.col("close")))
    h, l, c = (F.col(x) for x in ("high", "low", "_c"))
    series = series.adding(tr=F.coalesce(F.greatest(h - l, F.abs(h - c), F.abs(l - c)), h - l))
    return series.without("_c")


def atr(bars: DataFrame, w: int) -> DataFrame:
    return smooth(true_range(bars), [wilder("atr", "tr", w)])


def bollinger(bars: DataFrame, w: int = 20, k: float = 2.0) -> DataFrame:
    def build(bars: DataFrame) -> DataFrame:
        m, s = F.avg("close").over(last_rows(w)), F.stddev_pop("close").over(last_rows(w))
        out = bars.withColumns({"middle": full(m, w), "upper": full(m + k * s, w), "lower": full(m - k * s, w)})
        return out.withColumn("position", (F.col("close") - F.col("lower")) / F.nullif(F.col("upper") - F.col("lower"), F.lit(0.0)))

    return rolling(bars, "series_id", ORDER, w - 1, build)


def donchian(bars: DataFrame, w: int = 20) -> DataFrame:
    def build(bars: DataFrame) -> DataFrame:
        out = bars.withColumns({"upper": full(F.max("high").over(last_rows(w)), w), "lower": full(F.min("low").over(last_rows(w)), w)})
        return out.withColumn("middle", (F.col("upper") + F.col("lower")) / 2)

    return rolling(bars, "series_id", ORDER, w - 1, build)


def keltner(bars: DataFrame, w: int = 20, k: float = 2.0) -> DataFrame:
    out = smooth(true_range(bars), [ema("middle", "close", w), wilder("atr", "tr", w)])
    return out.withColumns({"upper": F.col("middle") + k * F.col("atr"), "lower": F.col("middle") - k * F.col("atr")})


def chandelier(bars: DataFrame, w: int = 22, k: float = 3.0) -> DataFrame:
    out = atr(donchian(bars, w), w)
    return out.withColumns({"long_stop": F.col("upper") - k * F.col("atr"), "short_stop": F.col("lower") + k * F.col("atr")})


def atr_stop(entry: Column, size: Column, side: Column, k: float = 2.0) -> tuple[Column, Column, Column]:
    d = k * size
    return F.when(side == "long", entry - d).otherwise(entry + d), d, d / F.nullif(entry, F.lit(0.0)) * 100


def _signal(x: Column, high: float, low: float) -> Column:
    return F.when(x > high, "overbought").when(x < low, "oversold").otherwise("neutral")


def rsi(bars: DataFrame, w: int = 14) -> DataFrame:
    series, d = Series(bars, ["series_id"], ORDER).running(_c=("lag", F.col("close"))), F.col("close") - F.col("_c")
    series = series.adding(gain=F.greatest(d, d * 0), loss=F.greatest(-d, d * 0)).without("_c")
    out = smooth(series, [wilder("ag", "gain", w), wilder("al", "loss", w)])
    x = F.when(F.col("ag").isNull(), None).when(F.col("al") == 0, 100.0).otherwise(100 - 100 / (1 + F.col("ag") / F.col("al")))
    return out.withColumn("rsi", x).withColumn("signal", _signal(F.col("rsi"), 70, 30))


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    out = smooth(bars, [ema("ef", "close", fast), ema("es", "close", slow), ema("signal", "ef-es", signal)])
    return out.withColumn("macd", F.col("ef") - F.col("es")).withColumn("histogram", F.col("macd") - F.col("signal"))


def stochastic(bars: DataFrame, k: int = 14, d: int = 3) -> DataFrame:
    """%K of 50 where the range is flat; %D averages %K rounded to four digits."""

    def build(bars: DataFrame) -> DataFrame:
        hh, ll = F.max("high").over(last_rows(k)), F.min("low").over(last_rows(k))
        x = F.when(hh == ll, 50.0).otherwise(F.round(100 * (F.col("close") - ll) / (hh - ll), 4))
        out = bars.withColumn("k", full(x, k))
        return out.withColumn("d", full(F.avg("k").over(last_rows(d)), k + d - 1)).withColumn("signal", _signal(F.col("k"), 80, 20))

    return rolling(bars, "series_id", ORDER, k + d - 2, build)


def cci(bars: DataFrame, w: int = 20) -> DataFrame:
    def build(bars: DataFrame) -> DataFrame:
        out = bars.withColumn("tp", (F.col("high") + F.col("low") + F.col("close")) / 3)
        out = out.withColumns({"_m": F.avg("tp").over(last_rows(w)), "_x": F.collect_list("tp").over(last_rows(w))})
        mad = F.aggregate("_x", F.lit(0.0), lambda a, x: a + F.abs(x - F.col("_m"))) / w
        out = out.withColumn("_d", mad).withColumn("cci", full(F.when(F.col("_d") < 1e-12, 0.0).otherwise((F.col("tp") - F.col("_m")) / (0.015 * F.col("_d"))), w))
        x = F.col("cci")
        band = F.when(x > 200, "strong_overbought").when(x > 100, "overbought").when(x < -100, "oversold").when(x < -200, "strong_oversold").otherwise("neutral")
        return out.drop("_m", "_x", "_d").withColumn("signal", band)

    return rolling(bars, "series_id", ORDER, w - 1, build)


def williams_r(bars: DataFrame, w: int = 14) -> DataFrame:
    def build(bars: DataFrame) -> DataFrame:
        hh, ll = F.max("high").over(last_rows(w)), F.min("low").over(last_rows(w))
        out = bars.withColumn("williams_r", full(F.when(hh == ll, -50.0).otherwise(-100 * (hh - F.col("close")) / (hh - ll)), w))
        return out.withColumn("signal", _signal(F.col("williams_r"), -20, -80))

    return rolling(bars, "series_id", ORDER, w - 1, build)


def rolling_sharpe(rows: DataFrame, value: str, w: int, periods: int = 252) -> DataFrame:
    def build(rows: DataFrame) -> DataFrame:
        s = F.stddev_samp(value).over(last_rows(w))
        return rows.withColumn("sharpe", full(F.avg(value).over(last_rows(w)) / F.when(s > 0, s) * float(periods) ** 0.5, w))

    return rolling(rows, "series_id", ORDER, w - 1, build)


def rolling_volatility(rows: DataFrame, value: str, w: int, periods: int = 252) -> DataFrame:
    def build(rows: DataFrame) -> DataFrame:
        return rows.withColumn("volatility", full(F.stddev_samp(value).over(last_rows(w)) * float(periods) ** 0.5, w))

    return rolling(rows, "series_id", ORDER, w - 1, build)


def rolling_correlation(pairs: DataFrame, w: int) -> DataFrame:
    def build(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("correlation", full(F.corr("a", "b").over(last_rows(w)), w))

    return rolling(pairs, "series_id", ORDER, w - 1, build)


def rolling_beta_alpha(pairs: DataFrame, w: int) -> DataFrame:
    """Slope and intercept of a on b."""

    def build(pairs: DataFrame) -> DataFrame:
        return pairs.withColumns({"beta": full(F.regr_slope("a", "b").over(last_rows(w)), w), "alpha": full(F.regr_intercept("a", "b").over(last_rows(w)), w)})

    return rolling(pairs, "series_id", ORDER, w - 1, build)


def rolling_drawdown(rows: DataFrame, value: str, w: int) -> DataFrame:
    """Worst fall from a peak, in percent, with the peak sought in each window anew."""

    def build(rows: DataFrame) -> DataFrame:
        xs = F.collect_list(value).over(last_rows(w))
        zero = F.struct(F.lit(float("-inf")).alias("p"), F.lit(0.0).alias("d"))

        def step(a: Column, x: Column) -> Column:
            p = F.greatest(a["p"], x)
            return F.struct(p.alias("p"), F.greatest(a["d"], F.when(p > 0, (p - x) / p * 100).otherwise(0.0)).alias("d"))

        return rows.withColumn("_x", xs).withColumn("drawdown_pct", full(F.aggregate("_x", zero, step)["d"], w)).drop("_x")

    return rolling(rows, "series_id", ORDER, w - 1, build)


def rolling_win_rate(rows: DataFrame, value: str, w: int, order: str = ORDER) -> DataFrame:
    def build(rows: DataFrame) -> DataFrame:
        return rows.withColumn("win_rate", full(F.avg(F.when(F.col(value) > 0, 1.0).otherwise(0.0)).over(last_rows(w, order)), w, order))

    return rolling(rows, "series_id", order, w - 1, build)


def tertile_regimes(rows: DataFrame, measure: str, names: tuple[str, str, str]) -> DataFrame:
    """Labels by the values at sorted places n div 3 and 2n div 3 of each series; ``unknown`` with under six values or none at a row."""
    known = rows.filter(F.col(measure).isNotNull()).select("series_id", measure)
    nth, n = F.row_number().over(Window.partitionBy("series_id").orderBy(measure)) - 1, F.count(F.lit(1)).over(Window.partitionBy("series_id"))
    ranked = known.withColumns({"_i": nth, "_n": n})
    at = lambda k: F.max(F.when(F.col("_i") == F.floor(F.col("_n") * k / 3), F.col(measure)))
    cuts = ranked.groupBy("series_id").agg(at(1).alias("_lo"), at(2).alias("_hi"), F.max("_n").alias("_n"))
    x = F.col(measure)
    label = F.when(x.isNull() | F.col("_n").isNull() | (F.col("_n") < 6), "unknown").when(x <= F.col("_lo"), names[0]).when(x <= F.col("_hi"), names[1]).otherwise(names[2])
    return rows.join(cuts, "series_id", "left").withColumn("regime", label).drop("_lo", "_hi", "_n")


def volatility_regimes(rows: DataFrame, value: str, w: int = 20) -> DataFrame:
    measured = rolling(rows, "series_id", ORDER, w - 1, lambda r: r.withColumn("measure", full(F.stddev_samp(value).over(last_rows(w)), w)))
    return tertile_regimes(measured, "measure", ("low", "normal", "high"))


def trend_regimes(rows: DataFrame, value: str, w: int = 50) -> DataFrame:
    measured = rolling(rows, "series_id", ORDER, w - 1, lambda r: r.withColumn("measure", full(F.regr_slope(value, F.col(ORDER).cast("double")).over(last_rows(w)), w)))
    return tertile_regimes(measured, "measure", ("bear", "neutral", "bull"))


def volatilities(bars: DataFrame, periods: int = 252) -> DataFrame:
    """Close-to-close, Parkinson, Garman-Klass, Rogers-Satchell and Yang-Zhang, annualised, in one pass a series.

    Bars with a price at or below zero add nothing to the sums but count as bars. Yang-Zhang leaves them and the bars after such a close out, and is null under two bars.
    """
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    ok = (o > 0) & (h > 0) & (l > 0) & (c > 0)
    bars, lc = running(bars, ["series_id"], ORDER, _lc=("lag", F.col("close"))), F.col("_lc")
    safe = lambda x: F.coalesce(F.when(ok, x), F.lit(0.0))
    rows = bars.withColumns({
        "_r": F.when(lc.isNotNull(), F.coalesce(F.when((c > 0) & (lc > 0), F.ln(c / lc)), F.lit(0.0))), "_pk": safe(F.ln(h / l) ** 2), "_gk": safe(0.5 * F.ln(h / l) ** 2 - (2 * F.ln(F.lit(2.0)) - 1) * F.ln(c / o) ** 2),
        "_rs": safe(F.ln(h / o) * F.ln(h / c) + F.ln(l / o) * F.ln(l / c)), "_on": F.when(ok & (lc > 0), F.ln(o / lc)), "_oc": F.when(ok & (lc > 0), F.ln(c / o)), "_rs2": F.when(ok & (lc > 0), F.ln(h / o) * F.ln(h / c) + F.ln(l / o) * F.ln(l / c)),
    })
    year, m = float(periods), F.count("_oc")
    k = 0.34 / (1.34 + (m + 1) / F.nullif(m - 1, F.lit(0)))
    yz = F.var_samp("_on") + k * F.var_samp("_oc") + (1 - k) * F.avg("_rs2")
    root = lambda x: F.sqrt(F.greatest(x, F.lit(0.0)) * year)
    return rows.groupBy("series_id").agg(
        (F.stddev_samp("_r") * year**0.5).alias("close_to_close"), root(F.avg("_pk") / (4 * F.ln(F.lit(2.0)))).alias("parkinson"), root(F.avg("_gk")).alias("garman_klass"),
        root(F.avg("_rs")).alias("rogers_satchell"), F.when(m >= 2, root(yz)).alias("yang_zhang"),
    )
