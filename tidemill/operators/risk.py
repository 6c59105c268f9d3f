"""Return ratios, tail risk, drawdowns, benchmarks, exposure, attribution and sizing, per key."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import bands, hhi, normal_quantile, ratio, small, with_total
from ..session import materialise
from .scan import Series, running

UNDERWATER = [("<", 0.2, "rarely_underwater"), ("<", 0.5, "moderately_underwater"), ("<", 0.8, "often_underwater")]
CONCENTRATION = [(">", 0.5, "very_concentrated"), (">", 0.25, "concentrated"), (">", 0.1, "moderately_diversified")]
CORRELATED = [("<", 0.6, "strong_diversification"), ("<", 0.85, "moderate_diversification"), ("<", 0.98, "weak_diversification")]
BIAS = [(">", 0.5, "strongly_long"), (">", 0.2, "moderately_long"), (">=", -0.2, "balanced"), (">=", -0.5, "moderately_short")]


def sharpe(r: Column, periods: int = 252, rf: float = 0.0, population: bool = False) -> Column:
    x = r - rf / periods
    return ratio(F.avg(x), (F.stddev_pop if population else F.stddev_samp)(x)) * float(periods) ** 0.5


def sortino(r: Column, periods: int = 252, rf: float = 0.0, population: bool = False) -> Column:
    """The sample form divides the squared shortfalls by their number less one, the population form by all rows."""
    x = r - rf / periods
    down = F.when(x < 0, x)
    n = F.count(F.lit(1)) if population else F.count(down) - 1
    return ratio(F.avg(x), F.sqrt(F.when(n > 0, F.sum(down * down) / n))) * float(periods) ** 0.5


def omega(r: Column, threshold: float = 0.0) -> Column:
    return ratio(F.sum(F.greatest(r - threshold, F.lit(0.0))), F.sum(F.greatest(threshold - r, F.lit(0.0))))


def with_drawdown(rows: DataFrame, value: str = "v", key: str = "series_id", order: str = "idx", floor: float | None = None) -> DataFrame:
    """Adds ``peak`` so far (at least ``floor``, if given) and ``dd``, the fall from it as a share."""
    rows = running(rows, [key], order, peak=("max", F.col(value)))
    rows = rows if floor is None else rows.withColumn("peak", F.greatest("peak", F.lit(floor)))
    return rows.withColumn("dd", F.when(F.col("peak") > 0, (F.col("peak") - F.col(value)) / F.col("peak")).otherwise(0.0))


def growth(rows: DataFrame, periods: int = 252) -> DataFrame:
    """Total return, drawdown, annual growth and its ratio to the drawdown."""
    d = with_drawdown(rows).groupBy("series_id").agg(F.min_by("v", "idx").alias("a"), F.max_by("v", "idx").alias("z"), (F.max("dd") * 100).alias("max_drawdown_pct"), (F.count(F.lit(1)) / periods).alias("years"))
    cagr = (F.pow(F.col("z") / F.col("a"), 1 / F.col("years")) - 1) * 100
    return d.withColumn("cagr_pct", cagr).withColumn("calmar", ratio(F.col("cagr_pct"), F.col("max_drawdown_pct")))


def worst_share(rows: DataFrame, value: str, confidence: float, key: str = "series_id") -> DataFrame:
    """Mean of the worst max(1, round((1-c) n)) values, negated; the count rounds half to even.

    Equal values are one row with their number before they are ranked.
    """
    counts = materialise(rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("_c")), "value-counts")
    cut = F.greatest(F.bround((1 - confidence) * F.sum("_c"), 0), F.lit(1.0)).cast("long")
    ranked = running(counts, [key], value, _before=("sum_before", F.col("_c"))).join(small(counts.groupBy(key).agg(cut.alias("_cut"))), key)
    taken = F.least(F.col("_c"), F.col("_cut") - F.coalesce("_before", F.lit(0)))
    tail = ranked.withColumn("_t", taken).filter("_t > 0")
    return tail.groupBy(key).agg((-F.sum(F.col(value) * F.col("_t")) / F.sum("_t")).alias("cvar"), (-F.max(value)).alias("var"), F.sum("_t").alias("tail_size"))


def parametric_var(r: Column, confidence: float) -> Column:
    return -(F.avg(r) + normal_quantile(1 - confidence) * F.stddev_samp(r))


def drawdown_episodes(rows: DataFrame, value: str = "v", key: str = "series_id", order: str = "idx") -> DataFrame:
    """Episodes from a peak to the first value at or above it; the last may be open.

    A value at or above the peak so far starts an island, the values below it up to the next are its drawdown.
    """
    series = Series(rows.select(key, order, value), [key], order).running(_before=("max_before", F.col(value)))
    series = series.adding(_new=F.when(F.col("_before").isNull() | (F.col(value) >= F.col("_before")), 1).otherwise(0))
    marked = series.running(_upto=("sum", F.col("_new"))).frame()
    # the row that starts an island ends the drawdown of the one before, so it is told to both
    marked = marked.withColumn("island", F.explode(F.when(F.col("_new") == 1, F.array("_upto", F.col("_upto") - 1)).otherwise(F.array("_upto"))))
    own = lambda x: F.when(F.col("island") == F.col("_upto"), x)
    under = lambda x: F.when((F.col("island") == F.col("_upto")) & (F.col("_new") == 0), x)
    at = F.col(order)
    out = marked.groupBy(key, "island").agg(
        F.min(own(at)).alias("start"), F.max(own(at)).alias("_end"), F.count(own(F.lit(1))).alias("_n"), F.min_by(value, own(at)).alias("_peak"), F.min(own(F.col(value))).alias("_low"),
        F.min_by(at, under(F.struct(value, order))).alias("trough"), F.min(F.when(F.col("island") < F.col("_upto"), at)).alias("recovery"),
    ).filter("_n > 1")
    return out.select(
        key, "start", "trough", "recovery", F.when(F.col("_peak") > 0, (F.col("_peak") - F.col("_low")) / F.col("_peak") * 100).otherwise(0.0).alias("depth_pct"),
        (F.coalesce("recovery", F.col("_end") + 1) - F.col("start")).alias("duration"), (F.col("trough") - F.col("start")).alias("drop_bars"), (F.col("recovery") - F.col("trough")).alias("recovery_bars"),
    )


def pain_buckets(rows: DataFrame, buckets: list[float]) -> DataFrame:
    pct = F.col("dd") * 100
    label = F.lit(None).cast("double")
    for b in sorted(buckets):
        label = F.when(pct >= b, F.lit(float(b))).otherwise(label)
    d = with_drawdown(rows).withColumn("bucket", label)
    return d.filter("bucket is not null").groupBy("series_id", "bucket").agg(F.sum(pct).alias("pain"), F.count(F.lit(1)).alias("bars"))


def longest_runs(rows: DataFrame, kind: Column, key: str, order: str) -> DataFrame:
    """Longest run of rows of the same kind, per key and kind (null kinds break runs and are left out)."""
    series = Series(rows.withColumn("kind", kind), [key], order).running(_last=("lag", F.col("kind")))
    series = series.adding(_change=F.when(F.col("kind").eqNullSafe(F.col("_last")), 0).otherwise(1)).running(_g=("sum", F.col("_change")))
    runs = series.frame().filter("kind is not null").groupBy(key, "kind", "_g").agg(F.count(F.lit(1)).alias("run"))
    return runs.groupBy(key, "kind").agg(F.max("run").alias("longest"))


def combined_curve(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted sum of curves up to the shortest one's end; negative weights count as zero, all zero as equal. ``weights`` has a row a curve."""
    w = weights.withColumn("w", F.greatest("w", F.lit(0.0)))
    w = with_total(w, _total=F.sum("w"), _n=F.count(F.lit(1)))
    w = w.select("series_id", F.when(F.col("_total") > 0, F.col("w") / F.col("_total")).otherwise(1 / F.col("_n")).alias("w"))
    shortest = rows.groupBy("series_id").agg(F.max("idx").alias("last")).agg(F.min("last").alias("last"))
    return rows.join(w, "series_id").join(F.broadcast(shortest)).filter("idx <= last").groupBy("idx").agg(F.sum(F.col("v") * F.col("w")).alias("v"))


def exposure(positions: DataFrame) -> DataFrame:
    """Net, gross, long and short notional by book and symbol, and for the book (symbol null), in one pass."""
    long = F.sum(F.when(F.col("side") == "long", F.col("notional")).otherwise(0.0))
    short = F.sum(F.when(F.col("side") == "long", 0.0).otherwise(F.col("notional")))
    out = positions.groupingSets([["book_id", "symbol"], ["book_id"]], "book_id", "symbol").agg(long.alias("long"), short.alias("short"), F.count(F.lit(1)).alias("n"))
    out = out.withColumns({"net": F.col("long") - F.col("short"), "gross": F.col("long") + F.col("short")})
    return out.withColumn("bias", F.when(F.col("gross") <= 0, "no_exposure").otherwise(bands(F.col("net") / F.col("gross"), BIAS, "strongly_short")))


def concentration(rows: DataFrame, key: str, member: str, size: Column) -> DataFrame:
    """Raw and scaled Herfindahl index of the members' shares."""
    g = rows.groupBy(key, member).agg(F.sum(size).alias("_s"))
    g = g.withColumn("share", ratio(F.col("_s"), F.sum("_s").over(Window.partitionBy(key))))
    raw, scaled = hhi("share", F.count(F.lit(1)))
    return g.groupBy(key).agg(raw.alias("hhi"), scaled.alias("hhi_scaled"), F.count(F.lit(1)).alias("n"), F.max("share").alias("top_share"))


def signed_weights(positions: DataFrame) -> DataFrame:
    signed = F.sum(F.when(F.col("side") == "long", F.col("notional")).otherwise(-F.col("notional")))
    return positions.groupBy("book_id", "symbol").agg(signed.alias("w"))


def quadratic_form(weights: DataFrame, correlations: DataFrame) -> DataFrame:
    """Terms w_i w_j rho_ij by book and i; a symbol has 1 with itself, a missing pair 0, either orientation serves. A book's symbols are few."""
    both = correlations.select("sym_a", "sym_b", "rho").union(correlations.select("sym_b", "sym_a", "rho")).groupBy("sym_a", "sym_b").agg(F.max("rho").alias("rho"))
    a, b = weights.select("book_id", F.col("symbol").alias("sym_a"), F.col("w").alias("wa")), weights.select("book_id", F.col("symbol").alias("sym_b"), F.col("w").alias("wb"))
    rho = F.when(F.col("sym_a") == F.col("sym_b"), 1.0).otherwise(F.coalesce("rho", F.lit(0.0)))
    terms = a.join(b, "book_id").join(both, ["sym_a", "sym_b"], "left")
    return terms.groupBy("book_id", F.col("sym_a").alias("symbol")).agg(F.sum(F.col("wa") * F.col("wb") * rho).alias("term"))


def bucket_returns(rows: DataFrame, n: int) -> DataFrame:
    """Percent change inside n buckets of equal count; the last takes the remainder."""
    counts = rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("_all"))
    rows = running(rows, ["series_id"], "idx", _rn=("count", F.lit(1))).join(counts, "series_id")
    b = F.least(F.floor((F.col("_rn") - 1) / F.floor(F.col("_all") / n)), F.lit(n - 1))
    first, last = F.min_by("v", "idx"), F.max_by("v", "idx")
    return rows.withColumn("bucket", b).groupBy("series_id", "bucket").agg(F.coalesce(ratio(last - first, F.abs(first)), F.lit(0.0)).alias("_r")).select("series_id", "bucket", (F.col("_r") * 100).alias("return_pct"))


def lot_size(balance: Column, risk_pct: Column, entry: Column, stop: Column, contract: float = 1.0, step: float = 0.01, least: float = 0.01, most: float = 100.0) -> Column:
    """Lots that risk ``risk_pct`` of the balance, rounded down to the step and held to the bounds; null without a stop distance."""
    raw = ratio(balance * risk_pct / 100, contract * F.abs(entry - stop))
    return F.when(raw.isNotNull(), F.greatest(F.lit(least), F.least(F.lit(most), F.floor(raw / step) * step)))


def kelly(win_rate: Column, avg_win: Column, avg_loss: Column) -> Column:
    return F.greatest(F.coalesce(win_rate - (1 - win_rate) / F.nullif(ratio(avg_win, avg_loss), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))


def ruin(win_rate: Column, payoff: Column, risk_pct: float, threshold_pct: float = 50.0) -> Column:
    edge = win_rate * payoff - (1 - win_rate)
    return F.when(edge <= 0, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.pow((1 - edge) / (1 + edge), F.lit(threshold_pct / risk_pct)))))


def irr(flows: DataFrame, tol: float = 1e-10) -> DataFrame:
    """Internal rate per account by bisection on (-0.99, 10); null unless flows have both signs and the ends straddle zero."""

    def solve(p: pd.DataFrame) -> pd.DataFrame:
        x = p.sort_values("t", kind="stable")["flow"].to_numpy()
        t = np.arange(len(x))
        npv = lambda r: float((x / (1 + r) ** t).sum())
        lo, hi = -0.99, 10.0
        if not ((x > 0).any() and (x < 0).any()) or npv(lo) * npv(hi) > 0:
            return pd.DataFrame({"account": [p["account"].iloc[0]], "irr": [None]})
        up = npv(lo) > 0
        while hi - lo > tol:
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if (npv(mid) > 0) == up else (lo, mid)
        return pd.DataFrame({"account": [p["account"].iloc[0]], "irr": [(lo + hi) / 2]})

    return flows.select("account", "t", "flow").groupBy("account").applyInPandas(solve, "account long, irr double")


def liquidation_price(entry: Column, leverage: Column, long: Column, margin_pct: Column) -> Column:
    """Price at which an isolated position is closed: the entry less (long) or plus (short) what leverage leaves above the maintenance margin."""
    room = 1 / leverage - margin_pct / 100
    return entry * (1 + F.when(long, -room).otherwise(room))
