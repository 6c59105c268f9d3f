"""Analytics of trade lists, per strategy: costs, replay, stress, brittleness, calendars, drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import bands, ratio

KEY, ORDER = "strategy_id", "seq"


def metrics(trades: DataFrame, *keys: str, order: str | list[str] = ORDER, floor: float | None = 0.0) -> DataFrame:
    """n, net, gross profit and loss, win rate, profit factor, mean and worst fall of the running sum, per key.

    The peak starts at ``floor`` (0 before the first trade), or with None at the first value of the sum.
    """
    keys = keys or (KEY,)
    order = [order] if isinstance(order, str) else order
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = trades.withColumn("_eq", F.sum("pnl").over(w))
    peak = F.max("_eq").over(w)
    run = run.withColumn("_dd", (peak if floor is None else F.greatest(peak, F.lit(floor))) - F.col("_eq"))
    gain, loss = F.sum(F.greatest("pnl", F.lit(0.0))), F.sum(F.greatest(-F.col("pnl"), F.lit(0.0)))
    return run.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("pnl").alias("net"), gain.alias("gross_profit"), loss.alias("gross_loss"), F.avg((F.col("pnl") > 0).cast("double")).alias("win_rate"),
        ratio(gain, loss).alias("profit_factor"), F.avg("pnl").alias("mean_pnl"), F.max("_dd").alias("max_drawdown"),
    )


def with_costs(trades: DataFrame, commission: float, slippage: float, point: float = 1.0) -> DataFrame:
    return trades.withColumn("pnl", F.col("pnl") - (commission + slippage * point))


def cost_grid(trades: DataFrame, commissions: list[float], slippages: list[float], point: float = 1.0) -> DataFrame:
    """Net profit for each pair of costs, from one sum and count a strategy, to a millionth: the order of a sum decides no sign."""
    grid = F.array(*(F.struct(F.lit(c).alias("commission"), F.lit(s).alias("slippage")) for c in commissions for s in slippages))
    out = trades.groupBy(KEY).agg(F.sum("pnl").alias("_s"), F.count(F.lit(1)).alias("_n")).select("*", F.inline(grid))
    net = F.round(F.col("_s") - F.col("_n") * (F.col("commission") + F.col("slippage") * point), 6)
    return out.select(KEY, "commission", "slippage", net.alias("net"), (net > 0).alias("survives"))


def sized(trades: DataFrame, mode: str, start: float = 10000.0, lot: float = 1.0, fraction: float = 0.001, risk_pct: float = 1.0, risk: float = 100.0) -> DataFrame:
    """pnl scaled by size: a fixed lot, a fraction of equity, or a share of equity by average risk.

    Equity compounds: a trade multiplies it by one plus share times pnl, and the first factor that is not positive ends
    all sizes. So equity is the exponential of a running sum of logarithms, and a window gives it.
    """
    if mode == "fixed_lot":
        return trades.withColumn("size", F.lit(lot)).withColumn("pnl", F.col("pnl") * lot)
    share = fraction if mode == "fixed_fractional" else risk_pct / 100 / max(risk, 1e-9)
    before = Window.partitionBy(KEY).orderBy(ORDER).rowsBetween(Window.unboundedPreceding, -1)
    rows = trades.select(KEY, ORDER, "pnl").withColumn("_f", 1 + share * F.col("pnl"))
    grown = F.exp(F.coalesce(F.sum(F.ln(F.when(F.col("_f") > 0, F.col("_f")))).over(before), F.lit(0.0)))
    over = F.coalesce(F.max(F.col("_f") <= 0).over(before), F.lit(False))
    rows = rows.withColumn("size", F.when(over, 0.0).otherwise(start * share * grown))
    return rows.select(KEY, ORDER, (F.col("pnl") * F.col("size")).alias("pnl"), "size")


def risk_capped(trades: DataFrame, trade_cap: float | None, day_cap: float | None, week_cap: float | None, per_day: int) -> DataFrame:
    """pnl under loss caps, with ``capped`` (the loss was cut to the cap of a trade), ``skipped`` (it would have broken that of its day or week), ``day`` and ``week``.

    A day is ``per_day`` trades in order, a week five days. The running loss of either falls by gains, to zero at
    least, and ends with it; so weeks do not touch each other: a week's few trades are one array, folded by an expression.
    """
    at = F.row_number().over(Window.partitionBy(KEY).orderBy(ORDER)) - 1
    rows = trades.select(KEY, ORDER, "pnl").withColumn("day", F.floor(at / per_day))
    weeks = rows.groupBy(KEY, F.floor(F.col("day") / 5).alias("week")).agg(F.array_sort(F.collect_list(F.struct(ORDER, "day", "pnl"))).alias("xs"))  # 5 * per_day trades at most
    result = f"struct<{ORDER}:bigint,day:bigint,pnl:double,capped:boolean,skipped:boolean>"
    state = f"struct<day:bigint,lost:double,week_lost:double,out:array<{result}>>"

    def step(a: Column, x: Column) -> Column:
        cut = x["pnl"] if trade_cap is None else F.greatest(x["pnl"], F.lit(-float(trade_cap)))
        today = F.when(a["day"] == x["day"], a["lost"]).otherwise(0.0)
        breaks = [(lost - cut) > cap for lost, cap in ((today, day_cap), (a["week_lost"], week_cap)) if cap is not None]
        skip = (cut < 0) & (F.greatest(F.lit(False), *breaks) if breaks else F.lit(False))
        kept = F.when(skip, 0.0).otherwise(cut)
        row = F.struct(x[ORDER], x["day"], kept, cut != x["pnl"], skip).cast(result)
        fallen = lambda lost: F.greatest(F.lit(0.0), lost - kept)
        return F.struct(x["day"], fallen(today), fallen(a["week_lost"]), F.concat(a["out"], F.array(row))).cast(state)

    zero = F.struct(F.lit(-1), F.lit(0.0), F.lit(0.0), F.array().cast(f"array<{result}>")).cast(state)
    return weeks.select(KEY, "week", F.inline(F.aggregate("xs", zero, step)["out"]))


def cap_counts(capped: DataFrame, per_day: int) -> DataFrame:
    """Per strategy: trades whose loss was cut, trades left out, and the whole days and weeks gone through."""
    n = F.count(F.lit(1))
    return capped.groupBy(KEY).agg(
        F.count(F.when(F.col("capped"), 1)).alias("n_capped"), F.count(F.when(F.col("skipped"), 1)).alias("n_skipped"), F.floor(n / per_day).alias("n_days"), F.floor(n / (5 * per_day)).alias("n_weeks")
    )


def slipped(pnl: Column, pct: float) -> Column:
    f = pct / 100
    return F.when(pnl > 0, pnl * (1 - f)).when(pnl < 0, pnl * (1 + f)).otherwise(pnl)


def without_best(trades: DataFrame, n: int) -> DataFrame:
    rn = F.row_number().over(Window.partitionBy(KEY).orderBy(F.desc("pnl"), ORDER))
    return trades.withColumn("_i", rn).filter(F.col("_i") > n).drop("_i")


def skip_key(seed: int) -> Column:
    """A uniform number of 0..1 that depends on the row alone, not on partitions: the same rows go on every run."""
    hexed = F.substring(F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col(KEY).cast("string"), F.col(ORDER).cast("string"))), 1, 8)
    return F.conv(hexed, 16, 10).cast("long") % 1_000_000 / 1_000_000


def randomly_skipped(trades: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return trades.filter(skip_key(seed) >= fraction)


def worst_first(trades: DataFrame, k: int) -> DataFrame:
    """Adds ``place``: the k worst trades come first, worst first, the others after them in their order."""
    rn = F.row_number().over(Window.partitionBy(KEY).orderBy("pnl", ORDER))
    return trades.withColumn("_i", rn).withColumn("place", F.when(F.col("_i") <= k, F.col("_i") - k - 1).otherwise(F.col(ORDER))).drop("_i")


def stress(trades: DataFrame, slip: float = 2.0, best: int = 5, skip: float = 0.05, streak: int = 10, seed: int = 42) -> DataFrame:
    """Metrics of the original and four stressed lists, a row a strategy and scenario, in one aggregate."""
    rows = trades.select(KEY, ORDER, "pnl")
    parts = {
        "original": rows.withColumn("place", F.col(ORDER)), "slippage": rows.withColumn("pnl", slipped(F.col("pnl"), slip)).withColumn("place", F.col(ORDER)), "skip_best": without_best(rows, best).withColumn("place", F.col(ORDER)),
        "random_skip": randomly_skipped(rows, skip, seed).withColumn("place", F.col(ORDER)), "worst_streak": worst_first(rows, streak),
    }
    out = None
    for name, p in parts.items():
        p = p.select(KEY, "place", "pnl", F.lit(name).alias("scenario"))
        out = p if out is None else out.union(p)
    return metrics(out, KEY, "scenario", order="place")


def stress_verdict(stressed: DataFrame) -> DataFrame:
    dead = F.count(F.when((F.col("scenario") != "original") & (F.col("net") <= 0), 1))
    return stressed.groupBy(KEY).agg(dead.alias("killed")).withColumn("verdict", bands(F.col("killed"), [(">=", 3, "fragile"), (">=", 1, "moderate")], "robust"))


def gini(rows: DataFrame, value: str, key: str) -> DataFrame:
    """Gini coefficient of sizes, 0 without any."""
    a = rows.withColumn("_a", F.abs(value))
    a = a.withColumn("_i", F.row_number().over(Window.partitionBy(key).orderBy("_a")))
    n, total = F.count(F.lit(1)), F.sum("_a")
    return a.groupBy(key).agg(F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * F.sum(F.col("_i") * F.col("_a")) / F.nullif(n * total, F.lit(0.0)) - (n + 1) / n)), F.lit(0.0)).alias("gini"))


def top_share(rows: DataFrame, value: str, key: str, n: Column, name: str) -> DataFrame:
    """Percent of the positive sum that the ``n`` largest values hold; ``n`` may use ``_n``, the number of rows."""
    ranked = rows.withColumns({"_i": F.row_number().over(Window.partitionBy(key).orderBy(F.desc(value))), "_n": F.count(F.lit(1)).over(Window.partitionBy(key))})
    pos = F.greatest(F.col(value), F.lit(0.0))
    return ranked.groupBy(key).agg(F.coalesce(100 * ratio(F.sum(F.when(F.col("_i") <= n, pos)), F.sum(pos)), F.lit(0.0)).alias(name))


def brittle(trades: DataFrame, key: str = KEY) -> DataFrame:
    """Gini of the sizes, percent of the gains in the best twentieth and tenth of the trades (one at least), and the verdict."""
    at = lambda k: F.greatest(F.lit(1), F.floor(F.col("_n") / k))
    g = gini(trades, "pnl", key).join(top_share(trades, "pnl", key, at(20), "top5"), key).join(top_share(trades, "pnl", key, at(10), "top10"), key)
    return g.withColumn("verdict", F.when(F.col("top10") >= 80, "very_brittle").when(F.col("top10") >= 60, "brittle").when(F.col("gini") > 0.7, "skewed").otherwise("robust"))


def calendar(trades: DataFrame, part: Column, every: list, name: str) -> DataFrame:
    """Counts and sums by a part of the closing time; all values of the part are there, with nulls for means and extremes of none."""
    p = F.col("pnl")
    g = trades.groupBy(part.alias(name)).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(p > 0, 1)).alias("wins"), F.sum(p).alias("total"), F.max(p).alias("best"), F.min(p).alias("worst"), F.avg(p).alias("mean"))
    full = trades.sparkSession.createDataFrame([(x,) for x in every], f"{name} int")
    out = full.join(g, name, "left").fillna(0, ["n", "wins"]).fillna(0.0, ["total"])
    return out.withColumn("win_rate", F.col("wins") / F.nullif(F.col("n"), F.lit(0)))


def by_group(trades: DataFrame, *keys: str) -> DataFrame:
    p = F.col("pnl")
    return trades.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(p > 0, 1)).alias("wins"), F.sum(p).alias("total"), F.avg(p).alias("mean"), F.avg((p > 0).cast("double")).alias("win_rate"))


def ks_distance(rows: DataFrame, value: str, side: str, *keys: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance between rows with ``side`` true and false, and its 5% bound, per key."""
    g = rows.groupBy(*keys, value).agg(F.count(F.when(F.col(side), 1)).alias("_a"), F.count(F.when(~F.col(side), 1)).alias("_b"))
    w, every = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*keys)
    g = g.withColumns({"na": F.sum("_a").over(every), "nb": F.sum("_b").over(every), "_fa": F.sum("_a").over(w), "_fb": F.sum("_b").over(w)})
    d = F.max(F.abs(F.col("_fa") / F.nullif(F.col("na"), F.lit(0)) - F.col("_fb") / F.nullif(F.col("nb"), F.lit(0))))
    out = g.groupBy(*keys).agg(F.coalesce(d, F.lit(0.0)).alias("ks"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    return out.withColumn("critical", 1.36 * F.sqrt((F.col("na") + F.col("nb")) / F.nullif(F.col("na") * F.col("nb"), F.lit(0))))


def wilson(p: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    centre, margin, denom = p + z * z / (2 * n), z * F.sqrt((p * (1 - p) + z * z / (4 * n)) / n), 1 + z * z / n
    return F.greatest(F.lit(0.0), (centre - margin) / denom), F.least(F.lit(1.0), (centre + margin) / denom)


def drift(trades: DataFrame, live: Column, least: int = 20, dd_excess: float = 5.0) -> DataFrame:
    """Backtest against live rows of each strategy: win rate by its interval, mean by its z, drawdown by its excess, and a light for the number of drifts."""
    t = trades.withColumn("live", live)
    p = (F.col("pnl") > 0).cast("double")
    m = metrics(t, KEY, "live")
    g = t.groupBy(KEY).agg(
        F.count(F.when(F.col("live"), 1)).alias("n_live"), F.avg(F.when(F.col("live"), p)).alias("live_win"), F.avg(F.when(~F.col("live"), p)).alias("back_win"), F.avg(F.when(F.col("live"), F.col("pnl"))).alias("live_mean"),
        F.avg(F.when(~F.col("live"), F.col("pnl"))).alias("back_mean"), F.stddev_samp(F.when(~F.col("live"), F.col("pnl"))).alias("back_std"),
    )
    dd = m.groupBy(KEY).agg(F.max(F.when(F.col("live"), F.col("max_drawdown"))).alias("live_dd"), F.max(F.when(~F.col("live"), F.col("max_drawdown"))).alias("back_dd"))
    lo, hi = wilson(F.col("live_win"), F.col("n_live"))
    out = g.join(dd, KEY).withColumns({"ci_low": lo, "ci_high": hi, "z": F.coalesce(ratio(F.col("live_mean") - F.col("back_mean"), F.col("back_std") / F.sqrt("n_live")), F.lit(0.0)), "dd_excess": F.col("live_dd") - F.col("back_dd")})
    few = F.col("n_live") < least
    word = lambda bad: F.when(few, "insufficient_sample").when(bad, "drift_detected").otherwise("within_band")
    out = out.withColumns({"win_verdict": word((F.col("back_win") < F.col("ci_low")) | (F.col("back_win") > F.col("ci_high"))), "mean_verdict": word(F.abs("z") > 2), "dd_verdict": F.when(F.col("dd_excess") > dd_excess, "drift_detected").otherwise("within_band")})
    count = sum((F.col(c) == "drift_detected").cast("int") for c in ("win_verdict", "mean_verdict", "dd_verdict"))
    return out.withColumn("drifts", count).withColumn("light", F.when(few, "insufficient_sample").otherwise(bands(F.col("drifts"), [(">=", 2, "red"), (">=", 1, "yellow")], "green")))
