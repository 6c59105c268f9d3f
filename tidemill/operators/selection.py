"""Resampling of return series, model selection tests, walk-forward folds, parameter sensitivity and clustering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from statistics import NormalDist
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import bands, normal_cdf, normal_quantile, ratio, small
from ..session import materialise
from .scan import running

EFFICIENCY = [(">=", 0.8, "excellent"), (">=", 0.6, "good"), (">=", 0.4, "marginal"), (">=", 0.0, "overfit")]
#: Paths that one task draws of a series that it holds; longer series than SERIES_ROWS are never held.
PATHS, SERIES_ROWS = 250, 2_000_000
#: Of a long series: steps of a path that are drawn and folded at once, rows of a stored stretch, and paths that ask for a stretch together.
CHUNK, STRETCH, LOT = 65_536, 65_536, 10
#: Bins in which the median of a long path is sought first.
BINS = 256


def drawn(key: list[int], n: int, steps: int, block: float) -> Iterator[np.ndarray]:
    """Positions of a stationary bootstrap, chunk by chunk: runs of geometric length with mean ``block`` that wrap around; 1 gives independent draws.

    Two streams of numbers hang on ``key`` alone, and a run goes on over the end of a chunk, so the size of a chunk changes nothing.
    """
    fresh, starts = np.random.default_rng([*key, 0]), np.random.default_rng([*key, 1])
    at = None
    for first in range(0, steps, CHUNK):
        here = np.arange(min(CHUNK, steps - first))
        new, where = fresh.random(len(here)) < 1 / block, (starts.random(len(here)) * n).astype(np.int64)
        if at is None:
            new[0] = True
        last = np.maximum.accumulate(np.where(new, here, -1))
        places = np.where(last >= 0, where[last] + here - last, (at or 0) + 1 + here) % n
        at = int(places[-1])
        yield places


def positions(key: list[int], n: int, steps: int, block: float) -> np.ndarray:
    return np.concatenate([*drawn(key, n, steps, block), np.empty(0, np.int64)])


PATH_SCHEMA = "series_id string, path long, total double, mean double, sharpe double, median double, max_drawdown double"


def bootstrap_paths(returns: DataFrame, n_paths: int, block: float = 1.0, steps: int | None = None, seed: int = 42, value: str = "r") -> DataFrame:
    """series_id, path, total, mean, sharpe, median, max_drawdown of resampled paths.

    A path's draws depend on (seed, series, path) alone, so the result is the same for any number of partitions. A series of up to
    SERIES_ROWS rows goes to as many tasks as it has lots of PATHS paths; of a longer one the paths look their values up (``_long_paths``).
    """
    rows, long = _by_length(returns.select("series_id", "idx", F.col(value).cast("double").alias("x")))
    lots = -(-n_paths // PATHS)
    rows = rows.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))

    def draw(p: pd.DataFrame) -> pd.DataFrame:
        name, lot = p["series_id"].iloc[0], int(p["lot"].iloc[0])
        x = p.sort_values("idx", kind="stable")["x"].to_numpy()
        out = []
        for k in range(lot * PATHS, min(n_paths, (lot + 1) * PATHS)):
            y = x[positions([seed, crc32(name.encode()), k], len(x), steps or len(x), block)]
            eq = np.concatenate([[1.0], np.cumprod(1 + y)])
            peak = np.maximum.accumulate(eq)
            std = y.std(ddof=1) if len(y) > 1 else 0.0
            out.append((name, k, float(y.sum()), float(y.mean()), float(y.mean() / std) if std > 0 else 0.0, float(np.median(y)), float(((peak - eq) / peak).max() * 100)))
        return pd.DataFrame(out, columns=["series_id", "path", "total", "mean", "sharpe", "median", "max_drawdown"])

    short = rows.groupBy("series_id", "lot").applyInPandas(draw, PATH_SCHEMA)
    return short if long is None else short.unionByName(_long_paths(long, n_paths, block, steps, seed))


def _by_length(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows of series of up to SERIES_ROWS rows, and those of longer ones, numbered, if there are any."""
    long = small(materialise(rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SERIES_ROWS), "long-series"))
    if not long.head(1):
        return rows, None
    numbered = running(rows.join(long, "series_id"), ["series_id"], "idx", STRETCH, place=("count", F.lit(1)))
    return rows.join(long, "series_id", "left_anti"), materialise(numbered.withColumn("place", F.col("place") - 1), "numbered")


def _looked_up(long: DataFrame, n_paths: int, block: float, steps: int | None, key, answer, schema: str) -> DataFrame:
    """``answer`` for each stretch of a long series and lot of paths that ask for it.

    The series lies in stretches of STRETCH values, a row each. Tasks draw the places of the paths chunk by chunk and send them, in one row a
    stretch, to where the stretch is; a stretch is sent once to each LOT of paths. So no task holds a series, a path, or more than a lot's steps of a stretch.
    """
    at = F.floor(F.col("place") / STRETCH).cast("int")
    kept = long.groupBy("series_id", at.alias("stretch")).agg(F.array_sort(F.collect_list(F.struct("place", "x"))).alias("v"))  # STRETCH values a row
    lots = -(-n_paths // LOT)
    kept = materialise(kept.select("series_id", "stretch", F.transform("v", lambda v: v["x"]).alias("x")), "stretches")
    asks = long.groupBy("series_id").agg(F.max("n").alias("n")).withColumn("path", F.explode(F.sequence(F.lit(0), F.lit(n_paths - 1)))).repartition("series_id", "path")

    def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for name, n, path in zip(p["series_id"], p["n"], p["path"]):
                for chunk, places in enumerate(drawn(key(name, int(path)), int(n), int(steps or n), block)):
                    to = places // STRETCH
                    order = np.argsort(to, kind="stable")
                    cuts = np.flatnonzero(np.diff(to[order])) + 1
                    steps_of, places_of = np.split(order, cuts), np.split(places[order] % STRETCH, cuts)
                    yield pd.DataFrame({"series_id": name, "path": path, "chunk": chunk, "lot": int(path) // LOT, "stretch": [int(to[o[0]]) for o in steps_of], "step": steps_of, "at": places_of})

    asked = materialise(asks.mapInPandas(ask, "series_id string, path long, chunk int, lot int, stretch int, step array<int>, at array<int>"), "asked")
    by, sent = ["series_id", "stretch", "lot"], kept.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
    return asked.groupBy(*by).cogroup(sent.groupBy(*by)).applyInPandas(lambda q, x: answer(q, np.asarray(x["x"].iloc[0]) if len(x) else np.empty(0)), schema)


def _long_paths(long: DataFrame, n_paths: int, block: float, steps: int | None, seed: int) -> DataFrame:
    """``bootstrap_paths`` of series that no task can hold: the values of each chunk of a path come together, are summarised, and folded again from what the chunks before carry."""
    values = _looked_up(
        long, n_paths, block, steps, lambda name, k: [seed, crc32(name.encode()), k], lambda q, x: q[["series_id", "path", "chunk", "step"]].assign(y=[x[np.asarray(a)] for a in q["at"]]),
        "series_id string, path long, chunk int, step array<int>, y array<double>",
    )

    def whole(p: pd.DataFrame) -> pd.DataFrame:
        step = np.concatenate(p["step"].to_list())
        return p[["series_id", "path", "chunk"]].head(1).assign(y=[np.concatenate(p["y"].to_list())[np.argsort(step, kind="stable")]])

    chunk = ["series_id", "path", "chunk"]
    chunks = materialise(values.groupBy(*chunk).applyInPandas(whole, "series_id string, path long, chunk int, y array<double>"), "path-chunks")  # CHUNK values a row
    edges = long.groupBy("series_id").agg(F.percentile_approx("x", F.array(*(F.lit(k / BINS) for k in range(1, BINS))), F.lit(100 * BINS)).alias("edges"))
    edges = small(materialise(edges, "edges"))

    def summary(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for y, e in zip(p["y"], p["edges"]):
                grown, bins = np.cumprod(1 + y), np.bincount(np.searchsorted(np.unique(e), y, "right"), minlength=BINS)
                out.append((len(y), float(y.sum()), float(((y - y.mean()) ** 2).sum()), float(grown[-1]), float(grown.max()), float(grown.min()), bins.tolist()))
            yield pd.concat([p[chunk].reset_index(drop=True), pd.DataFrame(out, columns=["n", "s", "m2", "growth", "high", "low", "bins"])], axis=1)

    summed = chunks.join(edges, "series_id").mapInPandas(summary, "series_id string, path long, chunk int, n long, s double, m2 double, growth double, high double, low double, bins array<long>")
    summed = materialise(summed, "chunk-summaries")
    path = ["series_id", "path"]
    moments = summed.groupBy(*path).agg(F.sum("n").alias("n"), F.sum("s").alias("total"))
    spread = summed.join(moments.withColumnRenamed("n", "_n"), path).groupBy(*path).agg(F.sum(F.col("m2") + F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("total") / F.col("_n"), F.lit(2.0))).alias("m2"))

    order = Window.partitionBy(*path).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row a chunk
    start = summed.withColumn("start", F.coalesce(F.product("growth").over(order), F.lit(1.0)))
    start = start.withColumn("peak", F.greatest(F.lit(1.0), F.max(F.greatest(F.col("start") * F.col("high"), F.col("start") * F.col("low"))).over(order)))
    total = F.sum("c").over(Window.partitionBy(*path).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    counts = summed.select(*path, F.posexplode("bins").alias("bin", "c")).groupBy(*path, "bin").agg(F.sum("c").alias("c")).filter("c > 0").withColumn("below", F.coalesce(total, F.lit(0))).join(moments.select(*path, "n"), path)
    holds = lambda rank: (F.col("below") <= rank) & (rank < F.col("below") + F.col("c"))
    first, second = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    wanted = materialise(counts.filter(holds(first) | holds(second)).groupBy(*path).agg(F.min("bin").alias("bin"), F.max("bin").alias("to_bin"), F.min("below").alias("below"), F.first("n").alias("n")), "median-bins")
    asked = chunks.join(start.select(*chunk, "start", "peak"), chunk).join(edges, "series_id").join(wanted, path)

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of each chunk the deepest fall, and the values (with counts) in the bins that hold the median."""
        for p in parts:
            out = []
            for y, e, start, peak, low, high in zip(p["y"], p["edges"], p["start"], p["peak"], p["bin"], p["to_bin"]):
                eq = start * np.cumprod(1 + y)
                top = np.maximum(np.maximum.accumulate(eq), peak)
                bins = np.searchsorted(np.unique(e), y, "right")
                v, c = np.unique(y[(bins >= low) & (bins <= high)], return_counts=True)
                out.append((float(((top - eq) / top).max() * 100), [{"v": a, "c": b} for a, b in zip(v.tolist(), c.tolist())]))
            yield pd.concat([p[path].reset_index(drop=True), pd.DataFrame(out, columns=["fall", "near"])], axis=1)

    folded = materialise(asked.mapInPandas(fold, "series_id string, path long, fall double, near array<struct<v:double,c:long>>"), "chunk-folds")
    falls = folded.groupBy(*path).agg(F.greatest(F.max("fall"), F.lit(0.0)).alias("max_drawdown"))
    near = folded.select(*path, F.inline("near")).groupBy(*path, "v").agg(F.sum("c").alias("c")).join(wanted.select(*path, "below", "n"), path)
    upto = F.sum("c").over(Window.partitionBy(*path).orderBy("v").rowsBetween(Window.unboundedPreceding, -1))
    near = near.withColumn("below", F.col("below") + F.coalesce(upto, F.lit(0)))
    medians = near.groupBy(*path).agg(((F.max(F.when(holds(first), F.col("v"))) + F.max(F.when(holds(second), F.col("v")))) / 2).alias("median"))
    out = moments.join(spread, path).join(falls, path).join(medians, path)
    std = F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0)))
    mean = F.col("total") / F.col("n")
    return out.select(*path, "total", mean.alias("mean"), F.when(std > 0, mean / std).otherwise(0.0).alias("sharpe"), "median", "max_drawdown")


def percentiles(paths: DataFrame, statistic: str, at: list[float]) -> DataFrame:
    q = F.percentile(statistic, F.array(*(F.lit(a) for a in at)))
    out = paths.groupBy("series_id").agg(q.alias("_q"), F.avg(statistic).alias("mean"), F.stddev_samp(statistic).alias("std"), F.count(F.lit(1)).alias("n_paths"))
    return out.select("series_id", "mean", "std", "n_paths", *(F.col("_q")[k].alias(f"p{round(a * 100)}") for k, a in enumerate(at)))


def bootstrap_means(excess: DataFrame, n_boot: int, block: float = 5.0, seed: int = 42) -> DataFrame:
    """series_id, boot, mean: each boot draws one set of places for all series, which keeps their dependence.

    The draws of (seed, boot) are made beside each series, so series need not meet in a task; of series over SERIES_ROWS only sums of looked up values travel.
    """
    rows, long = _by_length(excess.select("series_id", "idx", "x"))
    lots = -(-n_boot // PATHS)
    rows = rows.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))

    def draw(p: pd.DataFrame) -> pd.DataFrame:
        lot = int(p["lot"].iloc[0])
        x = p.sort_values("idx", kind="stable")["x"].to_numpy()
        boots = range(lot * PATHS, min(n_boot, (lot + 1) * PATHS))
        means = [float(x[positions([seed, b], len(x), len(x), block)].mean()) for b in boots]
        return pd.DataFrame({"series_id": p["series_id"].iloc[0], "boot": list(boots), "mean": means})

    short = rows.groupBy("series_id", "lot").applyInPandas(draw, "series_id string, boot long, mean double")
    if long is None:
        return short
    sums = _looked_up(
        long, n_boot, block, None, lambda _, k: [seed, k], lambda q, x: q[["series_id", "path"]].assign(s=[float(x[np.asarray(a)].sum()) for a in q["at"]], n=[len(a) for a in q["at"]]), "series_id string, path long, s double, n long"
    )
    return short.unionByName(sums.groupBy("series_id", F.col("path").alias("boot")).agg((F.sum("s") / F.sum("n")).alias("mean")))


def aligned_excess(returns: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Returns over the benchmark at the places that every series has; ``idx`` counts them from 0."""
    x = returns.join(benchmark.select("idx", F.col("r").alias("b")), "idx").select("series_id", "idx", (F.col("r") - F.col("b")).alias("x"))
    n = x.select(F.count_distinct("series_id").alias("n"))
    full = x.groupBy("idx").agg(F.count(F.lit(1)).alias("c")).crossJoin(F.broadcast(n)).filter("c = n").select("idx")  # n is one row
    x = x.join(full, "idx")
    return running(x, ["series_id"], "idx", _place=("count", F.lit(1))).withColumn("idx", F.col("_place") - 1).drop("_place")


def reality_check(excess: DataFrame, n_boot: int, block: float = 5.0, seed: int = 42, studentised: bool = False) -> DataFrame:
    """One row: observed maximum, p, best series. p is the share of boots whose largest centred mean reaches the observed one."""
    obs = excess.groupBy("series_id").agg(F.avg("x").alias("m"), F.greatest(F.stddev_samp("x"), F.lit(1e-15)).alias("s"), F.count(F.lit(1)).alias("n"))
    scale = F.sqrt("n") / F.col("s") if studentised else F.lit(1.0)
    boots = bootstrap_means(excess, n_boot, block, seed).join(obs, "series_id")
    top = boots.groupBy("boot").agg(F.max((F.col("mean") - F.col("m")) * scale).alias("v"))
    best = obs.agg(F.max(F.col("m") * scale).alias("observed"), F.max_by("series_id", F.col("m") * scale).alias("best"), F.count(F.lit(1)).alias("n_series"))
    out = top.crossJoin(F.broadcast(best)).groupBy("observed", "best", "n_series").agg(F.avg((F.col("v") >= F.col("observed")).cast("double")).alias("p"))  # best is one row
    return out.withColumn("verdict", bands(F.col("p"), [("<", 0.05, "significant"), ("<", 0.1, "marginal")], "not_significant"))


def win_shares(excess: DataFrame, n_boot: int, block: float = 5.0, seed: int = 42) -> DataFrame:
    wins = bootstrap_means(excess, n_boot, block, seed).groupBy("boot").agg(F.max_by("series_id", "mean").alias("series_id"))
    return wins.groupBy("series_id").agg((F.count(F.lit(1)) / n_boot * 100).alias("win_share_pct"))


def cpcv_roles(rows: DataFrame, groups: int, test_groups: int, embargo_pct: float = 0.01) -> DataFrame:
    """A row a row and split: split, role (test, embargo or train). Groups are contiguous, the first ones take the remainder; every combination of test groups is a split."""
    n, i = F.count(F.lit(1)).over(Window.partitionBy("series_id")), F.row_number().over(Window.partitionBy("series_id").orderBy("idx")) - 1
    base = rows.withColumns({"_n": n, "_i": i})
    size, extra = F.floor(F.col("_n") / groups), F.col("_n") % groups
    start = lambda g: g * size + F.least(g, extra)
    embargo = F.floor(F.lit(embargo_pct) * F.col("_n"))
    splits = F.array(*(F.struct(F.lit(k).alias("split"), F.array(*map(F.lit, c)).alias("test")) for k, c in enumerate(combinations(range(groups), test_groups))))
    out = base.select("series_id", "idx", "_n", "_i", F.inline(splits))
    inside = F.exists("test", lambda g: (F.col("_i") >= start(g)) & (F.col("_i") < start(g + 1)))
    after = F.exists("test", lambda g: (F.col("_i") >= start(g + 1)) & (F.col("_i") < start(g + 1) + embargo))
    return out.select("series_id", "idx", "split", F.when(inside, "test").when(after, "embargo").otherwise("train").alias("role"))


def expected_max_sharpe(trials: Column) -> Column:
    """Expected largest of so many standard normals, by quantiles of the trials' number (for result rows)."""

    @F.pandas_udf("double")
    def value(n: pd.Series) -> pd.Series:
        q, g = NormalDist().inv_cdf, 0.5772156649015329
        return n.map(lambda k: (1 - g) * q(1 - 1 / max(2, k)) + g * q(1 - 1 / (max(2, k) * np.e))).astype("float64")

    return value(trials.cast("double"))


def deflated_sharpe(rows: DataFrame, benchmark: float = 0.0) -> DataFrame:
    """Needs sharpe, n, trials, skewness, kurtosis (3 for a normal). Null under ten rows."""
    s = F.col("sharpe")
    var = (1 - F.col("skewness") * s + (F.col("kurtosis") - 1) / 4 * s * s) / (F.col("n") - 1)
    out = rows.withColumn("sr0", expected_max_sharpe(F.col("trials"))).withColumn("z", F.when((F.col("n") >= 10) & (var > 0), (s - benchmark - F.col("sr0")) / F.sqrt(var)))
    out = out.withColumn("dsr", normal_cdf("z"))
    return out.withColumn("verdict", bands(F.col("dsr"), [(">", 0.95, "very_robust"), (">", 0.8, "robust"), (">", 0.6, "borderline")], "likely_overfit"))


def haircut(sharpe: Column, trials: Column, n: Column) -> Column:
    return sharpe - F.sqrt(F.ln(F.greatest(trials, F.lit(1))) / n)


def least_track_record(sharpe: Column, skew: Column, kurt: Column, confidence: float = 0.95, benchmark: float = 0.0) -> Column:
    var = 1 - skew * sharpe + (kurt - 1) / 4 * sharpe * sharpe
    return F.when((sharpe > benchmark) & (var > 0), F.ceil(1 + var * F.pow(normal_quantile(confidence) / (sharpe - benchmark), F.lit(2.0))))


def pbo(folds: DataFrame, key: str) -> DataFrame:
    """Whether the row best in sample is below the upper median out of sample, per key; null under four rows."""
    rn, n = F.row_number().over(Window.partitionBy(key).orderBy("oos_metric")) - 1, F.count(F.lit(1)).over(Window.partitionBy(key))
    r = folds.withColumns({"_i": rn, "_n": n})
    g = r.groupBy(key).agg(F.max(F.when(F.col("_i") == F.floor(F.col("_n") / 2), F.col("oos_metric"))).alias("median"), F.max_by("oos_metric", F.struct("is_metric", "strategy_id")).alias("top"), F.max("_n").alias("n"))
    return g.withColumn("overfit", F.when(F.col("n") >= 4, F.col("top") < F.col("median")))


def fold_summary(folds: DataFrame, *keys: str) -> DataFrame:
    x, y = F.col("is_metric"), F.col("oos_metric")
    g = folds.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("is_mean"), F.stddev_samp(x).alias("is_std"), F.avg(y).alias("oos_mean"), F.stddev_samp(y).alias("oos_std"), F.min(y).alias("oos_min"), F.max(y).alias("oos_max"), F.avg((y > 0).cast("double")).alias("positive")
    )
    return g.withColumn("efficiency", F.when(F.col("is_mean") > 0, F.col("oos_mean") / F.col("is_mean")))


def databank_folds(strategies: DataFrame, metric: str) -> DataFrame:
    """Fold summary by project and databank, a strategy being a fold of ``<metric>_is`` and ``<metric>_oos``; two folds at least."""
    x, y = F.col(f"{metric}_is"), F.col(f"{metric}_oos")
    folds = strategies.filter(x.isNotNull() & y.isNotNull()).select("project", "databank", x.alias("is_metric"), y.alias("oos_metric"))
    return fold_summary(folds, "project", "databank").filter("n >= 2")


def consistency(summary: DataFrame) -> DataFrame:
    """0 to 100: up to 40 for mean over deviation (5 without deviation), 30 for positive folds, 30 for efficiency; 0 without a positive mean."""
    m, zero = F.col("oos_mean"), F.lit(0.0)
    noise = F.when(F.col("oos_std") > 0, m / F.col("oos_std")).otherwise(5.0)
    score = F.least(F.lit(40.0), F.greatest(zero, noise * 10)) + F.col("positive") * 30 + F.when(F.col("is_mean") > 0, F.greatest(zero, F.least(F.lit(1.0), m / F.col("is_mean"))) * 30).otherwise(0.0)
    return summary.withColumn("score", F.when(m > 0, score).otherwise(0.0)).withColumn("verdict", bands(F.col("score"), [(">=", 70, "robust"), (">=", 40, "borderline")], "weak"))


def neighbours(points: DataFrame, at: float) -> DataFrame:
    """Per param the nearest points on either side of ``at`` (the outermost ones where a side is empty), the metric interpolated there and the slope between."""
    p = F.struct("value", "metric")
    x = F.col("value")
    g = points.groupBy("param").agg(F.max(F.when(x < at, p)).alias("l"), F.min(F.when(x > at, p)).alias("r"), F.min(p).alias("a"), F.max(p).alias("z"), F.max(F.when(x == at, F.col("metric"))).alias("same"))
    inner = F.col("l").isNotNull() & F.col("r").isNotNull()
    g = g.withColumns({"left": F.when(inner, F.col("l")).otherwise(F.col("a")), "right": F.when(inner, F.col("r")).otherwise(F.col("z"))})
    dx = F.col("right.value") - F.col("left.value")
    slope = ratio(F.col("right.metric") - F.col("left.metric"), dx)
    base = F.when(F.lit(at) <= F.col("a.value"), F.col("a.metric")).when(F.lit(at) >= F.col("z.value"), F.col("z.metric")).otherwise(F.coalesce("same", F.col("left.metric") + (at - F.col("left.value")) * slope))
    return g.select("param", F.col("left.value").alias("left_value"), F.col("right.value").alias("right_value"), slope.alias("slope"), base.alias("baseline"))


def plateau(points: DataFrame) -> DataFrame:
    g = points.groupBy("param").agg(F.avg("metric").alias("mean"), F.coalesce(F.stddev_samp("metric"), F.lit(0.0)).alias("std"))
    score = F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100 * (1 - F.col("std") / F.abs("mean"))))
    return g.withColumn("score", F.when(F.abs("mean") < 1e-9, 0.0).otherwise(score)).withColumn("verdict", bands(F.col("score"), [(">=", 75, "robust"), (">=", 50, "borderline")], "fragile"))


def range_decay(points: DataFrame, at: float, tolerance_pct: float) -> DataFrame:
    base = neighbours(points, at).select("param", "baseline", (F.col("baseline") * (1 - tolerance_pct / 100)).alias("floor"))
    p = points.join(base, "param")
    bad = F.col("metric") < F.col("floor")
    g = p.groupBy("param", "baseline", "floor").agg(F.max(F.when(bad & (F.col("value") < at), F.col("value"))).alias("left_break"), F.min(F.when(bad & (F.col("value") > at), F.col("value"))).alias("right_break"))
    l, r = F.col("left_break").isNull(), F.col("right_break").isNull()
    return g.withColumn("verdict", F.when(l & r, "wide_plateau").when(~l & ~r, "narrow_plateau").otherwise("asymmetric_decay"))


def bullseye(points: DataFrame, tolerance_pct: float) -> DataFrame:
    best = points.groupBy("param").agg(F.max("metric").alias("best"), F.min_by("value", F.struct(-F.col("metric"), "value")).alias("best_value"))
    near = points.join(best, "param").filter(F.col("metric") >= F.col("best") * (1 - tolerance_pct / 100))
    g = near.groupBy("param", "best", "best_value").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    return g.withColumn("verdict", bands(F.col("n"), [(">=", 3, "wide"), (">=", 2, "narrow")], "single_point"))


def parameter_grid(base: DataFrame, pct: float, steps: int) -> DataFrame:
    """All combinations of each parameter's values from -pct to +pct, per owner; ``base`` has owner, a, b. Steps are a parameter, so a row gives steps squared."""
    factors = F.array(*(F.lit(1 - pct / 100 + 2 * pct / 100 * k / max(1, steps - 1)) if steps > 1 else F.lit(1.0) for k in range(steps)))
    out = base.withColumn("fa", F.explode(factors)).withColumn("fb", F.explode(factors))
    return out.select("owner", (F.col("a") * F.col("fa")).alias("a"), (F.col("b") * F.col("fb")).alias("b"))


def distribution(rows: DataFrame, key: str, value: str) -> DataFrame:
    q = F.percentile(value, F.array(*(F.lit(a) for a in (0.05, 0.25, 0.5, 0.75, 0.95))))
    g = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), q.alias("_q"), F.avg((F.col(value) > 0).cast("double")).alias("profitable"))
    g = g.withColumns({f"p{a}": F.col("_q")[k] for k, a in enumerate((5, 25, 50, 75, 95))}).withColumn("cv", ratio(F.col("std"), F.abs("mean"))).drop("_q")
    cv = F.col("cv")
    return g.withColumn("verdict", F.when((F.col("profitable") >= 0.95) & (cv.isNull() | (cv < 0.3)), "very_robust").when((F.col("profitable") >= 0.8) & (cv.isNull() | (cv < 0.5)), "robust").when(F.col("profitable") >= 0.5, "moderately_fragile").otherwise("fragile"))


def standardised(rows: DataFrame, metrics: list[str], key: str) -> DataFrame:
    """key and ``z``, the metrics less their mean over the population deviation (0 without one); rows with a missing metric are left out."""
    known = rows.select(key, *(F.col(m).cast("double").alias(m) for m in metrics)).dropna()
    stats = known.agg(*(f(m).alias(f"_{n}_{m}") for m in metrics for n, f in (("m", F.avg), ("s", F.stddev_pop))))
    z = F.array(*(F.when(F.col(f"_s_{m}") > 0, (F.col(m) - F.col(f"_m_{m}")) / F.col(f"_s_{m}")).otherwise(0.0) for m in metrics))
    return known.crossJoin(F.broadcast(stats)).select(key, z.alias("z"))  # stats is one row


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def kmeans(points: DataFrame, k: int, rounds: int, key: str) -> DataFrame:
    """Lloyd's rounds from the k rows with the smallest keys; k centres travel with the plan. Adds cluster. The points are stored, as each round reads them."""
    points = materialise(points, "points")
    centres = [r["z"] for r in points.orderBy(key).limit(k).collect()]  # k rows
    dims = len(centres[0]) if centres else 0
    assigned = points.withColumn("cluster", F.lit(0))
    for _ in range(rounds):
        d = F.array(*(F.struct(distance(F.col("z"), F.array(*map(F.lit, c))).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)))
        assigned = points.withColumn("cluster", F.array_min(d)["i"])
        found = {r["cluster"]: r["m"] for r in assigned.groupBy("cluster").agg(F.array(*(F.avg(F.col("z")[j]) for j in range(dims))).alias("m")).collect()}
        moved = [found.get(i, c) for i, c in enumerate(centres)]
        if all(abs(a - b) < 1e-12 for x, y in zip(moved, centres) for a, b in zip(x, y)):
            break
        centres = moved
    return assigned
