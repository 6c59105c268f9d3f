"""Strategy catalogues: derived metrics, filters, ranks, findings, gates, alerts, sets and portfolios."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import bands, hhi, ratio, small

ID = "strategy_id"
# Caps and least ratios by risk profile, and severities in order.
PROFILES = [("conservative", 5.0, 0.5), ("moderate", 10.0, 0.4), ("aggressive", 20.0, 0.3), ("prop", 3.0, 0.6)]
SEVERITIES = ["critical", "high", "medium", "low", "info"]


def derive(s: DataFrame) -> DataFrame:
    """Adds the ratios that other operators read; null where undefined."""
    return s.withColumns({
        "oos_is": ratio(F.col("fitness_oos"), F.col("fitness_is")), "profit_to_dd": ratio(F.col("net_profit"), F.col("drawdown_abs")), "avg_trade": ratio(F.col("net_profit"), F.col("trades")),
        "years": F.col("history_days") / 365.25, "trades_per_year": ratio(F.col("trades"), F.col("history_days") / 365.25),
    })


def rejections(s: DataFrame, limits: list[tuple[str, str, float]]) -> DataFrame:
    """Adds ``reason``, the first limit (column, ``min`` or ``max``, value) that a row fails, null if none. A null value fails, but for max trades."""
    reason = F.lit(None).cast("string")
    for column, kind, value in reversed(limits):
        x = F.col(column)
        bad = x < value if kind == "min" else x > value
        bad = F.coalesce(bad, F.lit(False)) if (column, kind) == ("trades", "max") else F.coalesce(bad, F.lit(True))
        reason = F.when(bad, f"{column}_{kind}").otherwise(reason)
    return s.withColumn("reason", reason)


def defensive_score(s: DataFrame) -> Column:
    """Best fitness that is there and not zero (out of sample, all, in sample), cut for overfit, deep drawdown and few trades."""
    base = F.coalesce(*(F.nullif(F.col(c), F.lit(0.0)) for c in ("fitness_oos", "fitness_full")), F.col("fitness_is"))
    fit = F.coalesce(F.greatest(F.lit(0.1), F.least(F.lit(1.0), F.col("oos_is") * 2)), F.lit(1.0))
    deep = F.when(F.col("drawdown_pct") > 25, 25 / F.col("drawdown_pct")).otherwise(1.0)
    thin = F.when(F.col("trades") < 100, F.greatest(F.lit(0.1), F.col("trades") / 100)).otherwise(1.0)
    return base * fit * deep * thin


def ranked(s: DataFrame, score: Column, *keys: str) -> DataFrame:
    """Adds ``score`` and ``place`` within ``keys``, best first, missing scores last, ties by id."""
    out = s.withColumn("score", score)
    return out.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last("score"), ID)))


def diverse(s: DataFrame, bucket: Column, n: int) -> DataFrame:
    """Round-robin over buckets, the strongest first: everyone's best, then everyone's second, until n. Rows without a key are one bucket."""
    b = s.withColumn("bucket", F.coalesce(bucket, F.lit("__no_key__")))
    b = b.withColumn("round", F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc_nulls_last("score"), ID)))
    tops = b.groupBy("bucket").agg(F.max("score").alias("_top"))
    return b.join(tops, "bucket").orderBy("round", F.desc_nulls_last("_top"), "bucket").limit(n).drop("_top")


def findings(s: DataFrame) -> DataFrame:
    """A row a finding: strategy_id, code, severity."""
    c = F.col
    rules = [
        (c("trades") < 30, "FEW_TRADES", "high"), (c("fitness_oos").isNull() | (c("fitness_oos") == 0), "NO_OOS", "high"), (c("oos_is") < 0.5, "OVERFIT", "high"), (c("profit_to_dd") > 20, "TOO_GOOD", "critical"),
        (c("drawdown_pct") > 50, "DEEP_DRAWDOWN", "critical"), (c("years") < 1, "SHORT_HISTORY", "medium"), (c("drawdown_abs") < 0.01, "NO_DRAWDOWN", "critical"), (c("trades_per_year") > 5000, "TOO_FREQUENT", "medium"), (c("net_profit") <= 0, "UNPROFITABLE", "low"),
    ]
    rows = F.array(*(F.when(cond, F.struct(F.lit(code).alias("code"), F.lit(sev).alias("severity"))) for cond, code, sev in rules))
    return s.select(ID, F.inline(F.filter(rows, lambda x: x.isNotNull())))


def with_counts(s: DataFrame) -> DataFrame:
    """Adds the numbers of critical and high findings of each strategy."""
    n = lambda sev: F.count(F.when(F.col("severity") == sev, 1)).alias(sev)
    return s.join(findings(s).groupBy(ID).agg(n("critical"), n("high"), F.count(F.lit(1)).alias("findings")), ID, "left").fillna(0, ["critical", "high", "findings"])


def quality(s: DataFrame) -> Column:
    """0 to 100; a missing metric earns nothing. Needs the counts of findings."""
    zero = F.lit(0.0)
    part = lambda x, most: F.coalesce(F.least(F.lit(most), F.greatest(zero, x)), zero)
    raw = part(F.col("fitness_oos") * 30, 30.0) + part(F.col("oos_is") / 0.5 * 25, 25.0) + part(20 * (1 - F.col("drawdown_pct") / 50), 20.0) + part(F.col("trades") / 200 * 15, 15.0) + part(F.col("years") / 3 * 10, 10.0)
    return F.greatest(zero, F.least(F.lit(100.0), raw - 10 * F.col("critical") - 5 * F.col("high")))


def action(s: DataFrame) -> Column:
    oos, dd, n, r = (F.col(c) for c in ("fitness_oos", "drawdown_pct", "trades", "oos_is"))
    return (
        F.when((F.col("critical") > 0) | F.coalesce(oos <= 0, F.lit(False)), "DROP").when((F.col("high") > 0) | F.coalesce(r < 0.4, F.lit(False)), "TWEAK")
        .when(F.coalesce(n < 100, F.lit(False)) | F.coalesce(dd > 25, F.lit(False)), "RETEST").when(F.coalesce((oos > 0.3) & (r >= 0.5), F.lit(False)), "SHIP").otherwise("RETEST")
    )


def gates(s: DataFrame, cap: float, least_oos: float) -> DataFrame:
    """A row a gate: name, required, passed. Missing evidence fails a required gate."""
    no = F.lit(False)
    rows = [("min_trades", True, F.col("trades") >= 100), ("oos_evidence", True, F.col("oos_is") >= least_oos), ("drawdown_cap", True, F.col("drawdown_pct") <= cap), ("profit", False, F.col("net_profit") > 0), ("audit_clean", True, F.col("critical") == 0)]
    return s.select(ID, F.inline(F.array(*(F.struct(F.lit(n).alias("gate"), F.lit(r).alias("required"), F.coalesce(p, no).alias("passed")) for n, r, p in rows))))


def promotion(s: DataFrame, cap: float, least_oos: float) -> DataFrame:
    g = gates(s, cap, least_oos)
    failed = F.count(F.when(F.col("required") & ~F.col("passed"), 1))
    return g.groupBy(ID).agg(F.count(F.when(F.col("passed"), 1)).alias("passed"), failed.alias("required_failures"), F.count(F.when(~F.col("required") & ~F.col("passed"), 1)).alias("soft_failures")).withColumn("approved", F.col("required_failures") == 0)


def evaluate_rules(payload: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules (name, metric, op, threshold, severity) against payload rows (id, metric, value text); a rule fires on its metric's value, ``missing`` on its absence.

    Numbers that cannot be read compare false. ``rules`` goes to every task if a count finds it small.
    """
    ids = payload.select("id").distinct()
    every = ids.crossJoin(small(rules)).join(payload, ["id", "metric"], "left")  # ids x rules, the size of the result
    v, t = F.expr("try_cast(value as double)"), F.expr("try_cast(threshold as double)")
    listed = F.array_contains(F.split("threshold", ","), F.col("value"))
    hit = (
        F.when(F.col("op") == "missing", F.col("value").isNull()).when(F.col("value").isNull(), False).when(F.col("op") == "==", F.col("value") == F.col("threshold")).when(F.col("op") == "!=", F.col("value") != F.col("threshold"))
        .when(F.col("op") == ">", v > t).when(F.col("op") == ">=", v >= t).when(F.col("op") == "<", v < t).when(F.col("op") == "<=", v <= t).when(F.col("op") == "in", listed).when(F.col("op") == "not_in", ~listed).when(F.col("op") == "contains", F.contains("value", "threshold"))
    )
    return every.select("id", "name", "severity", F.coalesce(hit, F.lit(False)).alias("fired"))


def dedupe(s: DataFrame, key: str, best: Column) -> DataFrame:
    """One row a key, the best, ties by id; rows without a key stay."""
    rn = F.row_number().over(Window.partitionBy(key).orderBy(best, ID))
    return s.withColumn("_i", rn).filter((F.col("_i") == 1) | F.col(key).isNull()).drop("_i")


def merged(sources: list[DataFrame], destination: DataFrame, key: str = "trades_hash") -> DataFrame:
    """Union of the sources: of a key the first source's row (lowest id); keys of the destination are left out; rows without a key stay."""
    rows = reduce(DataFrame.unionByName, (s.withColumn("source", F.lit(k)) for k, s in enumerate(sources)))
    kept = dedupe(rows, key, F.asc("source"))
    return kept.join(destination.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def regression(current: DataFrame, snapshot: DataFrame, key: str, metric: str, threshold: float = 0.1) -> DataFrame:
    """improved, regressed, stable, missing or new for every key of either side; of repeated keys the last id counts."""
    last = lambda s, name: s.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(metric, ID).alias(name), F.lit(True).alias(f"_{name}"))
    j = last(current, "cur").join(last(snapshot, "prev"), key, "full_outer")
    change = F.when(F.col("prev") == 0, F.when(F.col("cur") == 0, 0.0).otherwise(F.signum("cur"))).otherwise((F.col("cur") - F.col("prev")) / F.abs("prev"))
    state = F.when(F.col("_cur").isNull(), "missing").when(F.col("_prev").isNull(), "new").when(F.col("change") > threshold, "improved").when(F.col("change") < -threshold, "regressed").otherwise("stable")
    return j.withColumn("change", change).withColumn("state", state).select(key, "cur", "prev", "change", "state")


def concentration(s: DataFrame, dims: list[str]) -> DataFrame:
    """Herfindahl index of the counts by each dimension; rows without a value are one bucket."""
    long = s.select(F.inline(F.array(*(F.struct(F.lit(d).alias("dim"), F.coalesce(F.col(d).cast("string"), F.lit("__missing__")).alias("key")) for d in dims))))
    g = long.groupBy("dim", "key").agg(F.count(F.lit(1)).alias("c"))
    g = g.withColumn("share", F.col("c") / F.sum("c").over(Window.partitionBy("dim")))
    raw, scaled = hhi("share", F.count(F.lit(1)))
    return g.groupBy("dim").agg(F.count(F.lit(1)).alias("keys"), raw.alias("hhi"), scaled.alias("hhi_scaled"))


def covariances(returns: DataFrame) -> DataFrame:
    """sym_a, sym_b, cov, n for every ordered pair of series of one portfolio, on the rows that both have (idx)."""
    a = returns.select("portfolio_id", "idx", F.col("series_id").alias("sym_a"), F.col("r").alias("ra"))
    b = returns.select("portfolio_id", "idx", F.col("series_id").alias("sym_b"), F.col("r").alias("rb"))
    return a.join(b, ["portfolio_id", "idx"]).groupBy("portfolio_id", "sym_a", "sym_b").agg(F.covar_samp("ra", "rb").alias("cov"), F.count(F.lit(1)).alias("n"))


def _matrix(p: pd.DataFrame) -> tuple[list[str], np.ndarray]:
    m = p.pivot(index="sym_a", columns="sym_b", values="cov").sort_index().sort_index(axis=1)
    return list(m.index), m.to_numpy()


def solved_weights(cov: DataFrame, kind: str, rounds: int = 2000, tol: float = 1e-12) -> DataFrame:
    """Long-only weights by portfolio: ``risk_parity`` makes w_i (C w)_i equal, ``min_variance`` minimises w'Cw. Spark builds the covariances; only the matrix of one portfolio's members is solved in a task."""

    def solve(p: pd.DataFrame) -> pd.DataFrame:
        names, c = _matrix(p)
        w = np.full(len(names), 1 / len(names))
        for _ in range(rounds):
            if kind == "risk_parity":  # coordinate descent on w'Cw / 2 - mean(ln w), whose minimum has equal w_i (C w)_i
                new = w.copy()
                for i in range(len(new)):
                    rest = c[i] @ new - c[i, i] * new[i]
                    new[i] = (-rest + np.sqrt(rest * rest + 4 * c[i, i] / len(new))) / (2 * c[i, i])
            else:
                free = w - c @ w / np.linalg.norm(c, 2)  # a gradient step, then the nearest point of the simplex
                high = np.sort(free)[::-1]
                cut = (np.cumsum(high) - 1) / np.arange(1, len(high) + 1)
                new = np.maximum(free - cut[high > cut][-1], 0)
            done = np.abs(new - w).max() < tol
            w = new
            if done:
                break
        w = w / w.sum()
        return pd.DataFrame({"portfolio_id": p["portfolio_id"].iloc[0], "series_id": names, "w": w, "variance": float(w @ c @ w)})

    return cov.select("portfolio_id", "sym_a", "sym_b", "cov").groupBy("portfolio_id").applyInPandas(solve, "portfolio_id string, series_id string, w double, variance double")


def registry_lookup(registry: DataFrame, symbol: str | None = None, timeframe: str | None = None) -> DataFrame:
    """Rows whose symbol, alias or instrument is ``symbol`` and whose timeframe is ``timeframe`` (None: any); ``date_to`` from epoch milliseconds to ISO text."""
    if symbol is not None:
        registry = registry.filter(F.lit(symbol).isin(F.col("symbol"), F.col("alias"), F.col("instrument")))
    if timeframe is not None:
        registry = registry.filter(F.col("timeframe") == timeframe)
    return registry.withColumn("date_to", F.date_format(F.timestamp_millis("date_to"), "yyyy-MM-dd'T'HH:mm:ss"))


def registry_query(table: DataFrame, column: str | None, value: str | None, order: str, limit: int = 50) -> DataFrame:
    """The first ``limit`` rows by ``order`` whose ``column`` holds ``value`` in any case (None: all rows), with ``total``, the number of all such rows."""
    if column is not None and value is not None:
        if column not in table.columns:
            raise ValueError(f"no column {column!r}; there are {', '.join(sorted(table.columns))}")
        table = table.filter(F.contains(F.upper(F.col(column).cast("string")), F.lit(value.upper())))
    total = table.agg(F.count(F.lit(1)).alias("total"))  # one row
    return table.orderBy(order).limit(limit).join(F.broadcast(total))
