"""Gaps, freshness, order, counts and coverage of series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _steps(rows: DataFrame, order: str = "t") -> DataFrame:
    return rows.withColumn("prev", F.lag("t").over(Window.partitionBy("series_id").orderBy(order)))


def gaps(rows: DataFrame, seconds: int) -> DataFrame:
    """A row a gap: a step over 1.5 intervals. missing = whole intervals in the step, less one."""
    d = F.col("t") - F.col("prev")
    return _steps(rows).filter(d > 1.5 * seconds).select("series_id", F.col("prev").alias("gap_start"), F.col("t").alias("gap_end"), F.greatest(F.floor(d / seconds) - 1, F.lit(0)).alias("missing"))


def gap_report(rows: DataFrame, seconds: int) -> DataFrame:
    d = F.col("t") - F.col("prev")
    gap = d > 1.5 * seconds
    missing = F.sum(F.when(gap, F.greatest(F.floor(d / seconds) - 1, F.lit(0))).otherwise(0))
    out = _steps(rows).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.sum(gap.cast("long")).alias("gaps"), missing.alias("missing"), F.max(d).alias("largest_step"))
    return out.withColumn("gap_pct", 100 * F.col("missing") / (F.col("missing") + F.col("n") - 1))


def freshness(rows: DataFrame, now: Column, max_age_seconds: int) -> DataFrame:
    age = F.greatest(now - F.max("t"), F.lit(0))
    return rows.groupBy("series_id").agg(F.max("t").alias("last"), age.alias("age")).withColumn("fresh", F.col("age") <= max_age_seconds)


def not_increasing(rows: DataFrame, arrival: str, first: int = 10) -> DataFrame:
    """The ``first`` rows of each series, in order of arrival, whose time is not after the one before, and ``total``, how many such rows it has."""
    bad = _steps(rows, arrival).filter("t <= prev")
    total = bad.groupBy("series_id").agg(F.count(F.lit(1)).alias("total"))
    head = bad.withColumn("nth", F.row_number().over(Window.partitionBy("series_id").orderBy(arrival))).filter(F.col("nth") <= first)
    return head.join(total, "series_id").select("series_id", F.col(arrival).alias("arrival"), "prev", "t", "total")


def bar_counts(rows: DataFrame, seconds: int, market_hours: float = 1.0) -> DataFrame:
    """Actual against expected bars over a series' span, with a band."""
    expected = F.greatest(((F.col("end") - F.col("start")) / seconds + 1) * market_hours, F.lit(1.0))
    pct = F.col("coverage_pct")
    band = F.when(pct >= 99, "complete").when(pct >= 95, "good").when(pct >= 80, "patchy").otherwise("sparse")
    out = rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("start"), F.max("t").alias("end"))
    return out.withColumn("expected", expected).withColumn("coverage_pct", 100 * F.col("n") / F.col("expected")).withColumn("band", band)


def coverage_gaps(requested: DataFrame, available: DataFrame, keys: list[str]) -> DataFrame:
    """Requests without data, or that begin before or end after it. Both sides have ``keys``, date_from and date_to."""
    a = available.select(*keys, F.col("date_from").alias("have_from"), F.col("date_to").alias("have_to"))
    issue = F.when(F.col("have_from").isNull(), "NO_DATA").when(F.col("date_from") < F.col("have_from"), "REQUESTED_BEFORE_AVAILABLE").when(F.col("date_to") > F.col("have_to"), "REQUESTED_AFTER_AVAILABLE")
    return requested.join(a, keys, "left").withColumn("issue", issue).filter("issue is not null").select(*keys, "issue")


def integrity(disk: DataFrame, registry: DataFrame, keys: list[str]) -> DataFrame:
    """matched, disk_only or registry_only for every pair of either side."""
    d, r = disk.select(*keys).distinct().withColumn("_d", F.lit(1)), registry.select(*keys).distinct().withColumn("_r", F.lit(1))
    status = F.when(F.col("_r").isNull(), "disk_only").when(F.col("_d").isNull(), "registry_only").otherwise("matched")
    return d.join(r, keys, "full_outer").select(*keys, status.alias("status"))


def presence_matrix(rows: DataFrame, timeframes: list[str]) -> DataFrame:
    """Counts by symbol and timeframe, and the timeframes that are missing."""
    out = rows.groupBy("symbol").pivot("timeframe", timeframes).count().fillna(0, timeframes)
    return out.withColumn("missing", F.array_join(F.filter(F.array(*(F.when(F.col(t) == 0, F.lit(t)) for t in timeframes)), lambda x: x.isNotNull()), ","))


def history_summary(bars: DataFrame, seconds: int) -> DataFrame:
    """Per series the bars, the first and the last start, the bars of a gapless series between them, and the extremes."""
    first, last = F.min("t"), F.max("t")
    return bars.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), first.alias("first_t"), last.alias("last_t"), (F.floor((last - first) / seconds) + 1).alias("expected"), F.max("high").alias("high"), F.min("low").alias("low"))


def version_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two versions of the same series: counts, and rows that only the new one has."""
    added = new.join(old.select("series_id", "t"), ["series_id", "t"], "left_anti").groupBy("series_id").agg(F.count(F.lit(1)).alias("appended"))
    a = old.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_old"), F.max("t").alias("last_old"))
    b = new.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_new"), F.max("t").alias("last_new"))
    return b.join(a, "series_id", "left").join(added, "series_id", "left").withColumn("appended", F.coalesce("appended", F.lit(0)))
