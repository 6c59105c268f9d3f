"""Structured Streaming twins: bars, freshness, monitor windows and alerts, resetting accumulators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

# Rule code, windows looked at, threshold.
MONITOR_RULES = [("STALLED_GROWTH", 5, 0.0), ("LOW_MEDIAN_FITNESS", 3, 0.2), ("OOS_DEGRADATION", 3, 0.5)]


def stream_bars(ticks: DataFrame, interval: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """OHLCV bars of a tick stream (series_id, seq, ts, price, volume); ticks later than ``late`` are dropped, a bar comes out when the watermark passes its end."""
    return ticks.withWatermark("ts", late).groupBy("series_id", F.window("ts", interval)).agg(
        F.min_by("price", "seq").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "seq").alias("close"), F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("n")
    ).select("series_id", F.unix_seconds(F.col("window.start").cast("timestamp")).alias("t"), "open", "high", "low", "close", "volume", "n")


def stream_vwap(ticks: DataFrame, interval: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    v = F.when(F.col("volume") >= 0, F.col("volume"))
    g = ticks.withWatermark("ts", late).groupBy("series_id", F.window("ts", interval)).agg((F.sum(F.col("price") * v) / F.nullif(F.sum(v), F.lit(0.0))).alias("vwap"))
    return g.select("series_id", F.unix_seconds(F.col("window.start").cast("timestamp")).alias("t"), "vwap")


def _seconds(interval: str) -> Column:
    return F.expr(f"unix_seconds(timestamp_seconds(0) + INTERVAL {interval})")


def monitor_windows(rows: DataFrame, interval: str, late: str | None = "10 minutes") -> DataFrame:
    """Arrivals by project and window: new rows, median fitness in and out of sample.

    A batch (late None) has a row for every window of a project from its first arrival to the last of any project, without arrivals too. A
    stream can only give windows that have rows (with ``ts``, their time); the windows between are closed by timers where they are looked at (``stream_alerts``).
    """
    rows = rows.withWatermark("ts", late) if late else rows
    g = rows.groupBy("project", F.window("ts", interval)).agg(F.count(F.lit(1)).alias("new"), F.percentile_approx("fitness", 0.5, 10000).alias("fitness"), F.percentile_approx("fitness_oos", 0.5, 10000).alias("fitness_oos"))
    columns = ["project", F.unix_seconds(F.col("window.start").cast("timestamp")).alias("t"), "new", "fitness", "fitness_oos"]
    return g.select(*columns, F.window_time("window").alias("ts")) if late else every_window(g.select(*columns), interval)


def every_window(windows: DataFrame, interval: str) -> DataFrame:
    """``windows`` and, with no new rows, those without arrivals: of each project from its first to the last one of any project."""
    last = windows.agg(F.max("t").alias("_last"))
    spans = windows.groupBy("project").agg(F.min("t").alias("_first")).join(F.broadcast(last))
    calendar = spans.select("project", F.explode(F.sequence("_first", "_last", _seconds(interval))).alias("t"))
    return calendar.join(windows, ["project", "t"], "left").withColumn("new", F.coalesce("new", F.lit(0).cast("long")))


def monitor_alerts(windows: DataFrame) -> DataFrame:
    """First window of each project at which a rule fires over its last windows; rules wait for as many windows as they look at."""
    order = Window.partitionBy("project").orderBy("t")
    back = lambda k: order.rowsBetween(-(k - 1), 0)
    seen = F.row_number().over(order)
    out = None
    for code, k, limit in MONITOR_RULES:
        x = F.when(F.col("fitness") > 0, F.col("fitness_oos") / F.col("fitness")) if code == "OOS_DEGRADATION" else F.col("fitness")
        value = F.sum("new").over(back(k)).cast("double") if code == "STALLED_GROWTH" else F.percentile("_x", 0.5).over(back(k))
        bad = F.col("value") <= limit if code == "STALLED_GROWTH" else F.col("value") < limit
        hit = windows.withColumn("_x", x).withColumn("value", F.when(seen >= k, value)).filter(bad)
        hit = hit.groupBy("project").agg(F.min("t").alias("t"), F.min_by("value", "t").alias("value")).withColumn("code", F.lit(code))
        out = hit if out is None else out.union(hit)
    return out


def monitor_sessions(windows: DataFrame, alerts: DataFrame) -> DataFrame:
    """A row a monitored project: number of windows, start of the first and the last, rows seen, alerts raised."""
    g = windows.groupBy("project").agg(F.count(F.lit(1)).alias("windows"), F.min("t").alias("started"), F.max("t").alias("last"), F.sum("new").alias("n"))
    return g.join(alerts.groupBy("project").agg(F.count(F.lit(1)).alias("alerts")), "project", "left").fillna(0, ["alerts"])


def monitor_state(windows: DataFrame, alerts: DataFrame, last: int) -> DataFrame:
    """The ``last`` newest snapshots of each project, with the rows seen by then, and the codes (a rule each) that have been raised."""
    by = Window.partitionBy("project")
    w = windows.withColumns({"total": F.sum("new").over(by.orderBy("t")), "_i": F.row_number().over(by.orderBy(F.desc("t")))}).filter(F.col("_i") <= last).drop("_i")
    codes = alerts.groupBy("project").agg(F.array_join(F.sort_array(F.collect_set("code")), ",").alias("codes"))
    return w.join(codes, "project", "left").fillna("", ["codes"])


class MonitorState(StatefulProcessor):
    """Rules over the last windows of a project, each fired once: the newest windows and the codes that have fired are kept.

    A project that falls silent sends no rows, so a timer at the start of its next window closes that window with no new rows once the watermark,
    which the other projects carry on, has passed it; so the rules also see windows without arrivals.
    """

    def __init__(self, step: int):
        self.step = step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getValueState("windows", StructType([StructField("rows", StringType())]))
        self.fired = handle.getValueState("fired", StructType([StructField("codes", StringType())]))

    def _load(self) -> tuple[list, set]:
        import json

        return json.loads(self.windows.get()[0]) if self.windows.exists() else [], set(json.loads(self.fired.get()[0])) if self.fired.exists() else set()

    def _keep(self, held: list, fired: set) -> None:
        import json

        self.windows.update((json.dumps(held[-max(k for _, k, _ in MONITOR_RULES) :]),))
        self.fired.update((json.dumps(sorted(fired)),))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if held:
            self.handle.registerTimer((held[-1][0] + self.step) * 1000 + 1)

    def _look(self, held: list, fired: set, project: str, window: list) -> list[tuple]:
        """Alerts of one more window."""
        held.append(window)
        out = []
        for code, k, limit in MONITOR_RULES:
            last = held[-k:]
            if code in fired or len(held) < k:
                continue
            if code == "STALLED_GROWTH":
                value = float(sum(w[1] for w in last))
                bad = value <= limit
            else:
                xs = [w[2] for w in last if w[2] is not None] if code == "LOW_MEDIAN_FITNESS" else [w[3] / w[2] for w in last if w[2] and w[2] > 0 and w[3] is not None]
                value = float(pd.Series(xs).median()) if xs else None
                bad = value is not None and value < limit
            if bad:
                fired.add(code)
                out.append((project, window[0], value, code))
        return out

    def _silent(self, held: list, fired: set, project: str, before: int) -> list[tuple]:
        """The windows without rows that start before ``before`` (seconds)."""
        out = []
        while held and held[-1][0] + self.step < before:
            out += self._look(held, fired, project, [held[-1][0] + self.step, 0, None, None])
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, fired = self._load()
        out = []
        for r in pd.concat(list(rows)).sort_values("t").itertuples():
            if held and r.t <= held[-1][0]:
                continue  # a window that has been closed already
            out += self._silent(held, fired, key[0], int(r.t))
            out += self._look(held, fired, key[0], [int(r.t), int(r.new), None if pd.isna(r.fitness) else float(r.fitness), None if pd.isna(r.fitness_oos) else float(r.fitness_oos)])
        self._keep(held, fired)
        yield pd.DataFrame(out, columns=["project", "t", "value", "code"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, fired = self._load()
        out = self._silent(held, fired, key[0], timerValues.getCurrentWatermarkInMs() // 1000)
        self._keep(held, fired)
        yield pd.DataFrame(out, columns=["project", "t", "value", "code"])

    def close(self) -> None:
        pass


ALERT_SCHEMA = StructType([StructField("project", StringType()), StructField("t", LongType()), StructField("value", DoubleType()), StructField("code", StringType())])


def stream_alerts(windows: DataFrame, interval_seconds: int, late: str = "0 seconds") -> DataFrame:
    """Alerts of a stream of closed windows (project, t, new, fitness, fitness_oos); batch twin: ``monitor_alerts``.

    Windows come in order of their start, up to ``late``. A window without rows counts once another project has a later one.
    """
    timed = windows.withColumn("ts", F.timestamp_seconds("t")).withWatermark("ts", late)
    return timed.groupBy("project").transformWithStateInPandas(MonitorState(interval_seconds), ALERT_SCHEMA, "Append", "EventTime")


class ResetSum(StatefulProcessor):
    """Running measure per series that closes a bar at the threshold and restarts at zero; batch twin: ``reset_bars``."""

    def __init__(self, threshold: float):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", StructType([StructField("bar", LongType()), StructField("total", DoubleType()), StructField("ticks", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bar, total, ticks = self.state.get() if self.state.exists() else (0, 0.0, 0)
        out = []
        for r in pd.concat(list(rows)).sort_values("seq").itertuples():
            total, ticks = total + r.measure, ticks + 1
            if total >= self.threshold:
                out.append((key[0], bar, total, ticks))
                bar, total, ticks = bar + 1, 0.0, 0
        self.state.update((int(bar), float(total), int(ticks)))
        yield pd.DataFrame(out, columns=["series_id", "bar", "measure_sum", "n_ticks"])

    def close(self) -> None:
        pass


BAR_SCHEMA = StructType([StructField("series_id", StringType()), StructField("bar", LongType()), StructField("measure_sum", DoubleType()), StructField("n_ticks", LongType())])


def stream_reset_bars(ticks: DataFrame, threshold: float) -> DataFrame:
    """Closed bars of a stream (series_id, seq, measure); ticks of a series must arrive in order of seq across batches."""
    return ticks.groupBy("series_id").transformWithStateInPandas(ResetSum(threshold), BAR_SCHEMA, "Append", "None")


def stream_freshness(ticks: DataFrame, max_age_seconds: int) -> DataFrame:
    """Newest tick of each series against the clock of the batch (complete or update mode)."""
    g = ticks.groupBy("series_id").agg(F.max("ts").alias("last"))
    return g.withColumn("fresh", F.current_timestamp() <= F.col("last").cast("timestamp") + F.make_dt_interval(secs=F.lit(max_age_seconds)))
