"""Bars from ticks and bars, sessions, volume-weighted prices and pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import small
from ..session import materialise
from .scan import BLOCK, Series, running


def bucket(epoch: Column, seconds: int, offset: int = 0) -> Column:
    """Start of the epoch-aligned interval that holds ``epoch``."""
    return epoch - F.pmod(epoch - offset, F.lit(seconds))


def _ohlcv(order: str) -> list[Column]:
    return [F.min_by("open", order).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", order).alias("close"), F.sum("volume").alias("volume")]


def _as_points(ticks: DataFrame) -> DataFrame:
    p = F.col("price")
    return ticks.withColumns({"open": p, "high": p, "low": p, "close": p})


def resample_ticks(ticks: DataFrame, seconds: int) -> DataFrame:
    """OHLCV bars of fixed length: series_id, t (start), open, high, low, close, volume, n."""
    return _as_points(ticks).groupBy("series_id", bucket(F.col("epoch"), seconds).alias("t")).agg(*_ohlcv("seq"), F.count(F.lit(1)).alias("n"))


def resample(bars: DataFrame, seconds: int, offset: int = 0) -> DataFrame:
    """Larger bars: first open, highest high, lowest low, last close, summed volume, number of source bars."""
    return bars.groupBy("series_id", bucket(F.col("t"), seconds, offset).alias("t")).agg(*_ohlcv("t"), F.count(F.lit(1)).alias("n"))


def align_to_session(bars: DataFrame, start_hour: int) -> DataFrame:
    """Daily bars that begin at ``start_hour`` UTC. The very first row of a series is left out if it is not aligned; the rest of that partial day stays."""
    offset = start_hour * 3600
    kept = running(bars, ["series_id"], "t", _rn=("count", F.lit(1))).filter((F.col("_rn") > 1) | (F.pmod(F.col("t") - offset, F.lit(86400)) == 0)).drop("_rn")
    return resample(kept, 86400, offset)


def _bars_of(ticks: DataFrame) -> DataFrame:
    return _as_points(ticks).groupBy("series_id", "bar").agg(F.min("epoch").alias("open_epoch"), F.max("epoch").alias("close_epoch"), F.count(F.lit(1)).alias("n_ticks"), *_ohlcv("seq"))


def tick_bars(ticks: DataFrame, n: int) -> DataFrame:
    """A bar every n ticks; a last bar of at least two ticks stays."""
    numbered = running(ticks, ["series_id"], "seq", _rn=("count", F.lit(1)))
    return _bars_of(numbered.withColumn("bar", F.floor((F.col("_rn") - 1) / n))).filter("n_ticks >= 2")


#: Rows of a block of a series that is cut: what a Python worker holds at once, whatever the length of the series.
RESET_ROWS = 200_000


def reset_bars(ticks: DataFrame, measure: Column, threshold: float, signed: bool = False, block_rows: int | None = None) -> DataFrame:
    """Bars that close when the running measure (its size, if signed) reaches ``threshold``; the sum then restarts at zero, so overshoot is not carried.

    The reset makes a bar depend on all before it in its series. A series that fits a block is folded in one task, which carries only the
    series, bar and running total from batch to batch; a longer one is solved block by block (``_reset_blocks``). An ordinary
    aggregate then builds the bars. Ticks after the last full bar are left over: their bar has no closing tick. A null measure adds nothing. Adds ``measure_sum``.
    """
    rows = ticks.select(
        F.col("series_id").cast("string").alias("series_id"), F.col("seq").cast("long").alias("seq"), F.col("epoch").cast("long").alias("epoch"), F.col("price").cast("double").alias("price"), F.col("volume").cast("double").alias("volume"),
        F.coalesce(measure.cast("double"), F.lit(0.0)).alias("m"),
    )
    series = Series(rows, ["series_id"], "seq", block_rows or RESET_ROWS)
    folded = _reset_blocks(series, threshold, signed) if series.cut else _reset_fold(series.frame(), threshold, signed)
    return _as_points(folded).groupBy("series_id", "bar").agg(
        F.min("epoch").alias("open_epoch"), F.max("epoch").alias("close_epoch"), F.count(F.lit(1)).alias("n_ticks"), *_ohlcv("seq"), F.sum("m").alias("measure_sum"), F.max("closed").alias("closed")
    ).filter("closed").drop("closed")


_TICK = "series_id string, seq long, epoch long, price double, volume double, m double"


def _reset_fold(rows: DataFrame, threshold: float, signed: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bar, total = object(), 0, 0.0
        for b in batches:
            bars, closed = [], []
            for key, m in zip(b.column(0).to_pylist(), b.column(5).to_numpy(zero_copy_only=False).tolist()):
                if key != now:
                    now, bar, total = key, 0, 0.0
                total += m
                bars.append(bar)
                closed.append((abs(total) if signed else total) >= threshold)
                if closed[-1]:
                    bar, total = bar + 1, 0.0
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bars, pa.int64()), pa.array(closed, pa.bool_())], names=[*b.schema.names, "bar", "closed"])

    return rows.repartition("series_id").sortWithinPartitions("series_id", F.asc_nulls_last("seq")).mapInArrow(run, f"{_TICK}, bar long, closed boolean")


def first_close(s: np.ndarray, at: int, base: float, threshold: float, signed: bool) -> int:
    """First place from ``at`` on at which the prefix sums ``s`` have left ``base`` by the threshold; ``len(s)`` if none. Looks ahead in growing steps."""
    size = 64
    while at < len(s):
        grown = s[at : at + size] - base
        hit = (np.abs(grown) if signed else grown) >= threshold
        k = int(hit.argmax())
        if hit[k]:
            return at + k
        at, size = at + size, 2 * size
    return len(s)


def reset_steps(m: np.ndarray, threshold: float, signed: bool) -> list[tuple[int, float, float, float, int]]:
    """The running total at the end of a block of measures ``m`` as a step function of that at its start.

    (place, highest, lowest, total, closes): a block entered with total r closes its first bar at the first place where r + highest reaches the
    threshold (or, if signed, r + lowest the negative one), and ends with ``total`` after that many closes. Places are those where the prefix sum
    has a new extreme, and end where every total that can come in has closed. The last row, at place len(m), stands for no close; its total adds to r.
    Bars from different first closes soon fall together, so each start is followed only to one that is known.
    """
    s = np.cumsum(m)
    high, low = np.maximum.accumulate(s), np.minimum.accumulate(s)
    new = np.r_[True, high[1:] > high[:-1]] | (np.r_[True, low[1:] < low[:-1]] if signed else False)
    places = np.flatnonzero(new)
    if signed:
        sure = np.flatnonzero(high[places] - low[places] >= 2 * threshold)
    else:
        sure = np.flatnonzero(high[places] >= threshold) if (m >= 0).all() else np.zeros(0, np.int64)
    if len(sure):
        places = places[: sure[0] + 1]
    known: dict[int, tuple[float, int]] = {len(s): (0.0, 0)}
    out = []
    for p in places.tolist():
        path, at = [], p + 1
        while at not in known:
            close = first_close(s, at, s[at - 1], threshold, signed)
            if close == len(s):
                known[at] = (float(s[-1] - s[at - 1]), 0)
            else:
                path.append(at)
                at = close + 1
        total, closes = known[at]
        for q in reversed(path):
            closes += 1
            known[q] = (total, closes)
        out.append((p, float(high[p]), float(low[p]), total, closes + 1))
    return [*out, (len(s), float("inf"), float("-inf"), float(s[-1]) if len(s) else 0.0, 0)]


def _reset_blocks(series: Series, threshold: float, signed: bool) -> DataFrame:
    """Bar numbers and closing ticks of series of any length.

    What a block does to the running total is a step function (``reset_steps``) of a row for each tick of its first bar at most. The
    functions of a series are applied in order, streamed through a task that carries one total and one count; then every block numbers its own
    bars from its true start. Sums run from the start of a block, so they differ from the plain fold's by rounding at most.
    """
    rows = materialise(series.rows, "reset-blocks")
    steps = rows.select("series_id", BLOCK, "seq", "m").groupBy("series_id", BLOCK).applyInPandas(lambda p: _step_rows(p, threshold, signed), f"series_id string, {BLOCK} int, place long, highest double, lowest double, total double, closes long")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """series_id, block, total and bars so far at its start."""
        now, found, total, bars, out = object(), None, 0.0, 0, []
        for b in batches:
            out = []
            for key, block, high, low, ends, closes in zip(*(b.column(c).to_pylist() for c in ("series_id", BLOCK, "highest", "lowest", "total", "closes"))):
                if key != now:
                    now, total, bars, found = key, 0.0, 0, None
                if block != found:  # not past this block's first close yet
                    if total + high >= threshold or (signed and total + low <= -threshold):
                        out.append((key, block, total, bars))
                        found, total, bars = block, ends if closes else total + ends, bars + closes
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.float64(), pa.int64()))], names=["k", "b", "start", "bars"])

    walked = steps.repartition("series_id").sortWithinPartitions("series_id", BLOCK, "place").mapInArrow(walk, "k string, b int, start double, bars long")
    walked = small(materialise(walked, "reset-starts"))
    return rows.join(walked, F.col("series_id").eqNullSafe(F.col("k")) & (F.col(BLOCK) == F.col("b"))).drop("k", "b").groupBy("series_id", BLOCK).applyInPandas(lambda p: _numbered(p, threshold, signed), f"{_TICK}, bar long, closed boolean")


def _step_rows(p: pd.DataFrame, threshold: float, signed: bool) -> pd.DataFrame:
    m = p.sort_values("seq", kind="stable")["m"].to_numpy()
    out = pd.DataFrame(reset_steps(m, threshold, signed), columns=["place", "highest", "lowest", "total", "closes"])
    out.insert(0, BLOCK, p[BLOCK].iloc[0])
    out.insert(0, "series_id", p["series_id"].iloc[0])
    return out


def _numbered(p: pd.DataFrame, threshold: float, signed: bool) -> pd.DataFrame:
    p = p.sort_values("seq", kind="stable")
    s, base, at = np.cumsum(p["m"].to_numpy()), -float(p["start"].iloc[0]), 0
    closed = np.zeros(len(s), bool)
    while (close := first_close(s, at, base, threshold, signed)) < len(s):
        closed[close] = True
        base, at = s[close], close + 1
    bar = int(p["bars"].iloc[0]) + np.cumsum(closed) - closed
    return p[["series_id", "seq", "epoch", "price", "volume", "m"]].assign(bar=bar, closed=closed)


def vwap(price: str = "price", volume: str = "volume") -> Column:
    """Volume-weighted price over rows of non-negative volume; null without volume."""
    v = F.when(F.col(volume) >= 0, F.col(volume))
    return F.sum(F.col(price) * v) / F.nullif(F.sum(v), F.lit(0.0))


def twap(price: str, weight: str) -> Column:
    w = F.greatest(F.col(weight), F.lit(0.0))
    return F.sum(F.col(price) * w) / F.nullif(F.sum(w), F.lit(0.0))


def in_hours(hour: Column, start: Column, end: Column) -> Column:
    """End exclusive; a range that starts after its end wraps midnight; equal ends hold nothing."""
    return F.when(start < end, (hour >= start) & (hour < end)).otherwise((start != end) & ((hour >= start) | (hour < end)))


def vwap_per_session(ticks: DataFrame, sessions: DataFrame) -> DataFrame:
    """VWAP per series and session; a tick counts in every session that holds its hour. ``sessions`` has a row a name (at most a day's worth)."""
    hour = F.floor(F.pmod("epoch", F.lit(86400)) / 3600)
    hours = sessions.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23)))).filter(in_hours(F.col("hour"), F.col("start_hour"), F.col("end_hour"))).select("name", "hour")
    return ticks.withColumn("hour", hour).join(F.broadcast(hours), "hour").groupBy("series_id", F.col("name").alias("session")).agg(vwap().alias("vwap"), F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"))


def slippage(fills: DataFrame) -> DataFrame:
    """fill, vwap, side, size to absolute, basis-point and total cost, with a verdict; a sell's sign is turned."""
    d = (F.col("price") - F.col("vwap")) * F.when(F.col("side") == "buy", 1.0).otherwise(-1.0)
    bps = d / F.nullif(F.col("vwap"), F.lit(0.0)) * 10000
    verdict = F.when(F.col("slippage_bps") < -5, "excellent").when(F.col("slippage_bps") < 0, "good").when(F.col("slippage_bps") < 10, "acceptable").otherwise("poor")
    return fills.withColumns({"slippage_abs": d, "slippage_bps": bps, "cost": d * F.col("size")}).withColumn("verdict", verdict)


def participation(own: Column, market: Column) -> tuple[Column, Column]:
    pct = 100 * own / F.nullif(market, F.lit(0.0))
    return pct, F.when(pct < 1, "negligible").when(pct < 5, "low").when(pct < 10, "moderate").when(pct < 25, "high").otherwise("dominant")


def pivots(h: Column, l: Column, c: Column, o: Column) -> dict[str, dict[str, Column]]:
    """Five sets of support and resistance levels from a period's high, low, close and open."""
    p, r = (h + l + c) / 3, h - l
    w = (h + l + 2 * c) / 4
    x = F.when(c < o, h + 2 * l + c).when(c > o, 2 * h + l + c).otherwise(h + l + 2 * c)
    return {
        "classic": {"p": p, "r1": 2 * p - l, "s1": 2 * p - h, "r2": p + r, "s2": p - r},
        "fibonacci": {"p": p, "r1": p + 0.382 * r, "s1": p - 0.382 * r, "r2": p + 0.618 * r, "s2": p - 0.618 * r, "r3": p + r, "s3": p - r},
        "camarilla": {"p": p, "r1": c + r * 1.1 / 12, "s1": c - r * 1.1 / 12, "r2": c + r * 1.1 / 6, "s2": c - r * 1.1 / 6, "r3": c + r * 1.1 / 4, "s3": c - r * 1.1 / 4, "r4": c + r * 1.1 / 2, "s4": c - r * 1.1 / 2},
        "woodie": {"p": w, "r1": 2 * w - l, "s1": 2 * w - h, "r2": w + r, "s2": w - r},
        "demark": {"p": x / 4, "r1": x / 2 - l, "s1": x / 2 - h},
    }
