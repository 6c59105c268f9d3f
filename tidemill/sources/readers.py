"""Scans and sinks: trade lists, bar files, archives, reports, inventories, snapshots and result sets."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Names under which exports hold a column, without regard to case.
ALIASES = {
    "profit": ["profit", "profitloss", "profit/loss", "p/l", "pl", "net", "net profit"],
    "symbol": ["symbol", "instrument"],
    "direction": ["direction", "type", "side"],
    "opened": ["open time", "opentime", "time"],
}
BAD = "_bad"


def number(text: Column, decimal: str = ".") -> Column:
    t = F.trim(text)
    if decimal == ",":
        t = F.translate(F.translate(t, ".", ""), ",", ".")
    return F.nullif(t, F.lit("")).try_cast("double")


def read_trades(spark: SparkSession, path: str, sep: str = ",", decimal: str = ".") -> DataFrame:
    """Rows of trade lists with any of the known headers: profit, symbol, direction, opened, file, and ``_bad`` where profit is no number.

    Nothing is inferred: all columns are read as text. A file list without a profit-like column gives no rows.
    """
    raw = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE").csv(path)
    have = {c.strip().lstrip("﻿").lower(): c for c in raw.columns}

    def pick(name: str) -> Column:
        found = [F.col(f"`{have[a]}`") for a in ALIASES[name] if a in have]
        return F.coalesce(*found) if len(found) > 1 else found[0] if found else F.lit(None).cast("string")

    out = raw.select(number(pick("profit"), decimal).alias("profit"), *(pick(c).alias(c) for c in ("symbol", "direction", "opened")), F.col("_metadata.file_path").alias("file"))
    out = out.withColumn(BAD, F.col("profit").isNull())
    return out if any(a in have for a in ALIASES["profit"]) else out.limit(0)


def trade_summary(trades: DataFrame, *keys: str) -> DataFrame:
    p = F.when(~F.col(BAD), F.col("profit"))
    return trades.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col(BAD), 1)).alias("skipped"), F.count(F.when(p > 0, 1)).alias("wins"), F.count(F.when(p < 0, 1)).alias("losses"), F.sum(p).alias("net"), F.max(p).alias("best"), F.min(p).alias("worst")
    )


def read_bars(spark: SparkSession, path: str, seconds: int, stamp: str = "start", on_error: str = "ignore", zone: str = "UTC", first: str | None = None, last: str | None = None) -> DataFrame:
    """Bars from CSV (series_id, time, open, high, low, close, volume): times of ``zone`` to UTC starts; ``stamp='end'`` is moved by the interval.

    ``on_error`` is ``stop`` (a bad row fails the job) or ``ignore`` (bad rows go).
    """
    schema = "series_id string, time timestamp, open double, high double, low double, close double, volume double"
    mode = "FAILFAST" if on_error == "stop" else "DROPMALFORMED"
    raw = spark.read.schema(schema).option("header", True).option("mode", mode).csv(path)
    t = F.unix_seconds(F.to_utc_timestamp("time", zone)) - (seconds if stamp == "end" else 0)
    out = raw.withColumn("t", t).drop("time")
    if first:
        out = out.filter(F.col("t") >= F.unix_seconds(F.lit(first).cast("timestamp")))
    return out.filter(F.col("t") <= F.unix_seconds(F.lit(last).cast("timestamp"))) if last else out


def infer_interval(bars: DataFrame) -> DataFrame:
    """Most frequent step of each series, the smaller of equally frequent ones."""
    from pyspark.sql import Window

    d = bars.withColumn("step", F.col("t") - F.lag("t").over(Window.partitionBy("series_id").orderBy("t"))).filter("step is not null")
    n = d.groupBy("series_id", "step").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("series_id").agg(F.min_by("step", F.struct(-F.col("n"), "step")).alias("seconds"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Strategy rows from zip archives of XML (member ``strategy.xml``): name, symbol, timeframe, trades, net_profit, drawdown, fitness_is, fitness_oos.

    Python only unzips; fields come from XPath expressions. Archives that cannot be read give a row with ``error``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")

    def unzip(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for name, content in zip(p["path"], p["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        out.append((name, z.read("strategy.xml").decode("utf-8"), None))
                except (zipfile.BadZipFile, KeyError, UnicodeDecodeError) as e:
                    out.append((name, None, type(e).__name__))
            yield pd.DataFrame(out, columns=["path", "xml", "error"])

    return strategy_fields(files.mapInPandas(unzip, "path string, xml string, error string"))


def strategy_fields(rows: DataFrame) -> DataFrame:
    """Strategy rows from a column ``xml``; other columns stay in front."""
    x = lambda p: F.xpath_string("xml", F.lit(f"/strategy/{p}"))
    num = lambda p: F.nullif(x(p), F.lit("")).try_cast("double")
    return rows.select(*(c for c in rows.columns if c != "xml"), x("@name").alias("name"), x("symbol").alias("symbol"), x("timeframe").alias("timeframe"), num("trades").cast("int").alias("trades"), num("net_profit").alias("net_profit"), num("drawdown").alias("drawdown_abs"), num("fitness/@is").alias("fitness_is"), num("fitness/@oos").alias("fitness_oos"))


def inventory(spark: SparkSession, path: str, pattern: str = r"([A-Z0-9]+?)(?:_[a-z]+)?_(M1|M5|M15|M30|H1|H4|D1|W1)\.[a-z]+$") -> DataFrame:
    """Files, bytes and newest change by (symbol, timeframe), from names alone; contents are not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    f = f.select(F.regexp_extract("path", pattern, 1).alias("symbol"), F.regexp_extract("path", pattern, 2).alias("timeframe"), "length", "modificationTime").filter("symbol <> ''")
    return f.groupBy("symbol", "timeframe").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest"))


def by_symbol(files: DataFrame) -> DataFrame:
    """An inventory by symbol: files, bytes, newest change, timeframes (names, a handful)."""
    return files.groupBy("symbol").agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"), F.max("newest").alias("newest"), F.array_join(F.sort_array(F.collect_set("timeframe")), ",").alias("timeframes"))


def symbols(disk: DataFrame, registry: DataFrame) -> DataFrame:
    """All symbols of a registry (symbol, listed) and of a disk (symbol, files); ``source`` is the registry where it has the symbol."""
    j = disk.join(registry, "symbol", "full_outer")
    return j.select("symbol", F.coalesce("files", F.lit(0)).alias("files"), F.when(F.col("listed"), "registry").otherwise("filesystem").alias("source"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """name, bytes and sha of every file below ``path``."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return f.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha"))


def write_snapshot(rows: DataFrame, path: str, label: str, columns: list[str]) -> None:
    """Adds the tracked columns under ``label=...``; a label written again is replaced, others stay."""
    rows.select(*columns, F.current_timestamp().alias("created_at"), F.lit(label).alias("label")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("label").parquet(path)


def save_set(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A result set, partitioned by project and databank; overwriting replaces only the partitions that ``rows`` has."""
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("project", "databank").parquet(path)


def export_csv(rows: DataFrame, path: str, columns: list[str], by: list[str] | None = None) -> None:
    w = rows.select(*(by or []), *[c for c in columns if c not in (by or [])]).write.mode("overwrite").option("header", True)
    (w.partitionBy(*by) if by else w).csv(path)


def clear_set(spark: SparkSession, path: str, target: str, project: str, databank: str) -> None:
    """The set at ``path`` without one databank, as a new table at ``target``: readers of the old one are not disturbed."""
    gone = (F.col("project") == project) & (F.col("databank") == databank)
    spark.read.parquet(path).filter(~gone).write.partitionBy("project", "databank").parquet(target)
