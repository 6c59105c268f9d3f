"""Registered queries: scans and sinks. Each writes what Spark derives from the tables and reads it again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import trades as T
from ..session import scratch_path
from ..sources import readers as IO
from ..sources.views import ticks_of
from ..streaming import live as L
from .bars import _reset_sql
from .catalog import _S
from .registry import query
from .text import _ALERTS, _WIN, arrivals


def _trade_files(v, sep: str, decimal: str) -> str:
    """Trade lists as CSV under headers of another program, every seventh profit unreadable."""
    path = scratch_path(v.spark, "trades-csv")
    profit = F.when(F.col("seq") % 7 == 0, F.lit("n/a")).otherwise(F.col("pnl").cast("decimal(18,4)").cast("string"))
    profit = F.translate(profit, ".", ",") if decimal == "," else profit
    v.trades.select(F.col("symbol").alias("Instrument"), profit.alias("P/L"), F.col("side").alias("Type")).write.option("header", True).option("sep", sep).csv(path)
    return path


for _n, _sep, _dec in (("trade_csv_analyze", ",", "."), ("trade_csv_for_strategy", ";", ",")):

    @query(_n, """-- floats: net best worst
SELECT symbol, count(*) AS rows, count(*) FILTER (seq % 7 = 0) AS skipped, count(*) FILTER (p > 0) AS wins, count(*) FILTER (p < 0) AS losses, sum(p) AS net, max(p) AS best, min(p) AS worst FROM (SELECT symbol, seq, CASE WHEN seq % 7 <> 0 THEN round(pnl, 4) END AS p FROM trades) GROUP BY symbol""", digits=3)
    def _(v, sep=_sep, dec=_dec):
        return IO.trade_summary(IO.read_trades(v.spark, _trade_files(v, sep, dec), sep, dec), "symbol")


def _xml(v):
    """One XML text a strategy, written and read as files of text."""
    path = scratch_path(v.spark, "strategies-xml")
    s = v.strategies
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), F.col(c).cast("string"), F.lit(f"</{name}>"))
    oos = F.coalesce(F.concat(F.lit("' oos='"), F.col("fitness_oos").cast("string")), F.lit(""))
    xml = F.concat(F.lit("<strategy name='"), F.col("strategy_id").cast("string"), F.lit("'>"), tag("symbol", "symbol"), tag("timeframe", "timeframe"), tag("trades", "trades"), tag("net_profit", "net_profit"), tag("drawdown", "drawdown_abs"), F.lit("<fitness is='"), F.col("fitness_is").cast("string"), oos, F.lit("'/></strategy>"))
    s.select(xml.alias("value")).write.text(path)
    return IO.strategy_fields(v.spark.read.text(path).withColumnRenamed("value", "xml"))


@query("archive_inspect", "-- floats: net_profit drawdown_abs fitness_is fitness_oos\nSELECT CAST(strategy_id AS VARCHAR) AS name, symbol, timeframe, CAST(trades AS INT) AS trades, net_profit, drawdown_abs, fitness_is, fitness_oos FROM strategies", digits=4)
def _(v):
    return _xml(v)


@query("strategy_metrics", f"-- floats: oos_is profit_to_dd avg_trade\nSELECT CAST(strategy_id AS VARCHAR) AS name, oos_is, profit_to_dd, avg_trade FROM {_S}", digits=4)
def _(v):
    from ..functions.common import ratio

    return _xml(v).select("name", ratio(F.col("fitness_oos"), F.col("fitness_is")).alias("oos_is"), ratio(F.col("net_profit"), F.col("drawdown_abs")).alias("profit_to_dd"), ratio(F.col("net_profit"), F.col("trades")).alias("avg_trade"))


def _history(v, rows=None):
    """History files of a fixed number of bytes a strategy, one a pair of symbol and timeframe; the inventory reads names and sizes alone."""
    path = scratch_path(v.spark, "history")
    rows = v.strategies if rows is None else rows
    line = F.format_string("%010d", "strategy_id").alias("line")
    rows.select("symbol", "timeframe", line).repartition("symbol", "timeframe").write.partitionBy("symbol", "timeframe").text(path)
    return IO.inventory(v.spark, path, r"symbol=([^/]+)/timeframe=([^/]+)/[^/]+\.txt$")


@query("data_list_local", "SELECT symbol, timeframe, CAST(1 AS BIGINT) AS files FROM strategies GROUP BY symbol, timeframe")
def _(v):
    return _history(v).select("symbol", "timeframe", "files")


@query("history_disk_inventory", "SELECT symbol, count(*) AS files, CAST(sum(n) * 11 AS BIGINT) AS bytes, array_to_string(list_sort(list(timeframe)), ',') AS timeframes FROM (SELECT symbol, timeframe, count(*) AS n FROM strategies GROUP BY ALL) GROUP BY symbol")
def _(v):
    """A row a symbol: files, bytes, timeframes."""
    return IO.by_symbol(_history(v)).drop("newest")


@query("symbol_data_summary", "SELECT symbol, timeframe, CAST(1 AS BIGINT) AS files, count(*) * 11 AS bytes, CAST(sum(count(*) * 11) OVER (PARTITION BY symbol) AS BIGINT) AS symbol_bytes, true AS fresh FROM strategies GROUP BY symbol, timeframe")
def _(v):
    """The files of each symbol in detail, beside the symbol's bytes, and whether they changed within the day."""
    f = _history(v)
    total = f.groupBy("symbol").agg(F.sum("bytes").alias("symbol_bytes"))
    fresh = F.col("newest") >= F.current_timestamp() - F.make_dt_interval(days=F.lit(1))
    return f.join(total, "symbol").select("symbol", "timeframe", "files", "bytes", "symbol_bytes", fresh.alias("fresh"))


@query("symbol_list", "SELECT symbol, coalesce(files, 0) AS files, CASE WHEN r THEN 'registry' ELSE 'filesystem' END AS source FROM (SELECT symbol, count(DISTINCT timeframe) AS files FROM strategies WHERE databank <> 'd1' GROUP BY symbol) d FULL JOIN (SELECT DISTINCT symbol, true AS r FROM strategies WHERE project <> 'p0') g USING (symbol)")
def _(v):
    """Symbols of the registry, and those that only the disk has, with the number of their files."""
    disk = IO.by_symbol(_history(v, v.strategies.filter("databank <> 'd1'"))).select("symbol", "files")
    registry = v.strategies.filter("project <> 'p0'").select("symbol", F.lit(True).alias("listed")).distinct()
    return IO.symbols(disk, registry)


def _back(v, path: str, schema: str):
    return v.spark.read.schema(schema).option("header", True).csv(path)


@query("portfolio_export_csv", "-- floats: net_profit\nSELECT strategy_id, symbol, net_profit FROM strategies WHERE trades >= 50 ORDER BY fitness_full DESC, strategy_id LIMIT 25", digits=4)
def _(v):
    path = scratch_path(v.spark, "export")
    IO.export_csv(v.strategies.filter("trades >= 50").orderBy(F.desc("fitness_full"), "strategy_id").limit(25), path, ["strategy_id", "symbol", "net_profit"])
    return _back(v, path, "strategy_id long, symbol string, net_profit double")


@query("strategy_orders_export", "-- floats: pnl\nSELECT strategy_id % 16 AS bucket, strategy_id, seq, symbol, pnl FROM trades", digits=4)
def _(v):
    """All orders, in folders by a bucket of strategies."""
    path = scratch_path(v.spark, "orders")
    IO.export_csv(v.trades.withColumn("bucket", F.col("strategy_id") % 16).repartition("bucket"), path, ["strategy_id", "seq", "symbol", "pnl"], ["bucket"])
    return _back(v, path, "strategy_id long, seq long, symbol string, pnl double, bucket long")


@query("data_export", '-- floats: "close" volume\nSELECT series_id, t, "close", volume FROM bars WHERE series_id IN (\'click\', \'view\') AND t >= 1705276800', digits=4)
def _(v):
    path = scratch_path(v.spark, "bars-csv")
    IO.export_csv(v.bars.filter("series_id in ('click', 'view') and t >= 1705276800"), path, ["t", "close", "volume"], ["series_id"])
    return _back(v, path, "t long, close double, volume double, series_id string")


@query("databank_export", "-- floats: fitness_full net_profit\nSELECT strategy_id, symbol, fitness_full, net_profit FROM strategies WHERE project = 'p1' AND databank = 'd2'", digits=4)
def _(v):
    """One databank, with the columns of a view, as CSV."""
    path = scratch_path(v.spark, "databank-csv")
    IO.export_csv(v.strategies.filter("project = 'p1' and databank = 'd2'"), path, ["strategy_id", "symbol", "fitness_full", "net_profit"])
    return _back(v, path, "strategy_id long, symbol string, fitness_full double, net_profit double")


@query("data_import", '-- floats: open "close"\nSELECT series_id, t - 3600 AS t, open, "close" FROM bars WHERE t - 3600 >= 1704499200', digits=4)
def _(v):
    """Bars with end stamps, every other reading as text, from a date on."""
    path = scratch_path(v.spark, "import")
    v.bars.select("series_id", F.timestamp_seconds("t").alias("time"), "open", "high", "low", "close", "volume").write.option("header", True).csv(path)
    return IO.read_bars(v.spark, path, 3600, stamp="end", first="2024-01-06 00:00:00").select("series_id", "t", "open", "close")


@query("databank_snapshot_metrics", "-- floats: fitness_full\nSELECT strategy_id, fitness_full, label FROM strategies, (VALUES ('a'), ('b')) l(label)")
def _(v):
    path = scratch_path(v.spark, "snapshots")
    for label in ("a", "b", "a"):
        IO.write_snapshot(v.strategies, path, label, ["strategy_id", "fitness_full"])
    return v.spark.read.parquet(path).select("strategy_id", "fitness_full", "label")


for _n in ("databank_save", "databank_load", "databank_clear"):

    @query(_n, "SELECT project, databank, strategy_id FROM strategies" + (" WHERE NOT (project = 'p1' AND databank = 'd2')" if _n == "databank_clear" else ""))
    def _(v, clear=_n == "databank_clear"):
        path = scratch_path(v.spark, "set")
        IO.save_set(v.strategies.select("strategy_id", "project", "databank"), path)
        if clear:
            target = scratch_path(v.spark, "set")
            IO.clear_set(v.spark, path, target, "p1", "d2")
            path = target
        return v.spark.read.parquet(path).select("project", "databank", "strategy_id")


def _events(v):
    """The events as a stream."""
    return v.spark.readStream.schema(v.table("events").schema).parquet(f"{v.sf_dir}/events.parquet*")


def _run(stream, mode: str):
    """Starts a stream, lets it take all that is there, stops it, and gives its table."""
    spark, path = stream.sparkSession, scratch_path(stream.sparkSession, "live")
    write = "overwrite" if mode == "complete" else "append"

    def put(batch, _):
        batch.write.mode(write).parquet(path)

    q = stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", scratch_path(spark, "live-state")).trigger(availableNow=True).start()
    q.awaitTermination()
    q.stop()
    return spark.read.schema(stream.schema).parquet(path)


def _live(v):
    return L.every_window(_run(L.monitor_windows(arrivals(_events(v)), "6 hours", "1 hour"), "complete").drop("ts"), "6 hours")


def _stateful(v):
    """Operators with own state need the state store that keeps it on disk."""
    v.spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@query("stream_bars", """-- floats: open high low close volume
SELECT series_id, t, open, high, low, "close", volume, n FROM bars""")
def _(v):
    """Streaming twin of the hourly bars."""
    ticks = ticks_of(_events(v)).withColumn("ts", F.timestamp_seconds("epoch"))
    return _run(L.stream_bars(ticks), "complete")


@query("stream_vwap", "-- floats: vwap\nSELECT series_id, t, floor(vwap * 1e6 + 0.3137) / 1e6 AS vwap FROM (SELECT series_id, epoch - epoch % 3600 AS t, sum(price * volume) / nullif(sum(volume), 0) AS vwap FROM ticks GROUP BY ALL)")
def _(v):
    """Streaming twin of the hourly volume-weighted price, in millionths cut where no short decimal lies: the sums' order cannot turn a digit."""
    out = _run(L.stream_vwap(ticks_of(_events(v)).withColumn("ts", F.timestamp_seconds("epoch"))), "complete")
    return out.withColumn("vwap", F.floor(F.col("vwap") * 1e6 + 0.3137) / 1e6)


@query("stream_freshness", "SELECT series_id, max(epoch) AS last, false AS fresh FROM ticks GROUP BY series_id")
def _(v):
    """Against the clock at which the query runs, for which no tick of the tables is fresh."""
    ticks = ticks_of(_events(v)).withColumn("ts", F.timestamp_seconds("epoch"))
    return _run(L.stream_freshness(ticks, 86400), "complete").select("series_id", F.unix_seconds("last").alias("last"), "fresh")


@query("stream_reset_bars", f"-- floats: measure_sum\nSELECT series_id, bar, measure_sum, n_ticks FROM ({_reset_sql('volume', 500.0).partition(chr(10))[2]})")
def _(v):
    """Streaming twin of the bars of a running volume that restarts at zero."""
    _stateful(v)
    return _run(L.stream_reset_bars(ticks_of(_events(v)).select("series_id", "seq", F.col("volume").alias("measure")), 500.0), "append")


@query("stream_alerts", f"-- floats: value\n{_ALERTS}")
def _(v):
    """Alerts of a stream of windows with arrivals; timers close those without, so a project that falls silent alerts too."""
    _stateful(v)
    windows = L.monitor_windows(arrivals(v.table("events")), "6 hours", None).filter("new > 0")
    path = scratch_path(v.spark, "windows")
    windows.write.parquet(path)
    return _run(L.stream_alerts(v.spark.readStream.schema(windows.schema).parquet(path), 6 * 3600), "append")


@query("monitor_start", f"-- floats: fitness fitness_oos\nSELECT * FROM {_WIN}")
def _(v):
    return _live(v)


@query("monitor_stop", f"SELECT project, count(*) AS windows, CAST(sum(new) AS BIGINT) AS rows FROM {_WIN} GROUP BY project")
def _(v):
    return _live(v).groupBy("project").agg(F.count(F.lit(1)).alias("windows"), F.sum("new").alias("rows"))
