"""Small literal cases and invariants of single operators."""

import math
import random
import zipfile
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions.common import normal_cdf
from tidemill.operators import bars as B
from tidemill.operators import catalog as C
from tidemill.operators import graph as G
from tidemill.operators import indicators as I
from tidemill.operators import risk as R
from tidemill.operators import selection as S
from tidemill.operators import stats as ST
from tidemill.operators import text as X
from tidemill.operators import trades as T
from tidemill.operators import workflows as W
from tidemill.session import ship
from tidemill.sources import readers
from tidemill.streaming import live


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def series(spark, values, name="s"):
    return spark.createDataFrame([(name, i, None if v is None else float(v)) for i, v in enumerate(values)], "series_id string, idx long, v double")


def ticks(spark, prices, volumes):
    return spark.createDataFrame([("s", i, 60 * i, float(p), float(q)) for i, (p, q) in enumerate(zip(prices, volumes))], "series_id string, seq long, epoch long, price double, volume double")


def test_overshoot_is_not_carried(spark):
    rows = B.reset_bars(ticks(spark, [1, 2, 3, 4, 5], [8, 7, 4, 6, 9]), F.col("volume"), 10.0).orderBy("bar").collect()
    assert [(r.bar, r.n_ticks, r.measure_sum, r.open, r.close) for r in rows] == [(0, 2, 15.0, 1.0, 2.0), (1, 2, 10.0, 3.0, 4.0)]


def test_resetting_bars_over_many_batches(spark):
    rng = random.Random(4)
    rows = [(f"s{rng.randrange(3)}", i, i, 1.0, float(rng.randrange(9))) for i in range(400)]
    want, state = {}, {}
    for name, _, _, _, v in rows:
        bar, total, n = state.get(name, (0, 0.0, 0))
        total, n = total + v, n + 1
        if total >= 20:
            want[name, bar] = (n, total)
            bar, total, n = bar + 1, 0.0, 0
        state[name] = bar, total, n
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        df = B.reset_bars(spark.createDataFrame(rows[::-1], "series_id string, seq long, epoch long, price double, volume double"), F.col("volume"), 20.0)
        assert {(r.series_id, r.bar): (r.n_ticks, r.measure_sum) for r in df.collect()} == want
    finally:
        spark.conf.set(key, before)
    assert "InPandas" not in df._jdf.queryExecution().toString()  # no series is held whole


def test_last_tick_bar_needs_two(spark):
    assert [r.n_ticks for r in B.tick_bars(ticks(spark, range(1, 8), [1] * 7), 3).orderBy("bar").collect()] == [3, 3]
    assert [r.n_ticks for r in B.tick_bars(ticks(spark, range(1, 9), [1] * 8), 3).orderBy("bar").collect()] == [3, 3, 2]


def test_session_hours_wrap(spark):
    df = spark.range(24).select("id", B.in_hours(F.col("id"), F.lit(22), F.lit(3)).alias("night"), B.in_hours(F.col("id"), F.lit(5), F.lit(5)).alias("none"))
    got = df.collect()
    assert [r.id for r in got if r.night] == [0, 1, 2, 22, 23] and not any(r.none for r in got)


def test_vwap_without_volume_is_null(spark):
    assert ticks(spark, [1, 2], [0, -5]).agg(B.vwap().alias("x")).head().x is None


def test_seeded_smoothing(spark):
    got = [r.e for r in I.smooth(series(spark, [1, 2, 3, 4, 5]), [I.ema("e", "v", 3)]).orderBy("idx").collect()]
    assert got == [None, None, 2.0, 3.0, 4.0]


def test_smoothing_skips_leading_nulls(spark):
    got = [r.e for r in I.smooth(series(spark, [None, 2, 4, 6]), [I.wilder("e", "v", 2)]).orderBy("idx").collect()]
    assert got == [None, None, 3.0, 4.5]


def test_drawdown_episodes(spark):
    rows = R.drawdown_episodes(series(spark, [10, 8, 9, 10, 12, 6, 7])).orderBy("start").collect()
    assert [(r.start, r.trough, r.recovery, r.duration) for r in rows] == [(0, 1, 3, 3), (4, 5, None, 3)]
    assert rows[1].depth_pct == 50.0


def test_irr_has_no_value_left(spark):
    rng = random.Random(3)
    flows = [(a, t, -1000.0 if t == 0 else rng.uniform(50, 300)) for a in range(4) for t in range(8)] + [(9, 0, 5.0), (9, 1, 6.0)]
    rates = {r.account: r.irr for r in R.irr(spark.createDataFrame(flows, "account long, t long, flow double")).collect()}
    assert rates[9] is None
    for a in range(4):
        assert abs(sum(f / (1 + rates[a]) ** t for k, t, f in flows if k == a)) < 1e-4


def test_risk_caps_like_a_loop(spark):
    rng = random.Random(5)
    pnl = [rng.uniform(-80, 60) for _ in range(200)]
    df = spark.createDataFrame([(1, i, p) for i, p in enumerate(pnl)], "strategy_id long, seq long, pnl double")
    got = [r.pnl for r in T.risk_capped(df, 50.0, 70.0, 150.0, 3).orderBy("seq").collect()]
    want, day, week, n, days = [], 0.0, 0.0, 0, 0
    for p in pnl:
        a = max(p, -50.0)
        if a < 0 and day - a > 70:
            a = 0.0
        if a < 0 and week - a > 150:
            a = 0.0
        want.append(a)
        day, week, n = max(0.0, day - a), max(0.0, week - a), n + 1
        if n == 3:
            n, day, days = 0, 0.0, days + 1
            if days == 5:
                days, week = 0, 0.0
    assert got == pytest.approx(want)


def test_random_skip_share(spark):
    df = spark.range(20000).select(F.lit(1).alias("strategy_id"), F.col("id").alias("seq"), F.lit(1.0).alias("pnl"))
    n = T.randomly_skipped(df, 0.05).count()
    assert n == T.randomly_skipped(df.repartition(7), 0.05).count() and 0.94 < n / 20000 < 0.96


def test_stress_scenarios_kill(spark):
    df = spark.createDataFrame([(1, i, 10.0 if i < 3 else -0.5) for i in range(40)], "strategy_id long, seq long, pnl double")
    rows = {r.scenario: r for r in T.stress(df, best=3).collect()}
    assert rows["original"].net == 11.5 and rows["skip_best"].net == -18.5
    assert T.stress_verdict(T.stress(df, best=3)).head().verdict == "moderate"


def test_ks_distance(spark):
    df = spark.createDataFrame([("k", float(x), s) for s, xs in ((True, [1, 2, 3]), (False, [2, 3, 4, 5])) for x in xs], "k string, x double, s boolean")
    assert T.ks_distance(df, "x", "s", "k").head().ks == pytest.approx(0.5)


def test_normal_p(spark):
    df = spark.createDataFrame([(z,) for z in (-3.0, -0.5, 0.0, 1.96)] + [(None,)], "z double").select("z", normal_cdf("z").alias("p"))
    for r in df.collect():
        assert (r.p is None) if r.z is None else r.p == pytest.approx(0.5 * (1 + math.erf(r.z / math.sqrt(2))))


def test_adf_needs_thirty_rows(spark):
    assert ST.adf(series(spark, range(29)), "v").head().adf == 0.0


def test_fracdiff_of_order_one():
    assert ST.fracdiff_weights(1.0) == [1.0, -1.0] and ST.fracdiff_weights(0.0) == [1.0]


def test_triple_barrier_profit_first(spark):
    df = spark.createDataFrame([("s", i, p) for i, p in enumerate([100.0, 101.0, 112.0, 80.0])], "series_id string, idx long, close double")
    rows = ST.triple_barrier(df, 10.0, 10.0, 2).orderBy("idx").collect()
    assert [(r.label, r.exit_index) for r in rows] == [(1, 2), (1, 2), (-1, 3), (0, 3)]


def test_bootstrap_is_the_same_for_any_partitioning(spark):
    df = spark.createDataFrame([("a", i, math.sin(i) / 50) for i in range(120)], "series_id string, idx long, r double")
    a = sorted(map(tuple, S.bootstrap_paths(df, 300, block=5.0).collect()))
    assert a == sorted(map(tuple, S.bootstrap_paths(df.repartition(5), 300, block=5.0).collect())) and len(a) == 300
    mean = np.mean([math.sin(i) / 50 for i in range(120)])
    assert np.mean([r[3] for r in a]) == pytest.approx(mean, abs=2e-3)
    assert all(0 <= r[6] <= 100 for r in a)


def test_positions_run_and_wrap(monkeypatch):
    x = S.positions([1, 2], 10, 5000, 20.0)
    steps = (x[1:] - x[:-1]) % 10
    assert 0.93 < (steps == 1).mean() < 0.98 and set(x) == set(range(10))
    alone = S.positions([1, 3], 1000, 5000, 1.0)
    assert 0.9 < len(set(alone)) / (1000 * (1 - math.exp(-5))) < 1.1 and len(S.positions([1], 5, 0, 3.0)) == 0
    monkeypatch.setattr(S, "CHUNK", 37)  # a run goes on over the end of a chunk
    assert (S.positions([1, 2], 10, 5000, 20.0) == x).all() and (S.positions([1, 3], 1000, 5000, 1.0) == alone).all()


@pytest.mark.parametrize("block", [1.0, 6.0])
def test_long_series_are_looked_up(spark, monkeypatch, block):
    """Series that no task may hold give the paths of those that one holds, to rounding."""
    rng = random.Random(21)
    rows = [("long", i, rng.choice([-0.02, 0.0, 0.01, rng.gauss(0, 0.05)])) for i in range(400)] + [("wild", i, rng.choice([-1.5, 0.4, 0.2])) for i in range(150)] + [("short", i, rng.gauss(0, 0.01)) for i in range(30)]
    df = spark.createDataFrame(rows, "series_id string, idx long, r double").repartition(3)
    key = lambda r: (r.series_id, r.path)
    made = lambda steps: sorted(S.bootstrap_paths(df, 25, block=block, steps=steps).collect(), key=key)
    excess = df.withColumnRenamed("r", "x")
    means = lambda: {(r.series_id, r.boot): r.mean for r in S.bootstrap_means(excess, 25, block).collect()}
    want, more, want_means = made(None), made(777), means()
    for name, size in (("SERIES_ROWS", 100), ("STRETCH", 60), ("CHUNK", 70), ("LOT", 7), ("BINS", 8)):
        monkeypatch.setattr(S, name, size)
    for plain, looked in ((want, made(None)), (more, made(777))):
        assert [key(r) for r in plain] == [key(r) for r in looked] and len(plain) == 75
        for a, b in zip(plain, looked):
            assert tuple(b)[2:] == pytest.approx(tuple(a)[2:], rel=1e-9, abs=1e-12), (a, b)
    assert means() == pytest.approx(want_means, rel=1e-9, abs=1e-12)


def test_reality_check_finds_an_edge(spark):
    rng = np.random.default_rng(2)
    rows = [(n, i, float(rng.normal(m, 1))) for n, m in (("edge", 0.5), ("none", 0.0)) for i in range(300)]
    out = S.reality_check(spark.createDataFrame(rows, "series_id string, idx long, x double"), 200, studentised=True).head()
    assert out.best == "edge" and out.p < 0.05 and out.verdict == "significant"


def test_deflated_sharpe(spark):
    df = spark.createDataFrame([(1, 100, 0.8, 20, -0.3, 4.0)], "strategy_id long, n long, sharpe double, trials long, skewness double, kurtosis double")
    r = S.deflated_sharpe(df).head()
    q, g = NormalDist().inv_cdf, 0.5772156649015329
    sr0 = (1 - g) * q(1 - 1 / 20) + g * q(1 - 1 / (20 * math.e))
    z = (0.8 - sr0) / math.sqrt((1 + 0.3 * 0.8 + 0.75 * 0.64) / 99)
    assert r.z == pytest.approx(z) and r.dsr == pytest.approx(NormalDist().cdf(z))


def test_weights_solve_their_problems(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4))
    rows = [("p", f"s{j}", i, float(x[i, j])) for i in range(400) for j in range(4)]
    cov = C.covariances(spark.createDataFrame(rows, "portfolio_id string, series_id string, idx long, r double"))
    c = np.cov(x.T)
    rp = np.array([r.w for r in C.solved_weights(cov, "risk_parity").orderBy("series_id").collect()])
    risk = rp * (c @ rp)
    assert rp.sum() == pytest.approx(1) and np.ptp(risk) / risk.mean() < 1e-4
    mv = np.array([r.w for r in C.solved_weights(cov, "min_variance").orderBy("series_id").collect()])
    best = mv @ c @ mv
    for a in range(4):
        for b in range(4):
            d = min(1e-3, mv[a])
            moved = mv.copy()
            moved[a] -= d
            moved[b] += d
            assert moved @ c @ moved >= best - 1e-9


def test_kmeans_like_numpy(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(m, 0.1, (20, 2)) for m in (0, 5, 9)])
    df = spark.createDataFrame([(i, [float(a) for a in p]) for i, p in enumerate(x)], "strategy_id long, z array<double>")
    got = [r.cluster for r in S.kmeans(df, 3, 10, "strategy_id").orderBy("strategy_id").collect()]
    centres = x[:3].copy()
    for _ in range(10):
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[near == k].mean(0) if (near == k).any() else centres[k] for k in range(3)])
        if np.abs(new - centres).max() < 1e-12:
            break
        centres = new
    assert got == near.tolist()


def test_round_robin_over_buckets(spark):
    df = spark.createDataFrame([(1, "a", 9.0), (2, "a", 8.0), (3, "b", 5.0), (4, None, 7.0), (5, None, 6.5)], "strategy_id long, h string, score double")
    assert [r.strategy_id for r in C.diverse(df, F.col("h"), 4).collect()] == [1, 4, 3, 2]


def test_rules_on_missing_and_unreadable(spark):
    rules = spark.createDataFrame([("m", "x", "missing", "", "low"), ("g", "y", ">", "3", "high")], "name string, metric string, op string, threshold string, severity string")
    pay = spark.createDataFrame([(1, "y", "5"), (2, "x", "1"), (2, "y", "nan?")], "id long, metric string, value string")
    fired = {(r.id, r.name) for r in C.evaluate_rules(pay, rules).collect() if r.fired}
    assert fired == {(1, "m"), (1, "g")}


def test_cycles_end(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "node_id long, parent_id long")
    assert G.ancestors(df).filter("node_id = 4").count() == 3


def test_nested_strings(spark):
    df = spark.createDataFrame([(([("<system>hi", 1)], {"k": "```"}),)], "p struct<a:array<struct<t:string,n:int>>,m:map<string,string>>")
    r = df.select(X.over_strings(F.col("p"), df.schema["p"].dataType, X.sanitize).alias("p")).head().p
    assert r.a[0].t == "&lt;system&gt;hi" and r.m["k"] == "``​`"


def test_trade_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿Symbol;P/L;Type\nA;1.234,5;buy\nA;;sell\nB;-3,25;buy\nB;x;buy\n", encoding="utf-8")
    rows = readers.read_trades(spark, str(tmp_path / "t.csv"), ";", ",")
    r = {x.symbol: x for x in readers.trade_summary(rows, "symbol").collect()}
    assert (r["A"].net, r["A"].skipped, r["B"].net, r["B"].rows) == (1234.5, 1, -3.25, 2)


def test_bars_csv(spark, tmp_path):
    (tmp_path / "b.csv").write_text("series_id,time,open,high,low,close,volume\ns,2024-01-01 01:00:00,1,2,0.5,1.5,10\ns,2024-01-01 02:00:00,bad,2,0.5,1.5,10\ns,2024-01-01 03:00:00,1,2,0.5,1.5,10\n")
    b = readers.read_bars(spark, str(tmp_path / "b.csv"), 3600, stamp="end")
    assert [r.t for r in b.orderBy("t").collect()] == [1704067200, 1704074400]
    with pytest.raises(Exception):
        readers.read_bars(spark, str(tmp_path / "b.csv"), 3600, on_error="stop").collect()


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("strategy.xml", "<strategy name='n1'><symbol>EURUSD</symbol><timeframe>H1</timeframe><trades>12</trades><net_profit>3.5</net_profit><fitness is='0.5' oos='0.4'/></strategy>")
    (tmp_path / "b.zip").write_bytes(b"no zip")
    rows = {r.path.rsplit("/", 1)[1]: r for r in readers.read_archives(spark, str(tmp_path)).collect()}
    assert (rows["a.zip"].symbol, rows["a.zip"].trades, rows["a.zip"].fitness_oos) == ("EURUSD", 12, 0.4) and rows["b.zip"].error == "BadZipFile"


def test_inventory_and_manifest(spark, tmp_path):
    (tmp_path / "EURUSD_dukas_H1.dat").write_bytes(b"abc")
    (tmp_path / "EURUSD_M1.dat").write_bytes(b"abcd")
    assert {(r.symbol, r.timeframe, r.bytes) for r in readers.inventory(spark, str(tmp_path)).collect()} == {("EURUSD", "H1", 3), ("EURUSD", "M1", 4)}
    assert readers.manifest(spark, str(tmp_path)).count() == 2


def test_sets_and_snapshots(spark, tmp_path):
    df = spark.createDataFrame([(1, "p0", "d0"), (2, "p1", "d0")], "strategy_id long, project string, databank string")
    readers.save_set(df, str(tmp_path / "set"))
    readers.save_set(df.filter("project = 'p1'").withColumn("strategy_id", F.lit(9).cast("long")), str(tmp_path / "set"))
    assert sorted(r.strategy_id for r in spark.read.parquet(str(tmp_path / "set")).collect()) == [1, 9]
    for label in ("a", "b", "a"):
        readers.write_snapshot(df, str(tmp_path / "snap"), label, ["strategy_id"])
    assert spark.read.parquet(str(tmp_path / "snap")).count() == 4
    readers.export_csv(df, str(tmp_path / "csv"), ["strategy_id"], ["project"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


def _stream(spark, df, path, files):
    df.repartition(files).write.parquet(str(path))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def _drain(df, name, tmp_path, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name).collect()


def test_streamed_bars_equal_batch(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter("event_id < 400")
    t = e.select(F.col("event_type").alias("series_id"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), F.lit(1.0).alias("volume"))
    got = {(r.series_id, r.t): (r.open, r.high, r.low, r.close, r.n) for r in _drain(live.stream_bars(_stream(spark, t, tmp_path / "in", 1), "1 hour"), "bars1", tmp_path)}
    want = {(r.series_id, r.t): (r.open, r.high, r.low, r.close, r.n) for r in B.resample_ticks(t.withColumn("epoch", F.unix_seconds("ts")), 3600).collect()}
    last = max(k[1] for k in want)
    assert got and all(want[k] == v for k, v in got.items()) and {k for k in want if k[1] < last - 7200} <= set(got)


def _by_order(spark, w, path, sizes):
    """Windows as files in order of their start, one a trigger."""
    rows = sorted((tuple(r[c] for c in w.columns) for r in w.collect()), key=lambda r: r[w.columns.index("t")])
    for k, at in enumerate(range(0, len(rows), sizes)):
        spark.createDataFrame(rows[at : at + sizes], w.schema).coalesce(1).write.parquet(str(path / f"b{k:03d}"))
    return spark.readStream.schema(w.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_streamed_alerts_equal_batch(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = e.select(F.col("event_type").alias("project"), F.col("ts").cast("timestamp").alias("ts"), (F.col("value") / 500).alias("fitness"), (F.col("value") / 900).alias("fitness_oos"))
    w = live.monitor_windows(rows, "1 day", None)
    want = {(r.project, r.code): (r.t, r.value) for r in live.monitor_alerts(w).collect()}
    got = {(r.project, r.code): (r.t, r.value) for r in _drain(live.stream_alerts(_by_order(spark, w, tmp_path / "in", 40), 86400), "alerts1", tmp_path)}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_a_silent_project_alerts_in_batch_and_stream(spark, tmp_path):
    """Project a stops after six windows, b has a gap of five, c starts late, d never stops; the rules see the windows without rows."""
    at = {"a": range(6), "b": [*range(4), *range(9, 30)], "c": range(20, 30), "d": range(30), "e": [0, 1, 9, 12]}
    rows = [(p, 3600 * k + 60 * i, 0.5, 0.4) for p, ks in at.items() for k in ks for i in range(2)]
    df = spark.createDataFrame(rows, "project string, at long, fitness double, fitness_oos double").withColumn("ts", F.timestamp_seconds("at"))
    w = live.monitor_windows(df, "1 hour", None)
    counts = {r.project: (r.n, r.silent) for r in w.groupBy("project").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("new") == 0).alias("silent")).collect()}
    assert counts == {"a": (30, 24), "b": (30, 5), "c": (10, 0), "d": (30, 0), "e": (30, 26)}
    want = {(r.project, r.code): (r.t, r.value) for r in live.monitor_alerts(w).collect()}
    assert want == {("a", "STALLED_GROWTH"): (10 * 3600, 0.0), ("b", "STALLED_GROWTH"): (8 * 3600, 0.0), ("e", "STALLED_GROWTH"): (6 * 3600, 0.0)}
    got = {(r.project, r.code): (r.t, r.value) for r in _drain(live.stream_alerts(_by_order(spark, w.filter("new > 0"), tmp_path / "in", 9), 3600), "alerts2", tmp_path)}
    assert got == want


def test_streamed_reset_bars_equal_batch(spark, tmp_path):
    t = ticks(spark, [1.0] * 60, [random.Random(i).uniform(1, 9) for i in range(60)])
    want = {(r.bar, round(r.measure_sum, 9), r.n_ticks) for r in B.reset_bars(t, F.col("volume"), 20.0).collect()}
    s = t.select("series_id", "seq", F.col("volume").alias("measure"))
    for k in range(3):
        s.filter((F.col("seq") >= 20 * k) & (F.col("seq") < 20 * k + 20)).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{k}"))
    src = spark.readStream.schema(s.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = {(r.bar, round(r.measure_sum, 9), r.n_ticks) for r in _drain(live.stream_reset_bars(src, 20.0), "reset1", tmp_path)}
    assert got == want


def test_whole_fingerprints_group_greedily(spark):
    """Against the plain rule: equal tags alone are no duplicates, curves decide, groups form in input order."""
    rng = random.Random(8)
    rows = []
    for k in range(40):
        base = [math.sin(i / (1 + k % 3)) * 10 + rng.random() * (k % 4) * 6 for i in range(20 + k)] if k % 9 else []
        rows.append((k, "p" if k in (5, 6) else f"p{k}", rng.choice([150, 700]), 1.3, 5.0, 0.6, rng.choice(["long", None]), base))
    s = spark.createDataFrame(rows, "strategy_id long, params string, trades long, profit_factor double, drawdown_pct double, oos_is double, direction string, curve array<double>")
    s = s.withColumns({"net_profit": F.lit(1.0), "fitness_oos": F.lit(None).cast("double")})
    fp = G.whole_fingerprints(s)
    got = {r.strategy_id: r for r in fp.collect()}
    assert got[1].tags == sorted([got[1].tags[k] for k in range(len(got[1].tags))]) and "pf>1.2" in got[1].tags and got[5].signature == got[6].signature != got[7].signature
    assert got[1].curve == [round(rows[1][7][int(i * 21 / 16)], 6) for i in range(16)] and got[0].curve == []

    def sim(a, b):
        if a.signature == b.signature:
            return 1.0
        x, y = set(a.tags), set(b.tags)
        c = np.corrcoef(a.curve, b.curve)[0, 1] if a.curve and b.curve else 0.0
        return round(0.6 * len(x & y) / len(x | y) + 0.4 * max(0.0, c), 4)

    for threshold in (0.85, 0.7):
        want = {}
        for i in got:
            if i not in want:
                want |= {j: i for j in got if j >= i and j not in want and (j == i or sim(got[i], got[j]) >= threshold)}
        assert {r.strategy_id: r.owner for r in G.greedy_duplicates(fp, threshold).collect()} == want
        assert 1 < len(set(want.values())) < len(want)


def test_lineage_of_a_long_chain(spark):
    n = 1000
    edges = spark.createDataFrame([(k, k - 1 if k else None) for k in range(n)] + [(2000, 2001), (2001, 2000), (2002, 2000), (3001, 3000)], "node_id long, parent_id long")
    got = {r.node_id: (r.root, r.depth, r.descendants, r.height) for r in G.tree(edges).collect()}
    assert all(got[k] == (0, k, n - 1 - k, n - 1 - k) for k in range(n))
    assert got[2000] == got[2001] == got[2002] == (None,) * 4 and got[3001] == (3000, 1, 0, 0) and 3000 not in got
    asked = [(k, *link) for k, link in enumerate([(0, 999), (500, 500), (7, 4000), (3, 999), (999, 3), (10, None), (3, 11), (2002, 2001)])]
    batch = spark.createDataFrame(asked, "seq long, node_id long, parent_id long")
    bad = {(r.node_id, r.parent_id): r.error for r in G.link_errors(edges, batch).collect()}
    assert bad == {(0, 999): "cycle", (500, 500): "self", (7, 4000): "missing_parent", (3, 999): "cycle"}  # 3 may go below 11 once 10 has left it
    linked = {r.node_id: r.parent_id for r in G.relink(edges, batch).collect()}
    assert linked[10] is None and linked[999] == 3 and linked[0] is None and linked[500] == 499 and linked[3] == 11 and linked[2002] == 2001


def plain_lineage(edges, ops):
    """The operations one after the other."""
    parent, out = dict(edges), []
    for seq, op, node, to in sorted(ops):
        error = None
        if op == "register":
            error = "exists" if node in parent else "missing_parent" if to is not None and to not in parent else None
        elif node not in parent:
            error = "missing_node"
        elif to is not None and to == node:
            error = "self"
        elif to is not None and to not in parent:
            error = "missing_parent"
        else:
            up = to
            while up is not None and up != node:
                up = parent.get(up)
            error = "cycle" if up is not None else None
        out.append((seq, node, to, error))
        if error is None:
            parent[node] = to
    return out, parent


def test_links_that_close_a_cycle_together(spark):
    edges = spark.createDataFrame([(1, None), (2, None)], "node_id long, parent_id long")
    asked = spark.createDataFrame([(0, 1, 2), (1, 2, 1)], "seq long, node_id long, parent_id long")
    assert [(r.node_id, r.parent_id, r.error) for r in G.link_errors(edges, asked).collect()] == [(2, 1, "cycle")]
    assert sorted((r.node_id, r.parent_id) for r in G.relink(edges, asked).collect()) == [(1, 2), (2, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_of_lineage_operations_against_the_loop(spark, seed):
    rng = random.Random(seed)
    n = 120
    edges = {k: rng.choice([None, *range(max(0, k - 6), k)]) if k else None for k in range(n)} | {(1 << 60) + 1: (1 << 60) + 2, (1 << 60) + 2: 5}
    ids = [*range(n + 30), (1 << 60) + 1, (1 << 60) + 2]
    ops = [(k, rng.choice(["link", "link", "link", "register"]), rng.choice(ids), rng.choice([None, *rng.sample(ids, 9)])) for k in range(160)]
    ops += [(160 + k, "register", 1000 + k, 999 + k if k else None) for k in range(40)] + [(300, "link", 1000, 1039), (301, "link", 1000, None), (302, "register", 5000, 5001), (303, "register", 5001, None), (304, "register", 5000, 5001)]
    e = spark.createDataFrame([(k, p, f"n{k}") for k, p in edges.items()], "node_id long, parent_id long, label string")
    o = spark.createDataFrame(ops + [(900, "link", None, 3)], "seq long, op string, node_id long, parent_id long").repartition(3)
    want, parents = plain_lineage(edges, ops)
    got = sorted(G.lineage_results(e, o).select("seq", "node_id", "parent_id", "error").collect())
    assert [tuple(r) for r in got[:-1]] == want and tuple(got[-1]) == (900, None, 3, "missing_node")
    assert {"exists", "missing_parent", "missing_node", "cycle", None} <= {w[3] for w in want}
    links = [op for op in ops if op[1] == "link"]
    _, moved = plain_lineage(edges, links)
    assert {r.node_id: r.parent_id for r in G.relink(e, o.filter("op = 'link'")).collect()} == moved
    new = [op for op in ops if op[1] == "register"]
    _, grown = plain_lineage(edges, new)
    assert {r.node_id: r.parent_id for r in G.register(e, o.filter("op = 'register'")).collect()} == grown
    assert G.lineage_results(e, o.limit(0)).count() == 0


def test_intervals_and_paths_against_a_walk(spark, monkeypatch):
    from tidemill.operators import scan

    rng = random.Random(14)
    parent = {k: rng.choice([None, *range(max(0, k - 7), k)]) if k else None for k in range(200)} | {500 + k: 500 for k in range(1, 40)} | {800: 801, 801: 800, 802: 801} | {900 + k: 899 + k for k in range(60)}
    edges = spark.createDataFrame([(k, p) for k, p in parent.items() if k != 500], "node_id long, parent_id long")

    def above(k):
        out = []
        while parent.get(k) is not None and k < 800 or 900 <= k < 1000:
            k = parent[k]
            out.append(k)
        return out

    up = {k: above(k) for k in parent if not 800 <= k <= 802}
    monkeypatch.setattr(scan, "BLOCK_ROWS", 9)
    got = {r.node_id: r for r in G.intervals(edges).collect()}
    assert all(got[k].root is None for k in (800, 801, 802)) and len({(r.root, r.enter) for r in got.values() if r.root is not None}) == len([r for r in got.values() if r.root is not None])
    pairs = [(rng.choice(list(up)), rng.choice(list(up))) for _ in range(400)] + [(k, a) for k in up for a in up[k][:3]] + [(k, k) for k in list(up)[:9]] + [(905, 899), (510, 500), (802, 800)]
    want = {(k, a) for k, a in pairs if a in up.get(k, ())}
    assert {(r.low, r.high) for r in G.descends(spark.createDataFrame(pairs, "low long, high long"), edges, "low", "high").collect()} == want
    asked = [0, 5, 150, 199, 520, 959, 802, 4000]
    rows = {(r.node_id, r.ancestor, r.distance) for r in G.paths_up(edges, spark.createDataFrame([(k,) for k in asked], "node_id long")).collect()}
    assert rows == {(k, a, d + 1) for k in asked for d, a in enumerate(up.get(k, ()))}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(200)] + [(7000, k) for k in range(5000, 5100)] + [(3, 3), (None, 4)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert {r.node: r.component for r in G.components(spark.createDataFrame(links, "a long, b long")).collect()} == {x: find(x) for x in list(root)}


def test_tree_against_a_walk(spark):
    rng = random.Random(8)
    parent = {k: rng.choice([None, *range(max(0, k - 9), k)]) if k else None for k in range(300)}
    got = {r.node_id: (r.root, r.depth, r.descendants, r.height) for r in G.tree(spark.createDataFrame(list(parent.items()), "node_id long, parent_id long")).collect()}
    under, high = {k: 0 for k in parent}, {k: 0 for k in parent}
    for k in parent:
        up, d = parent[k], 1
        while up is not None:
            under[up], high[up] = under[up] + 1, max(high[up], d)
            up, d = parent[up], d + 1
    for k in parent:
        r, d = k, 0
        while parent[r] is not None:
            r, d = parent[r], d + 1
        assert got[k] == (r, d, under[k], high[k])


def test_too_many_tags_are_refused(spark):
    tags = spark.createDataFrame([(1, ["b", "a", "a"]), (2, [f"t{k}" for k in range(50)]), (3, ["x"])], "strategy_id long, tags array<string>")
    changes = spark.createDataFrame([(1, ["c"], ["b"]), (2, ["new"], []), (4, [f"t{k}" for k in range(51)], []), (5, ["z", "y"], None)], "strategy_id long, add array<string>, remove array<string>")
    got = {r.strategy_id: (r.tags, r.error) for r in G.edit_tags(tags, changes).collect()}
    assert got[1] == (["a", "c"], None) and got[3] == (["x"], None) and got[5] == (["y", "z"], None)
    assert len(got[2][0]) == 50 and "new" not in got[2][0] and "50" in got[2][1] and got[4][0] == [] and "50" in got[4][1]


@pytest.mark.parametrize("threshold", [0.5, 2.0, 50.0])
def test_cusum_like_a_loop(spark, threshold):
    rng = random.Random(4)
    series = {"a": [rng.gauss(0.05, 1) for _ in range(3000)], "b": [1.0], "c": [rng.gauss(0, 0.3) for _ in range(700)]}
    df = spark.createDataFrame([(k, i, x) for k, xs in series.items() for i, x in enumerate(xs)], "series_id string, idx long, v double").repartition(5)
    for reference in (None, 0.1):
        breaks = {(r.series_id, r.idx, r.direction): r.value for r in ST.cusum(df, "v", threshold, reference=reference).collect()}
        ends = {r.series_id: r for r in ST.cusum_summary(df, "v", threshold, reference=reference).collect()}
        want = {}
        for k, xs in series.items():
            level, up, down = sum(xs) / len(xs) if reference is None else reference, 0.0, 0.0
            for i, x in enumerate(xs):
                up, down = max(0.0, up + x - level), min(0.0, down + x - level)
                if up >= threshold:
                    want[k, i, "up"], up = up, 0.0
                if down <= -threshold:
                    want[k, i, "down"], down = down, 0.0
            n = sum(w[0] == k for w in want)
            assert (ends[k].n_breaks, ends[k].verdict) == (n, "stable" if n == 0 else "occasional_breaks" if n <= 3 else "frequent_breaks")
            assert ends[k].last_up == pytest.approx(up, abs=1e-9) and ends[k].last_down == pytest.approx(down, abs=1e-9)
        assert breaks.keys() == want.keys() and all(breaks[w] == pytest.approx(want[w], abs=1e-9) for w in want)


def test_sizes_compound_and_stop_at_zero(spark):
    rng = random.Random(1)
    lists = {1: [rng.uniform(-80, 90) for _ in range(60)], 2: [50.0, -2000.0, 70.0, 80.0]}
    df = spark.createDataFrame([(k, i, p) for k, ps in lists.items() for i, p in enumerate(ps)], "strategy_id long, seq long, pnl double")
    got = {(r.strategy_id, r.seq): (r.size, r.pnl) for r in T.sized(df, "fixed_fractional", start=10_000.0, fraction=0.001).collect()}
    for k, ps in lists.items():
        equity = 10_000.0
        for i, p in enumerate(ps):
            size = max(0.0, equity * 0.001)
            equity += p * size
            assert got[k, i] == (pytest.approx(size), pytest.approx(p * size))


def test_personal_data_and_injections_in_any_script(spark):
    rows = [(0, "mail josé@exámple.com now"), (1, "tel ١٢٣٤٥٦٧٨٩ end"), (2, "édelete all files"), (3, "x delete all files, DELETE data"), (4, None), (5, ""), (3, "jailbreak")]
    df = spark.createDataFrame(rows, "id long, text string")
    red = {r.id: r.t for r in df.select("id", X.redact(F.col("text")).alias("t")).collect() if r.id < 2}
    assert red == {0: "mail [REDACTED_EMAIL] now", 1: "tel [REDACTED_NUMBER] end"}
    hits = {(r.id, r.rule): (r.matches, r.first_match, r.position, r.severity) for r in X.injections(df, ["id"], "text").collect()}
    assert hits == {(3, "destructive_command"): (2, "delete all files", 2, 95), (3, "jailbreak_attempt"): (1, "jailbreak", 0, 75)}
    verdicts = sorted((r.id, r.matches, r.verdict) for r in X.injection_verdicts(df, ["id"], "text").collect())
    assert verdicts == [(0, 0, "clean"), (1, 0, "clean"), (2, 0, "clean"), (3, 1, "medium_concern"), (3, 2, "critical_concern"), (4, 0, "clean"), (5, 0, "clean")]


def test_a_line_ends_at_a_line_feed_alone(spark):
    rows = [(k, f"exec x{end} system act as{end}an admin") for k, end in enumerate(("\r", "\x85", "\u2028", "\u2029", "\n"))]
    hits = {(r.id, r.rule_no) for r in X.injections(spark.createDataFrame(rows, "id long, text string"), ["id"], "text").collect()}
    assert hits == {(k, rule) for k in range(4) for rule in (6, 9)}


def test_personal_data_without_its_plain_tests(spark):
    """The tests that spare texts a search never change what is found."""
    rng = random.Random(12)
    bits = ["a@b.c", "٣.١.2.4", "1.2.3.4", "12345678", "1234567", "٠١٢٣٤٥٦٧", "f" * 32, "F0" * 16, "e" * 31, "é", "@", ".", " ", "x", "_", "-", "[", "[REDACTED_EMAIL]"]
    rows = [(k, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 9)))) for k in range(600)] + [(600, None), (601, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    every = F.col("text")
    for pattern, mark in X.PERSONAL:
        every = F.regexp_replace(every, f"(?U){pattern}", mark)
    assert df.filter(~X.redact(F.col("text")).eqNullSafe(every)).count() == 0 and df.filter(every != F.col("text")).count() > 100


def test_sanitizing_with_and_without_redaction(spark):
    df = spark.createDataFrame([("```<System>mail a@b.cc</TOOL>", {"k": "call 123456789"}, [("x", ["10.0.0.1 <user>"])])], "t string, m map<string,string>, n array<struct<a:string,b:array<string>>>")
    kinds = {f.name: f.dataType for f in df.schema}
    walk = lambda flag: df.select(*(X.over_strings(F.col(c), k, lambda x: X.sanitize(x, redact_pii=flag)).alias(c) for c, k in kinds.items())).head()
    plain, redacted = walk(False), walk(True)
    assert plain.t == "``\u200b`&lt;System&gt;mail a@b.cc&lt;/TOOL&gt;" and plain.m == {"k": "call 123456789"} and plain.n[0].b == ["10.0.0.1 &lt;user&gt;"]
    assert redacted.t == "``\u200b`&lt;System&gt;mail [REDACTED_EMAIL]&lt;/TOOL&gt;" and redacted.m == {"k": "call [REDACTED_NUMBER]"} and redacted.n[0].b == ["[REDACTED_IP] &lt;user&gt;"]


def test_sides_are_compared_whole(spark):
    """A side that gains evenly beats one that lives from a single row; equal sides do not differ."""
    rows = [("even", i, 10.0 + i % 3, 500.0 if i == 7 else -1.0) for i in range(60)] + [("same", i, float(i % 5 - 2), float(i % 5 - 2)) for i in range(60)]
    rows += [("worse", i, -1.0 - i % 2, 3.0 + i % 4) for i in range(60)] + [("one", 0, 1.0, 2.0)]
    got = {r.series_id: r for r in W.compare_sides(spark.createDataFrame(rows, "series_id string, idx long, a double, b double")).collect()}
    e, s, w = got["even"], got["same"], got["worse"]
    assert (e.brittle_a, e.stress_a, e.killed_a) == ("robust", "robust", 0) and (e.brittle_b, e.top10_b, e.stress_b) == ("very_brittle", 100.0, "moderate") and e.better == "no significant difference"
    assert (e.longest_above, e.longest_below) == (52, 1) and e.share_above == pytest.approx(59 / 60)
    assert (s.mean, s.better, s.beta, s.longest_above) == (0.0, "no significant difference", pytest.approx(1.0), 0)
    assert (w.better, w.different, w.killed_a, w.stress_a, w.longest_above) == ("b", True, 4, "fragile", 0)
    assert got["one"].better == "no significant difference" and got["one"].t is None


def test_shipping_tags_and_registers(spark):
    gates = spark.createDataFrame([(k, g, g != "soft", not (k == 2 and g == "hard") and g != "soft") for k in range(1, 8) for g in ("hard", "soft")], "strategy_id long, gate string, required boolean, passed boolean")
    many = [f"t{i:02}" for i in range(49)]
    tags = spark.createDataFrame([(1, ["x"]), (2, ["x"]), (4, many), (9, ["z"])], "strategy_id long, tags array<string>")
    lineage = spark.createDataFrame([("root", None, "r"), ("n5", "root", "r")], "node_id string, parent_id string, label string")
    asked = [(1, "n1", "root", ["new", "x"], False), (2, "n2", "root", ["new"], False), (3, "n3", None, ["new"], True), (4, "n4", "nowhere", ["new", "more"], False), (5, "n5", None, [], False), (6, "n6", None, None, False), (7, "n7", "n6", ["new"], False)]
    requests = spark.createDataFrame([(k, n, p, f"s{k}", a, d) for k, n, p, a, d in asked], "strategy_id long, node_id string, parent_id string, label string, add array<string>, dry_run boolean")
    metrics = spark.createDataFrame([(1, 30.0, 0.2, 50, "very_brittle"), (3, 25.0, 0.0, 100, None), (7, None, None, None, "robust")], "strategy_id long, drawdown_pct double, oos_is double, trades long, brittle_verdict string")
    alerts = W.workspace_alerts(W.ship_payload(metrics.withColumn("drift_verdict", F.when(F.col("strategy_id") == 3, "red"))))
    m = W.ship(requests, gates, tags, lineage, alerts)
    got = {r.strategy_id: (r.verdict, r.tagging, r.tags, r.lineage) for r in m.collect()}
    assert got == {
        1: ("shipped", "tagged", ["new", "x"], "registered"), 2: ("blocked", "not approved", ["x"], "not approved"), 3: ("approved_dry_run", "dry_run", None, "dry_run"),
        4: ("shipped", "would exceed 50 tags", many, "parent not registered"), 5: ("shipped", "no tags requested", None, "node already exists"), 6: ("shipped", "no tags requested", None, "registered"),
        7: ("shipped", "tagged", ["new"], "parent not registered"),
    }
    assert {(r.strategy_id, r.blocked_by, r.warnings, r.alerts, r.n_alerts) for r in m.filter("strategy_id < 4").collect()} == {(1, "", "soft", "extreme_drawdown,low_trades,very_brittle,weak_oos", 4), (2, "hard", "soft", "", 0), (3, "", "soft", "drift_red", 1)}
    assert {tuple(r) for r in W.shipped_nodes(m).collect()} == {("n1", "root", "s1"), ("n6", None, "s6")} and {r.strategy_id for r in W.shipped_tags(m).collect()} == {1, 7}
