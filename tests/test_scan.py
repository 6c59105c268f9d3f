"""Series cut into blocks: every result equals that of the plain loop over the whole series."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.operators import bars as B
from tidemill.operators import indicators as I
from tidemill.operators import pairs
from tidemill.operators import risk as R
from tidemill.operators import scan
from tidemill.operators import stats as S


@pytest.fixture
def blocks_of_50(monkeypatch):
    monkeypatch.setattr(scan, "BLOCK_ROWS", 50)
    monkeypatch.setattr(I, "BLOCK_ROWS", 50)


@pytest.fixture(scope="module")
def long(spark):
    """One hot series, a short one, and one that fits a block."""
    rng = random.Random(4)
    rows = [("hot", k, None if k % 97 == 3 else rng.gauss(10, 3)) for k in range(1000)] + [("few", k, float(k % 5)) for k in range(7)] + [("fits", 3 * k, rng.random()) for k in range(50)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "series_id string, idx long, v double").repartition(4).cache()


def plain(rows):
    out = {}
    for r in sorted(rows.collect(), key=lambda r: (r.series_id, r.idx)):
        out.setdefault(r.series_id, []).append(r)
    return out


def test_blocks_are_even_and_in_order(long):
    s = scan.Series(long, ["series_id"], "idx", 50)
    assert s.cut
    spans = s.rows.groupBy("series_id", scan.BLOCK).agg(F.min("idx").alias("a"), F.max("idx").alias("z"), F.count(F.lit(1)).alias("n")).collect()
    hot = sorted((r[scan.BLOCK], r.a, r.z, r.n) for r in spans if r.series_id == "hot")
    assert len(hot) == 20 and max(n for *_, n in hot) <= 60 and all(x[2] < y[1] for x, y in zip(hot, hot[1:]))
    assert all(r[scan.BLOCK] == 0 for r in spans if r.series_id != "hot")
    assert not scan.Series(long, ["series_id"], "idx").cut


def test_running(long):
    v = F.col("v")
    kinds = {"n": ("count", F.lit(1)), "known": ("count_before", v), "total": ("sum", v), "before": ("sum_before", v), "top": ("max", v), "top_before": ("max_before", v), "low": ("min", v), "last": ("lag", v)}
    got = plain(scan.running(long, ["series_id"], "idx", 50, **kinds))
    for rows in got.values():
        for i, r in enumerate(rows):
            upto, before = ([x.v for x in rows[:k] if x.v is not None] for k in (i + 1, i))
            assert r.n == i + 1 and r.known == len(before) and r.last == (rows[i - 1].v if i else None)
            assert r.top == max(upto, default=None) and r.low == min(upto, default=None) and r.top_before == max(before, default=None)
            assert r.total == pytest.approx(sum(upto) if upto else None) and r.before == pytest.approx(sum(before) if before else None)


def test_running_null_keys_and_orders(spark):
    rows = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), ("a", None, 5.0)] + [("a", k, 1.0) for k in range(200)], "series_id string, idx long, v double")
    got = scan.running(rows, ["series_id"], "idx", 20, s=("sum", F.col("v"))).collect()
    assert len(got) == 203 and {r.s for r in got if r.series_id is None} == {1.0, 3.0} and max(r.s for r in got if r.series_id == "a") == 205.0
    assert next(r.s for r in got if r.series_id == "a" and r.idx is None) == 5.0
    assert scan.running(rows.limit(0), ["series_id"], "idx", 20, s=("sum", F.col("v"))).count() == 0


def test_rolling_windows_with_halo(long):
    w = Window.partitionBy("series_id").orderBy("idx").rowsBetween(-6, 0)
    build = lambda rows: rows.withColumns({"m": F.avg("v").over(w), "full": I.full(F.lit(1), 7)})
    want, got = plain(build(long)), plain(scan.rolling(long, "series_id", "idx", 6, build, 50))
    assert {k: [(r.m, r.full) for r in rows] for k, rows in got.items()} == {k: [(r.m, r.full) for r in rows] for k, rows in want.items()}


def test_average_ranks(spark, monkeypatch):
    rng = random.Random(9)
    rows = [("a", float(rng.randrange(40)), rng.random()) for _ in range(300)] + [("b", 1.0, 2.0), ("b", None, 2.0), ("b", 1.0, 5.0)]
    df = spark.createDataFrame(rows, "series_id string, a double, b double")
    rank = lambda c: F.rank().over(Window.partitionBy("series_id").orderBy(c)) + (F.count(F.lit(1)).over(Window.partitionBy("series_id", c)) - 1) / 2
    want = sorted(map(tuple, df.withColumns({"x": rank("a"), "y": rank("b")}).collect()), key=str)
    assert sorted(map(tuple, scan.average_ranks(df, ["series_id"], x="a", y="b").collect()), key=str) == want
    monkeypatch.setattr(scan, "BLOCK_ROWS", 7)
    assert sorted(map(tuple, scan.average_ranks(df, ["series_id"], x="a", y="b").collect()), key=str) == want


def test_users_of_running(long, monkeypatch):
    """Drawdowns, episodes, runs, tick bars, buckets and rank statistics do not hang on the size of a block."""
    known = long.filter("v is not null")
    ticks = known.select("series_id", F.col("idx").alias("seq"), F.col("idx").alias("epoch"), F.col("v").alias("price"), F.lit(1.0).alias("volume"))
    pairs = known.select("series_id", "idx", F.col("v").alias("a"), (F.col("v") * (F.col("idx") % 7)).alias("b"))
    made = {
        "drawdown": lambda: R.with_drawdown(known), "episodes": lambda: R.drawdown_episodes(known), "runs": lambda: R.longest_runs(known, F.when(F.col("v") > 10, "up").when(F.col("v") < 8, "down"), "series_id", "idx"),
        "tick_bars": lambda: B.tick_bars(ticks, 7), "buckets": lambda: R.bucket_returns(known.filter("series_id <> 'few'"), 6), "ic": lambda: S.spearman(pairs), "wilcoxon": lambda: S.wilcoxon(pairs),
    }
    rounded = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in (r[c] for c in sorted(df.columns))) for r in df.collect())
    want = {k: rounded(f()) for k, f in made.items()}
    monkeypatch.setattr(scan, "BLOCK_ROWS", 50)
    for k, f in made.items():
        assert rounded(f()) == want[k], k


def seeded(x, span, keep):
    """The plain loop."""
    out, y, n = [], 0.0, 0
    for v in x:
        if n >= span:
            y = keep * y + (1 - keep) * v
            out.append(y)
            continue
        if n or v is not None:
            y, n = y + v, n + 1
        out.append(y / span if n == span else None)
        if n == span:
            y /= span
    return out


@pytest.mark.parametrize("size", [None, 40])
def test_smooth_against_loop(spark, size):
    rng = random.Random(2)
    data = {"hot": [None] * 90 + [rng.gauss(50, 9) for _ in range(700)], "b": [rng.random() for _ in range(45)], "none": [None] * 100, "few": [1.0, 2.0], "edge": [None] + [float(k) for k in range(39)]}
    df = spark.createDataFrame([(k, i, x) for k, xs in data.items() for i, x in enumerate(xs)], "series_id string, idx long, v double").repartition(3)
    got = plain(I.smooth(df, [I.ema("f", "v", 12), I.ema("s", "v", 26), I.ema("signal", "f-s", 9), I.wilder("w", "v", 14)], block_rows=size))
    for k, xs in data.items():
        f, s, w = seeded(xs, 12, 1 - 2 / 13), seeded(xs, 26, 1 - 2 / 27), seeded(xs, 14, 1 - 1 / 14)
        sig = seeded([None if b is None else a - b for a, b in zip(f, s)], 9, 0.8)
        for name, want in (("f", f), ("s", s), ("signal", sig), ("w", w)):
            assert [r[name] for r in got[k]] == [x if x is None else pytest.approx(x, rel=1e-11, abs=1e-11) for x in want], (k, name)


def test_smooth_users_do_not_hang_on_blocks(spark, monkeypatch):
    rng = random.Random(6)
    rows = [("x", k, *(p := sorted(rng.uniform(90, 110) for _ in range(3)))[:1], p[2], p[1]) for k in range(400)]
    bars = spark.createDataFrame(rows, "series_id string, idx long, low double, high double, close double")
    made = {"atr": lambda: I.atr(bars, 14), "keltner": lambda: I.keltner(bars, 20), "rsi": lambda: I.rsi(bars, 14), "macd": lambda: I.macd(bars)}
    show = lambda df: sorted(tuple(round(v, 8) if isinstance(v, float) else v for v in (r[c] for c in sorted(df.columns))) for r in df.collect())
    key = lambda rows: sorted(rows, key=str)
    show = lambda df: key(tuple(round(v, 8) if isinstance(v, float) else v for v in (r[c] for c in sorted(df.columns))) for r in df.collect())
    want = {k: show(f()) for k, f in made.items()}
    monkeypatch.setattr(scan, "BLOCK_ROWS", 60)
    monkeypatch.setattr(I, "BLOCK_ROWS", 60)
    for k, f in made.items():
        assert show(f()) == want[k], k


def test_decayed_lanes():
    rng = np.random.default_rng(1)
    for n in (1, 127, 128, 129, 1000):
        x, y, want = rng.normal(size=n), 3.0, []
        for v in x:
            y = 0.9 * y + 0.1 * v
            want.append(y)
        assert np.allclose(I.decayed(x, 0.9, 3.0), want, rtol=1e-12)
    assert np.isnan(I.decayed(np.array([1.0, np.nan, 2.0]), 0.5, 1.0)).tolist() == [False, True, True]


def loop_bars(m, threshold, signed):
    """(bar, closed) of every tick by the plain loop."""
    out, bar, total = [], 0, 0.0
    for x in m:
        total += x
        done = (abs(total) if signed else total) >= threshold
        out.append((bar, done))
        bar, total = (bar + 1, 0.0) if done else (bar, total)
    return out


@pytest.mark.parametrize("signed", [False, True])
@pytest.mark.parametrize("threshold", [5.0, 40.0, 1000.0])
def test_reset_steps_are_the_loop(signed, threshold):
    """For any total that can come in, the step function of a block gives what the loop gives."""
    rng = random.Random(int(threshold))
    for n in (1, 3, 200):
        m = np.array([float(rng.randrange(-9, 10) if signed else rng.randrange(0, 10)) for _ in range(n)])
        steps = B.reset_steps(m, threshold, signed)
        for start in [float(rng.randrange(-int(threshold) + 1 if signed else 0, int(threshold))) for _ in range(60)]:
            total, closes = start, 0
            for x in m.tolist():
                total += x
                if (abs(total) if signed else total) >= threshold:
                    total, closes = 0.0, closes + 1
            _, _, _, end, n_closes = next(s for s in steps if start + s[1] >= threshold or (signed and start + s[2] <= -threshold))
            assert (end if n_closes else start + end, n_closes) == (total, closes)


@pytest.mark.parametrize(("signed", "threshold"), [(False, 30.0), (False, 900.0), (True, 25.0), (True, 200.0)])
def test_reset_bars_in_blocks(spark, signed, threshold):
    rng = random.Random(13)
    data = {"hot": [float(rng.randrange(-9, 11) if signed else rng.randrange(0, 10)) for _ in range(900)], "few": [50.0, 1.0, 2.0], "zero": [0.0] * 120, "big": [99.0] * 120}
    rows = [(k, i, 10 * i, float(i), None if v == 7.0 else v) for k, xs in data.items() for i, v in enumerate(xs)]
    df = spark.createDataFrame(rows, "series_id string, seq long, epoch long, price double, volume double").repartition(4)
    got = {(r.series_id, r.bar): (r.n_ticks, r.open_epoch, r.close_epoch, r.measure_sum) for r in B.reset_bars(df, F.col("volume"), threshold, signed, block_rows=50).collect()}
    want = {}
    for k, xs in data.items():
        m = [0.0 if v == 7.0 else v for v in xs]
        marks = loop_bars(m, threshold, signed)
        full = {bar for bar, done in marks if done}
        for bar in full:
            at = [i for i, (b, _) in enumerate(marks) if b == bar]
            want[k, bar] = (len(at), 10 * at[0], 10 * at[-1], sum(m[i] for i in at))
    assert got == want and len(want) > 3
    once = {(r.series_id, r.bar): (r.n_ticks, r.open_epoch, r.close_epoch, r.measure_sum) for r in B.reset_bars(df, F.col("volume"), threshold, signed).collect()}
    assert once == want


@pytest.mark.parametrize("rows", [0, 300])
def test_quantiles_are_exact(spark, monkeypatch, rows):
    """Against the aggregate that holds all values; with ties, nulls, few rows and a hot key."""
    rng = random.Random(17)
    data = [("hot", rng.choice([1.0, 2.0, rng.gauss(0, 100)])) for _ in range(20000)] + [("tied", 5.0)] * 2000 + [("few", 1.0), ("few", 4.0), ("one", 3.0), ("none", None), (None, 7.0)] + [("skew", 10.0 ** rng.uniform(-300, 300)) for _ in range(5000)]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    at = {"a": 0.0, "b": 0.05, "c": 0.25, "d": 0.5, "e": 0.999, "f": 1.0}
    want = {r.k: tuple(r.q) for r in df.filter("v is not null and k is not null").groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, at.values()))).alias("q")).collect()}
    if rows:
        monkeypatch.setattr(scan, "SELECT_ROWS", rows)
        monkeypatch.setattr(scan, "SKETCH", 700)
        monkeypatch.setattr(scan, "BLOCK_ROWS", 40)
    got = {r.k: (tuple(r[c] for c in at), r.n) for r in scan.quantiles(df, ["k"], "v", at, keep="n").collect() if r.k is not None}
    assert got.keys() == want.keys() and all(got[k][0] == pytest.approx(want[k], rel=1e-12) for k in want) and got["hot"][1] == 20000


def test_worst_share_with_ties(spark, monkeypatch):
    rng = random.Random(3)
    data = {"a": [float(rng.randrange(6)) for _ in range(250)], "b": [1.0], "c": [rng.random() for _ in range(99)]}
    df = spark.createDataFrame([(k, x) for k, xs in data.items() for x in xs], "series_id string, r double")
    for size in (1_000_000, 5):
        monkeypatch.setattr(scan, "BLOCK_ROWS", size)
        got = {r.series_id: (r.cvar, r["var"], r.tail_size) for r in R.worst_share(df, "r", 0.9).collect()}
        for k, xs in data.items():
            tail = sorted(xs)[: max(1, round(0.1 * len(xs)))]
            assert got[k] == (pytest.approx(-sum(tail) / len(tail)), -max(tail), len(tail))


def plain_barrier(x, profit, stop, horizon, sign):
    out = []
    for i, p in enumerate(x):
        last, label = min(len(x) - 1, i + horizon), 0
        for j in range(i + 1, last + 1):
            r = sign * (x[j] - p) / p * 100 if p else 0.0
            if r >= profit or r <= -stop:
                last, label = j, 1 if r >= profit else -1
                break
        out.append((label, last, sign * (x[last] - p) / p * 100) if p > 0 else (None, last, None))
    return out


@pytest.mark.parametrize(("horizon", "side"), [(5, "long"), (5, "short"), (33, "long"), (100, "short"), (5000, "long")])
def test_barriers_near_and_far(spark, monkeypatch, horizon, side):
    rng = random.Random(horizon)
    walk = [100.0]
    for _ in range(700):
        walk.append(max(1.0, walk[-1] * rng.choice([0.97, 1.0, 1.03])))
    data = {"long": walk, "odd": [10.0, -5.0, 12.0, 0.0, 11.0, 13.0], "one": [3.0], "flat": [2.0] * 80}
    df = spark.createDataFrame([(k, 2 * i, x) for k, xs in data.items() for i, x in enumerate(xs)], "series_id string, idx long, close double").repartition(3)
    monkeypatch.setattr(S, "SEARCHED", 64)
    for size in (None, 50):
        got = plain(S.triple_barrier(df, 9.0, 6.0, horizon, side, block_rows=size))
        for k, xs in data.items():
            want = plain_barrier(xs, 9.0, 6.0, horizon, 1.0 if side == "long" else -1.0)
            rows = [(r.label, r.exit_index // 2, r.return_pct) for r in got[k]]
            keep = [i for i, x in enumerate(xs) if x > 0]
            assert [rows[i] for i in keep] == [(a, b, pytest.approx(c)) for a, b, c in (want[i] for i in keep)], (k, size)
            assert all(rows[i][0] is None and rows[i][2] is None for i in range(len(xs)) if xs[i] <= 0)


def loop_cusum(d, limit, start=0.0):
    """One side by the plain loop: breaks and the sum at the end."""
    out, held = [], start
    for i, x in enumerate(d):
        held = max(0.0, held + x)
        if held >= limit:
            out.append((i, held))
            held = 0.0
    return out, held


@pytest.mark.parametrize("limit", [3.0, 20.0, 500.0])
def test_excursion_steps_are_the_loop(limit):
    rng = random.Random(int(limit))
    for n in (1, 4, 150):
        for drift in (-2, 0, 1):
            x = np.array([float(rng.randrange(-6, 7) + drift) for _ in range(n)])
            *some, none, zero = S.excursion_steps(x, limit)
            for start in [0.0, *(float(rng.randrange(0, int(limit))) for _ in range(40))]:
                breaks, end = loop_cusum(x, limit, start)
                down, got = start <= 0, None
                for _, level, lowest, ends, count in some:
                    down = down or start + lowest <= 0
                    if not down and start + level >= limit:
                        got = (ends, count)
                        break
                if got is None:
                    down = down or start + none[2] <= 0
                    got = zero[3:] if down else (start + none[3], 0)
                assert got == (end, len(breaks)), (start, x.tolist())
                assert S._excursions(x, start, limit) == (breaks, end)


@pytest.mark.parametrize("limit", [4.0, 60.0])
def test_cusum_in_blocks(spark, limit):
    rng = random.Random(23)
    data = {"hot": [float(rng.randrange(-3, 4)) for _ in range(700)], "few": [1.0, 9.0], "up": [1.0] * 130, "gap": [None if k % 9 == 2 else float(k % 7 - 3) for k in range(120)]}
    df = spark.createDataFrame([(k, i, x) for k, xs in data.items() for i, x in enumerate(xs)], "series_id string, idx long, v double").repartition(3)
    want = set()
    for k, xs in data.items():
        known = [(i, x) for i, x in enumerate(xs) if x is not None]
        for sign, name in ((1.0, "up"), (-1.0, "down")):
            breaks, end = loop_cusum([sign * (x - 0.25) for _, x in known], limit)
            want |= {(k, known[i][0], name, sign * h) for i, h in breaks} | {(k, known[-1][0], f"last_{name}", sign * end)}
    for size in (None, 50):
        assert {tuple(r) for r in S.cusum_states(df, "v", limit, reference=0.25, block_rows=size).collect()} == want


def test_tiles_of_all_pairs(spark, monkeypatch):
    """Against plain sums over the common places: gaps, constant and disjoint series, one value, large levels."""
    rng = random.Random(31)
    data = [(f"s{k:02d}", t, 1e6 + rng.gauss(0, 1) + (t % 5) * (k % 3)) for k in range(23) for t in range(-40, 160) if rng.random() < 0.8]
    data += [("flat", t, 4.0) for t in range(50)] + [("one", 3, 1.0), ("far", 10**6, 1.0), ("far", 10**6 + 1, 2.0), ("null", 5, None), (None, 5, 1.0)]
    df = spark.createDataFrame(data, "series_id string, idx long, r double").repartition(3)
    held = {}
    for k, t, r in data:
        if k is not None and r is not None:
            held.setdefault(k, {})[t] = r
    want = {}
    for a in sorted(held):
        for b in sorted(held):
            common = sorted(held[a].keys() & held[b].keys()) if a < b else []
            if common:
                want[a, b] = len(common), ([held[a][t] for t in common], [held[b][t] for t in common])
    for series, places in ((256, 4096), (5, 37)):
        monkeypatch.setattr(pairs, "SERIES", series)
        monkeypatch.setattr(pairs, "PLACES", places)
        n = {(r.sym_a, r.sym_b): r.n for r in pairs.pair_moments(df, "r").collect()}
        rho = {(r.sym_a, r.sym_b): r.rho for r in pairs.correlations(df, "r").collect()}
        assert n == {k: v[0] for k, v in want.items()} and rho.keys() == want.keys()
        for k, (count, value) in want.items():
            if count > 2 and "flat" not in k:
                assert rho[k] == pytest.approx(np.corrcoef(*value)[0, 1], abs=1e-7), k
            elif "flat" in k or count == 1:
                assert rho[k] is None


def test_rolling_indicators_do_not_hang_on_blocks(spark, monkeypatch):
    rng = random.Random(16)
    rows = [(n, k, *(p := sorted(rng.uniform(90, 110) for _ in range(3)))[:1], p[2], p[1], rng.gauss(0, 1)) for n, size in (("x", 300), ("y", 12)) for k in range(size)]
    bars = spark.createDataFrame(rows, "series_id string, idx long, low double, high double, close double, r double")
    pairs_ = bars.select("series_id", "idx", F.col("r").alias("a"), F.col("close").alias("b"))
    made = {
        "bollinger": lambda: I.bollinger(bars), "donchian": lambda: I.donchian(bars), "chandelier": lambda: I.chandelier(bars), "stochastic": lambda: I.stochastic(bars), "cci": lambda: I.cci(bars), "williams": lambda: I.williams_r(bars), "sharpe": lambda: I.rolling_sharpe(bars, "r", 15),
        "volatility": lambda: I.rolling_volatility(bars, "r", 15), "correlation": lambda: I.rolling_correlation(pairs_, 15), "beta": lambda: I.rolling_beta_alpha(pairs_, 15), "drawdown": lambda: I.rolling_drawdown(bars, "close", 15), "wins": lambda: I.rolling_win_rate(bars, "r", 15),
        "calm": lambda: I.volatility_regimes(bars, "r"), "trend": lambda: I.trend_regimes(bars, "close"),
    }
    show = lambda df: sorted((tuple(round(v, 7) if isinstance(v, float) else v for v in (r[c] for c in sorted(df.columns))) for r in df.collect()), key=str)
    want = {k: show(f()) for k, f in made.items()}
    monkeypatch.setattr(scan, "BLOCK_ROWS", 60)
    monkeypatch.setattr(I, "BLOCK_ROWS", 60)
    for k, f in made.items():
        assert show(f()) == want[k], k
