"""Cases of the third round's findings: each failed before its mend."""

import duckdb
import pytest

from tests.test_oracles import norm
from tidemill.plans.registry import ORACLE_SQL, QUERIES


def both(spark, name, folder, **tables):
    """Rows of a query and of its SQL over small DuckDB tables (name to SELECT), both sorted."""
    con = duckdb.connect()
    for t, select in tables.items():
        con.execute(f"CREATE TABLE {t} AS {select}")
        con.execute(f"COPY {t} TO '{folder}/{t}.parquet' (FORMAT parquet)")
    df = QUERIES[name](spark, str(folder))
    cur = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]})")
    mine, theirs = (sorted((tuple(norm(x) for x in r) for r in rows), key=str) for rows in (df.collect(), cur.fetchall()))
    return mine, theirs


def events(*rows):
    """An events table of (user_id, value, k); ids count up, hours too."""
    each = ", ".join(f"({i}, TIMESTAMP '2024-01-01' + {i} * INTERVAL 1 HOUR, {u}, 'view', {v}::DOUBLE, '{{\"k\": {k}}}')" for i, (u, v, k) in enumerate(rows))
    return f"SELECT event_id::BIGINT AS event_id, ts, user_id::BIGINT AS user_id, event_type, value, props FROM (VALUES {each}) t(event_id, ts, user_id, event_type, value, props)"


def test_liquidation_of_a_zero_price(spark, tmp_path):
    mine, theirs = both(spark, "perp_liquidation_price", tmp_path, events=events((1, 0.0, 1), (2, 50.0, 1)))
    assert mine == theirs and len(mine) == 2


def test_costs_that_eat_all(spark, tmp_path):
    """Tenths that add up to nothing, in any order."""
    pnl = [0.1] * 10 + [-0.3, -0.7] + [0.7, 0.2, -0.9]
    mine, theirs = both(spark, "cost_sensitivity_grid", tmp_path, events=events(*((1, 50 + p, 1) for p in pnl), *((2, 50 + p, 1) for p in sorted(pnl)), *((3, 50 + p, 1) for p in sorted(pnl, reverse=True))))
    assert mine == theirs and len(mine) == 27
    assert not [r for r in QUERIES["cost_sensitivity_grid"](spark, str(tmp_path)).filter("commission + slippage = 0").collect() if r.survives or r.net]


def items(*rows):
    """Lineitem, supplier and nation of (supplier, discount, day); prices are equal, ten lines an order."""
    each = ", ".join(f"({i}, {k}, 100.0::DOUBLE, {d}::DOUBLE, TIMESTAMP '{day}')" for i, (k, d, day) in enumerate(rows))
    items = f"SELECT (i // 10)::BIGINT AS l_orderkey, (i % 10)::INTEGER AS l_linenumber, k::BIGINT AS l_suppkey, p AS l_extendedprice, d AS l_discount, t AS l_shipdate FROM (VALUES {each}) v(i, k, p, d, t)"
    keys = ", ".join(f"({k})" for k in sorted({r[0] for r in rows}))
    return {"lineitem": items, "supplier": f"SELECT k::BIGINT AS s_suppkey, 1 AS s_nationkey FROM (VALUES {keys}) v(k)", "nation": "SELECT 1 AS n_nationkey, 'N' AS n_name"}


LATE = "1998-08-01"


def test_fitness_on_the_edge_of_a_bucket(spark, tmp_path):
    """Means of exactly 0.05, from discounts in different orders."""
    means = [[0.01, 0.09, 0.02, 0.08, 0.03, 0.07] * 10, [0.01] * 30 + [0.09] * 30, [0.1, 0.0] * 30, [0.07, 0.03, 0.06, 0.04] * 15, [0.09, 0.08, 0.07, 0.03, 0.02, 0.01] * 10]
    mine, theirs = both(spark, "databank_partition", tmp_path, **items(*((k + 1, d, LATE) for k, ds in enumerate(means) for d in ds)))
    assert mine == theirs == [((2, "above"), (1, 5.0))]


def test_no_profit_and_funding_that_ends_in_a_half(spark, tmp_path):
    """Gains that cancel leave no profit, whatever their order; funding is exact to the half of a millionth."""
    pnl = [0.1] * 10 + [-0.3, -0.7]
    rows = [*((1, 50 + p, 8) for p in pnl), *((2, 50 + p, 8) for p in reversed(pnl)), *((3, 50 + p, 8) for p in (0.08, 0.16, 0.4)), *((4, 50 + p, k) for p, k in ((0.24, 1), (7.12, 3), (0.56, 5)))]
    mine, theirs = both(spark, "perp_funding_adjusted_pnl", tmp_path, events=events(*rows))
    assert mine == theirs
    flat = QUERIES["perp_funding_adjusted_pnl"](spark, str(tmp_path)).filter("strategy_id <= 2").collect()
    assert [(r.gross, r.impact_pct) for r in flat] == [(0.0, None)] * 2


def test_reports_that_differ_by_a_tenth(spark, tmp_path):
    """Totals that cancel or are a tenth apart, and means that end in half a millionth; sides turn by event."""
    rows = [(1, 50.1, 1), (1, 51.0, 1), (1, 50.2, 1), (1, 49.0, 1), (1, 49.7, 1), (1, 50.0, 1), *((2, 51.1, 1), (2, 51.0, 1)), *((k + 3, 50 + (0.01 * (37 * k + i) if i % 32 else 0.03), 1) for k in range(20) for i in range(64))]
    mine, theirs = both(spark, "report_compare_with_catalogue", tmp_path, events=events(*rows))
    assert mine == theirs
    net = {r.strategy_id: r for r in QUERIES["report_compare_with_catalogue"](spark, str(tmp_path)).filter("metric = 'net'").collect()}
    assert (net[1].b, net[1].diff, net[1].verdict) == (0.0, None, "ok") or (net[1].a, net[1].verdict) == (0.0, "warn")
    assert (net[2].diff, net[2].verdict) == (0.1, "ok")


@pytest.mark.parametrize("name", ["schedule_for_strategy", "schedule_for_workspace"])
def test_schedule_of_equal_fitness(spark, tmp_path, name):
    """In and out of sample alike, or nine tenths: from discounts in different orders."""
    early = [0.01, 0.09, 0.02, 0.08, 0.03, 0.07] * 100
    lates = [sorted(early), early[::-1], [0.05] * 600, [0.1, 0.0] * 300, [0.09 * x for x in (0.5,)] * 600, [0.04, 0.05] * 300]
    rows = [(k + 1, d, day) for k, late in enumerate(lates) for ds, day in ((early, "1990-01-01"), (late, LATE)) for d in ds]
    mine, theirs = both(spark, name, tmp_path, **items(*rows))
    assert mine == theirs
    assert not [r for r in QUERIES["schedule_for_strategy"](spark, str(tmp_path)).collect() if r.verdict != ("no_action" if r.strategy_id <= 4 else "retest")]


@pytest.mark.parametrize("name", ["vol_parkinson", "vol_garman_klass", "vol_rogers_satchell", "vol_yang_zhang", "vol_estimator_comparison"])
def test_volatility_beside_a_zero_price(spark, tmp_path, name):
    """An hour with a low of zero, one that closes there, and a series of one bar."""
    values = [(50, 55, 49, 52), (52, 0, 51, 53), (53, 56, 50, 54), (54, 55, 51, 0), (57, 58, 53, 56), (56, 60, 55, 59), (59, 62, 57, 58)]
    ticks = [(h * 4 + i, h, x, "a") for h, hour in enumerate(values) for i, x in enumerate(hour)] + [(99, 1, 10, "b")]
    each = ", ".join(f"({i}, {h}, {x}, '{s}')" for i, h, x, s in ticks)
    made = f"SELECT i::BIGINT AS event_id, TIMESTAMP '2024-01-01' + h * INTERVAL 1 HOUR AS ts, 1::BIGINT AS user_id, s AS event_type, x::DOUBLE AS value, '{{\"k\": 1}}' AS props FROM (VALUES {each}) v(i, h, x, s)"
    mine, theirs = both(spark, name, tmp_path, events=made)
    assert mine == theirs and "inf" not in str(mine) and "nan" not in str(mine)


def test_yang_zhang_leaves_out_what_has_no_price(spark):
    """Against a plain loop, over the bars whose prices and the close before are all positive."""
    from math import log, sqrt
    from statistics import variance

    from tidemill.operators.indicators import volatilities

    bars = [(50.0, 55.0, 49.0, 52.0), (52.0, 53.0, 0.0, 53.0), (53.0, 56.0, 50.0, 54.0), (54.0, 55.0, 0.0, 0.0), (57.0, 58.0, 53.0, 56.0), (56.0, 60.0, 55.0, 59.0), (59.0, 62.0, 57.0, 58.0)]
    on, oc, rs = [], [], []
    for before, (o, h, l, c) in zip(bars, bars[1:]):
        if min(o, h, l, c, before[3]) > 0:
            on, oc, rs = [*on, log(o / before[3])], [*oc, log(c / o)], [*rs, log(h / o) * log(h / c) + log(l / o) * log(l / c)]
    k = 0.34 / (1.34 + (len(on) + 1) / (len(on) - 1))
    want = sqrt((variance(on) + k * variance(oc) + (1 - k) * sum(rs) / len(rs)) * 252)
    got = volatilities(spark.createDataFrame([("s", i, *b) for i, b in enumerate(bars)], "series_id string, idx long, open double, high double, low double, close double")).head()
    assert abs(got.yang_zhang - want) < 1e-9


def test_a_share_of_exactly_nine_tenths_is_no_flag(spark, tmp_path):
    early = [[0.01, 0.09, 0.02, 0.08, 0.03, 0.07], [0.1, 0.0], [0.09, 0.01] * 3, [0.05], [0.1] * 7]
    late = [[0.04, 0.05], [0.01, 0.08, 0.06, 0.03], [0.09, 0.0, 0.03, 0.06], [0.02, 0.07], [0.09, 0.1, 0.08]]
    rows = [(k + 1, d, f"1997-{m}-01") for k in range(5) for ds, m in ((early[k], "01"), (late[k], "11")) for d in ds] + [(6, 0.05, "1997-01-01"), (6, 0.04, "1997-11-01")]
    mine, theirs = both(spark, "walkforward_overfit_flags", tmp_path, **items(*rows))
    assert mine == theirs and [r[0] for r in mine] == [(1, 6.0)]


@pytest.mark.parametrize("name", ["lineage_register", "lineage_link_errors"])
def test_new_nodes_beside_a_large_forest(spark, tmp_path, name):
    """Ids past a million are there already; new ones must not meet them."""
    keys = [*range(1, 10), *range(1_000_000, 1_000_012)]
    mine, theirs = both(spark, name, tmp_path, part=f"SELECT k::BIGINT AS p_partkey, 'b' AS p_brand FROM (VALUES {', '.join(f'({k})' for k in keys)}) v(k)")
    assert mine == theirs


def test_rounds_of_kmeans_read_stored_points(spark, tmp_path):
    """A counter in the points' plan tells how often a row is made."""
    from pyspark.sql import functions as F

    from tidemill.operators.selection import kmeans

    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(len(b))
            yield b

    points = spark.range(9).select("id", F.array((F.col("id") * F.col("id")).cast("double")).alias("z")).mapInPandas(counted, "id long, z array<double>")
    assert len({r.cluster for r in kmeans(points, 3, 50, "id").collect()}) == 3
    assert made.value == 9


def test_ancestors_of_trees_cycles_and_many_parents(spark):
    """Against plain walks: a chain, a bush, a cycle with a tail, and then a node of two parents."""
    from tidemill.operators.graph import ancestors

    one = [(k, k - 1) for k in range(1, 20)] + [(100 + k, 100 + k // 2) for k in range(1, 30)] + [(200, 202), (201, 200), (202, 201), (203, 200), (300, None)]
    for edges in (one, [*one, (19, 105)]):
        want = {}
        for node in {n for n, _ in edges}:
            level, far = {node}, 0
            while level := {p for n, p in edges if n in level and p is not None and p != node and (node, p) not in want}:
                far += 1
                want |= {(node, p): far for p in level}
        got = ancestors(spark.createDataFrame(edges, "node_id long, parent_id long"))
        assert dict(got.dtypes)["distance"] == "int"
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == len(want) and {(n, a): d for n, a, d in rows} == want


def test_forests_are_not_broadcast(spark):
    from tidemill.operators import graph as G

    edges = spark.createDataFrame([(k, k // 2) for k in range(2, 60)], "node_id long, parent_id long")
    for df in (G.intervals(edges), G.descends(edges, edges, "node_id", "parent_id")):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_owners_by_lots_against_a_plain_loop(spark, monkeypatch):
    """Random curves of several lengths, equal signatures, several tag sets; lots so small that rounds go on."""
    import numpy as np

    from tidemill.operators import graph as G

    rng, rows = np.random.default_rng(5), []
    for k in range(60):
        n = int(rng.choice([2, 5, 16, 16, 16]))
        rows.append((k, [["a", "b", "c", "d"], ["a", "b", "c", "d", "e"], ["x", "y"]][k % 3], f"s{k if k % 10 else 0}", [float(x) for x in np.cumsum(rng.normal(size=n)).round(4)]))

    def like(p, q):
        if p[2] == q[2]:
            return 1.0
        n = min(len(p[3]), len(q[3]))
        c = np.corrcoef(p[3][:n], q[3][:n])[0, 1] if n >= 3 else 0.0
        return round(0.6 * len({*p[1]} & {*q[1]}) / len({*p[1]} | {*q[1]}) + 0.4 * max(c, 0.0), 4)

    want = {}
    for r in rows:
        want[r[0]] = next((o[0] for o in rows[: r[0]] if want[o[0]] == o[0] and like(o, r) >= 0.85), r[0])
    monkeypatch.setattr(G, "LOT", 20)
    got = G.greedy_duplicates(spark.createDataFrame(rows, "strategy_id long, tags array<string>, signature string, curve array<double>"))
    assert {r.strategy_id: r.owner for r in got.collect()} == want
    assert 1 < len(set(want.values())) < 60


def test_blocks_of_reset_bars_are_small(spark, monkeypatch):
    """A series longer than a block of reset bars is cut without being asked, whatever the size of other blocks; the bars are those of a plain loop."""
    from pyspark.sql import functions as F

    from tidemill.operators import bars as B
    from tidemill.operators import scan

    assert B.RESET_ROWS < scan.BLOCK_ROWS
    monkeypatch.setattr(B, "RESET_ROWS", 50)
    held = []
    whole = B._reset_blocks
    monkeypatch.setattr(B, "_reset_blocks", lambda series, *a: held.append(series) or whole(series, *a))
    ticks = spark.range(400).select(F.lit("s").alias("series_id"), F.col("id").alias("seq"), F.col("id").alias("epoch"), F.lit(1.0).alias("price"), (F.col("id") * 7 % 10).cast("double").alias("volume"))
    got = {(r.bar, r.n_ticks) for r in B.reset_bars(ticks, F.col("volume"), 30.0).collect()}
    want, total, n, bar = set(), 0, 0, 0
    for k in range(400):
        total, n = total + k * 7 % 10, n + 1
        if total >= 30:
            want.add((bar, n))
            total, n, bar = 0, 0, bar + 1
    assert got == want and held and held[0].cut
