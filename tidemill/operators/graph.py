"""Lineage forests, tags, fingerprints and manifests."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .scan import running

MOST_TAGS = 50


def _beside(a: DataFrame, b: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join of two tables of a row a node, by sorted parts: their files are small beside their rows, so a planner would send them through the driver."""
    return a.join(b.hint("merge"), on, how)


def ancestors(edges: DataFrame) -> DataFrame:
    """(node_id, ancestor, distance) of every node, at any depth; on a cycle each node comes once, at its least distance.

    Paths of a forest are gathered by ``paths_up``, whose rounds write only what is new. Nodes on or below a cycle, or all nodes if one has several
    parents, have paths that may meet, so these are found by ``_least_paths``.
    """
    edges = edges.select("node_id", "parent_id")
    if edges.groupBy("node_id").agg(F.count_distinct("parent_id").alias("n")).filter("n > 1").head(1):
        return _least_paths(edges)
    state, tables = jumps(edges)
    found = _paths_up(state, tables, state.filter("root is not null").select("node_id")).withColumn("distance", F.col("distance").cast("int"))
    loose = state.filter("root is null").select("node_id")
    if not loose.head(1):
        return found
    return found.union(_least_paths(_beside(edges, loose, "node_id", "left_semi")))


def _least_paths(edges: DataFrame) -> DataFrame:
    """(node_id, ancestor, distance) of any graph, by pointer doubling: each round joins paths of length up to 2^k to themselves. Stops when no path is new."""
    paths = materialise(edges.filter("parent_id is not null").select("node_id", F.col("parent_id").alias("ancestor"), F.lit(1).alias("distance")), "paths")
    while True:
        on = paths.select(F.col("node_id").alias("ancestor"), F.col("ancestor").alias("far"), F.col("distance").alias("more"))
        longer = paths.join(on, "ancestor").select("node_id", F.col("far").alias("ancestor"), (F.col("distance") + F.col("more")).alias("distance")).filter("node_id <> ancestor")
        new = materialise(paths.union(longer).groupBy("node_id", "ancestor").agg(F.min("distance").alias("distance")), "paths")
        if new.count() == paths.count():
            return paths
        paths = new


def jumps(edges: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(node_id, root, depth, descendants, height) of every node, and the tables (node_id, up) of ancestors at 1, 2, 4, ... steps.

    Each round doubles the steps: a node's ancestor at 2^(k+1) is that of its ancestor at 2^k, and what is known of the
    descendants up to 2^k steps down comes up from the nodes 2^k below. Rows stay one a node, rounds are the logarithm of the
    depth. Of several edges of a node that with the smallest parent counts. A parent that has no row is a root. Nodes on a cycle, or below one, have no root, depth, descendants or height: all null.
    """
    known = edges.groupBy("node_id").agg(F.min("parent_id").alias("parent_id"))
    roots = known.select(F.col("parent_id").alias("node_id")).filter("node_id is not null").distinct()
    roots = _beside(roots, known, "node_id", "left_anti")
    every = known.unionByName(roots.withColumn("parent_id", F.lit(None).cast(known.schema["parent_id"].dataType)))
    zero = F.lit(0).cast("long")
    state = materialise(every.select("node_id", F.col("parent_id").alias("up"), F.col("node_id").alias("root"), zero.alias("depth"), zero.alias("descendants"), zero.alias("height")), "jumps")
    tables, step, nodes = [], 1, state.count()
    while step <= 2 * nodes and state.filter("up is not null").head(1):
        tables.append(state.filter("up is not null").select("node_id", "up"))
        above = state.select(F.col("node_id").alias("up"), F.col("up").alias("far"), F.col("root").alias("top"), F.col("depth").alias("more"))
        below = state.filter("up is not null").groupBy(F.col("up").alias("node_id")).agg(F.sum(F.col("descendants") + 1).alias("under"), (F.max("height") + step).alias("down"))
        new = _beside(_beside(state, above, "up", "left"), below, "node_id", "left")
        on = F.col("up").isNotNull()
        state = materialise(
            new.select(
                "node_id", F.col("far").alias("up"), F.when(on, F.col("top")).otherwise(F.col("root")).alias("root"), F.when(on, F.col("more") + step).otherwise(F.col("depth")).alias("depth"),
                (F.col("descendants") + F.coalesce("under", zero)).alias("descendants"), F.greatest("height", F.coalesce("down", zero)).alias("height"),
            ), "jumps",
        )
        step *= 2
    done = F.col("up").isNull()
    out = state.select("node_id", *(F.when(done, F.col(c)).alias(c) for c in ("root", "depth", "descendants", "height")))
    return _beside(out, known.select("node_id").distinct(), "node_id", "left_semi"), tables


def tree(edges: DataFrame) -> DataFrame:
    """Each node's root, depth, number of descendants and height (steps to the farthest of them)."""
    return jumps(edges)[0]


def intervals(edges: DataFrame) -> DataFrame:
    """(node_id, root, enter, leave): places of a walk that visits each tree parent first. A node is above another if they share the root and the other's ``enter`` lies in (enter, leave].

    A node enters behind its parent and the subtrees of the siblings before it (in order of a hash), so its place is a sum along its path
    up, gathered by doubling pointers; ``leave`` adds its descendants. One row a node answers any number of questions by comparison. Nodes on or below a cycle have none: all null.
    """
    known = edges.groupBy("node_id").agg(F.min("parent_id").alias("parent_id"))
    sizes = materialise(jumps(edges)[0].select("node_id", "root", "descendants"), "tree")
    step = _beside(known, sizes, "node_id").filter("parent_id is not null").withColumn("_h", F.xxhash64("node_id"))
    step = running(step, ["parent_id"], "_h", _before=("sum_before", F.col("descendants") + 1)).select("node_id", F.col("parent_id").alias("up"), (1 + F.coalesce("_before", F.lit(0))).alias("enter"))
    # a parent without a row of its own is a root: nothing lies before its first child but itself
    state = materialise(_beside(sizes.select("node_id"), step, "node_id", "left").select("node_id", "up", F.coalesce("enter", F.lit(0)).cast("long").alias("enter")), "enter")
    reach, nodes = 1, state.count()
    while reach <= 2 * nodes and state.filter("up is not null").head(1):
        above = state.select(F.col("node_id").alias("up"), F.col("up").alias("_u"), F.col("enter").alias("_e"))
        state = materialise(_beside(state, above, "up", "left").select("node_id", F.col("_u").alias("up"), (F.col("enter") + F.coalesce("_e", F.lit(0))).alias("enter")), "enter")
        reach *= 2
    out = _beside(sizes, state, "node_id")
    whole = F.col("root").isNotNull()
    return out.select("node_id", "root", F.when(whole, F.col("enter")).alias("enter"), F.when(whole, F.col("enter") + F.col("descendants")).alias("leave"))


def descends(pairs: DataFrame, edges: DataFrame, low: str, high: str) -> DataFrame:
    """The (low, high) pairs of ``pairs`` in which ``low`` descends from ``high``, by their intervals. A parent that has no row is above all under it."""
    index = materialise(intervals(edges), "intervals").filter("root is not null")
    at = lambda c: index.select(F.col("node_id").alias(c), F.col("root").alias(f"_{c}_root"), F.col("enter").alias(f"_{c}"), F.col("leave").alias(f"_{c}_end"))
    p = _beside(_beside(pairs.select(low, high).distinct(), at(low), low), at(high), high, "left")
    inside = (F.col(f"_{low}_root") == F.col(f"_{high}_root")) & (F.col(f"_{low}") > F.col(f"_{high}")) & (F.col(f"_{low}") <= F.col(f"_{high}_end"))
    return p.filter(inside | (F.col(f"_{high}_root").isNull() & (F.col(f"_{low}_root") == F.col(high)))).select(low, high)


def paths_up(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node_id, ancestor, distance) of the asked ``nodes`` (node_id) alone: rows are their depths, not all of a forest's. Nodes on or below a cycle have no path."""
    return _paths_up(*jumps(edges), nodes)


def _paths_up(state: DataFrame, tables: list[DataFrame], nodes: DataFrame) -> DataFrame:
    """With the ancestors at 1, 2, 4, ... steps each round adds, to all that is found, what lies that many steps above it, the smallest step first.

    Only what has an ancestor that far up is sent, and at each step that is at least as many different nodes as steps, so no node
    near a root is a key of all below it. A round writes its new rows alone.
    """
    known = state.filter("root is not null").select("node_id", "depth")
    start = _beside(nodes.select("node_id").distinct(), known, "node_id")
    parts = [materialise(start.select("node_id", F.col("node_id").alias("ancestor"), F.lit(0).cast("long").alias("distance"), F.col("depth").alias("above")), "paths-up")]
    for k, table in enumerate(tables):
        up = table.select(F.col("node_id").alias("ancestor"), F.col("up").alias("_up"))
        able = reduce(DataFrame.union, parts).filter(F.col("above") >= (1 << k))
        parts.append(materialise(_beside(able, up, "ancestor").select("node_id", F.col("_up").alias("ancestor"), F.col("distance") + (1 << k), F.col("above") - (1 << k)).toDF(*able.columns), "paths-up"))
    return reduce(DataFrame.union, parts).filter("distance > 0").drop("above")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node that an undirected link (a, b) joins to another.

    Alternating stars: each node's larger neighbours, then its smaller ones, are tied to the smallest node around it, until every node hangs on its
    component's smallest. Each step is a join and an aggregate, written to the shared folder; a hub is a key of aggregates, never a group in a task.
    """
    edges = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("low"))
        large = materialise(both.join(near, "u").filter("v > u and v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct(), "links")
        near = large.groupBy("u").agg(F.min("v").alias("low"))
        small_ = large.join(near, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).union(near.select("u", F.col("low").alias("v")))
        edges = materialise(small_.distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now


def anchors(edges: DataFrame, moving: DataFrame) -> DataFrame:
    """(node_id, anchor) of every node: the first node of ``moving`` at or above it, null if there is none. Pointers double in each round."""
    own = moving.select("node_id", F.lit(True).alias("_moves")).distinct()
    start = edges.groupBy("node_id").agg(F.min("parent_id").alias("parent_id")).join(own, "node_id", "left")
    state = materialise(start.select("node_id", F.when(F.col("_moves"), F.col("node_id")).alias("anchor"), F.when(F.col("_moves").isNull(), F.col("parent_id")).alias("up")), "anchors")
    step, nodes = 1, state.count()
    while step <= 2 * nodes and state.filter("up is not null").head(1):
        above = state.select(F.col("node_id").alias("up"), F.col("anchor").alias("_a"), F.col("up").alias("_u"))
        state = materialise(state.join(above, "up", "left").select("node_id", F.coalesce("anchor", "_a").alias("anchor"), F.when(F.col("_a").isNull(), F.col("_u")).alias("up")), "anchors")
        step *= 2
    return state.select("node_id", "anchor")


def _applied(p: pd.DataFrame) -> pd.DataFrame:
    """The operations of one component in their order: ``error`` of each, null where it is applied."""
    p = p.sort_values(["seq", "node_id", "parent_id"], kind="stable", na_position="first")
    value = lambda x: x if isinstance(x, str) else None
    up, below, there, out = {}, {}, set(), []

    def point(node, to) -> None:
        old = up.get(node)
        if old is not None:
            below[old] -= 1
        up[node] = to
        if to is not None:
            below[to] = below.get(to, 0) + 1

    for node, known, anchor in zip(p["node_id"], p["known"], p["anchor"]):
        if known and node not in there:
            there.add(node)
            point(node, value(anchor))
    for op, node, parent, parent_known, to in zip(p["op"], p["node_id"], p["parent_id"], p["parent_known"], p["parent_anchor"]):
        parent, to, error = value(parent), value(to), None
        if op == "register" and node in there:
            error = "exists"
        elif op == "link" and node not in there:
            error = "missing_node"
        elif parent is not None and parent == node and op == "link":
            error = "self"
        elif parent is not None and not parent_known and parent not in there:
            error = "missing_parent"
        elif op == "link" and (to == node or below.get(node)):  # what has no moving node below it is above no other
            at = to
            while at is not None and at != node:
                at = up.get(at)
            error = "cycle" if at is not None else None
        out.append(error)
        if error is None:
            there.add(node)
            point(node, to)
    return p[["seq", "op", "node_id", "parent_id"]].assign(error=out)


def lineage_results(edges: DataFrame, operations: DataFrame) -> DataFrame:
    """``error`` of each operation (seq, op, node_id, parent_id) as if they were applied one after the other in order of ``seq``; null where it is applied.

    ``register`` adds a node (``exists``, ``missing_parent``); ``link`` gives a node a new parent, null for none (``missing_node``, ``self``,
    ``missing_parent``, and ``cycle`` if the node is at or above the parent at that moment). Nodes that no operation names keep their parents, so each path up
    is contracted to the nodes that may move (``anchors``), and operations that share no such node, however far, cannot touch each
    other (``components``). Each component is applied in order by one task, which holds its operations: their order is what decides.
    Operations of equal ``seq`` come in order of node_id and parent_id, as text. A null node_id is ``missing_node``. Of several edges of a node that with the smallest parent counts.
    """
    ops = materialise(operations.select("seq", "op", "node_id", "parent_id"), "operations")
    kind = dict(ops.dtypes)
    moving = ops.select("node_id").filter("node_id is not null").distinct()
    held = materialise(anchors(edges, moving), "anchored")
    above = held.select(F.col("node_id").alias("parent_id"), F.lit(True).alias("parent_known"), F.col("anchor").alias("parent_anchor"))
    own = edges.groupBy("node_id").agg(F.min("parent_id").alias("parent_id")).join(moving, "node_id", "left_semi").join(above, "parent_id", "left").select("node_id", F.lit(True).alias("known"), F.col("parent_anchor").alias("anchor"))
    fresh = moving.select(F.col("node_id").alias("parent_id"), F.col("node_id").alias("_self"))  # a parent that the batch registers is its own anchor
    rows = ops.join(above, "parent_id", "left").join(fresh, "parent_id", "left").join(own, "node_id", "left").withColumn("parent_anchor", F.coalesce("parent_anchor", "_self"))
    rows = materialise(rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("parent_known", "known")}).drop("_self"), "operations")
    links = rows.filter("node_id is not null").select(F.col("node_id").alias("a"), F.explode(F.array("parent_anchor", "anchor")).alias("b"))
    found = components(links).select(F.col("node").alias("node_id"), "component")
    rows = rows.join(found, "node_id", "left").withColumn("component", F.coalesce("component", "node_id"))
    text = {c: F.col(c).cast("string") for c in ("node_id", "parent_id", "parent_anchor", "anchor", "component")}
    done = rows.filter("node_id is not null").withColumns(text).groupBy("component").applyInPandas(_applied, f"seq {kind['seq']}, op string, node_id string, parent_id string, error string")
    done = done.select("seq", "op", *(F.col(c).cast(kind[c]).alias(c) for c in ("node_id", "parent_id")), "error")
    return done.union(ops.filter("node_id is null").select("seq", "op", "node_id", "parent_id", F.lit("missing_node")))


def _links(proposed: DataFrame) -> DataFrame:
    """The operations of a batch of links; without a ``seq`` they come in order of node_id and parent_id."""
    seq = F.col("seq" if "seq" in proposed.columns else "node_id").alias("seq")
    return proposed.select(seq, F.lit("link").alias("op"), "node_id", "parent_id")


def link_errors(edges: DataFrame, proposed: DataFrame) -> DataFrame:
    """The refused links (node_id, parent_id) of a batch and why; see ``lineage_results``."""
    return lineage_results(edges, _links(proposed)).filter("error is not null").select("node_id", "parent_id", "error")


def relink(edges: DataFrame, proposed: DataFrame) -> DataFrame:
    """Edges after the links of ``proposed`` (node_id, parent_id: null detaches; seq) are applied one after the other; refused ones change nothing. Other columns stay."""
    done = lineage_results(edges, _links(proposed)).filter("error is null")
    last = F.max_by(F.struct("parent_id"), F.struct("seq", F.col("parent_id").cast("string")))
    new = materialise(done.groupBy("node_id").agg(last.alias("_new")), "links")
    return edges.join(new, "node_id", "left").withColumn("parent_id", F.when(F.col("_new").isNotNull(), F.col("_new.parent_id")).otherwise(F.col("parent_id"))).select(*edges.columns)


def register(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``edges`` with the nodes of ``nodes`` (seq, node_id, parent_id) that can be registered one after the other; columns that they lack are null."""
    done = lineage_results(edges, nodes.select("seq", F.lit("register").alias("op"), "node_id", "parent_id")).filter("error is null")
    return edges.unionByName(done.select("node_id", "parent_id"), allowMissingColumns=True)


def without_nodes(edges: DataFrame, gone: DataFrame) -> DataFrame:
    """Edges after nodes are removed; their children become roots."""
    g = gone.select("node_id").distinct()
    kept = edges.join(g, "node_id", "left_anti")
    return kept.join(g.select(F.col("node_id").alias("parent_id"), F.lit(True).alias("_gone")), "parent_id", "left").withColumn("parent_id", F.when(F.col("_gone").isNull(), F.col("parent_id"))).drop("_gone")


def edit_tags(tags: DataFrame, changes: DataFrame, key: str = "strategy_id") -> DataFrame:
    """Tags after a batch of changes (key, add, remove: arrays), sorted and distinct, and ``error``.

    A change that would leave more than MOST_TAGS tags is refused: the tags stay as they were, and ``error`` says why.
    """
    none = F.array().cast("array<string>")
    j = tags.join(changes, key, "full_outer").withColumn("_old", F.coalesce("tags", none))
    new = F.array_sort(F.array_except(F.array_union(F.col("_old"), F.coalesce("add", none)), F.coalesce("remove", none)))
    j = j.withColumn("_new", new).withColumn("error", F.when((F.size("_new") > MOST_TAGS) & F.col("add").isNotNull(), f"would exceed {MOST_TAGS} tags"))
    return j.select(key, F.when(F.col("error").isNull(), F.col("_new")).otherwise(F.array_sort(F.array_distinct("_old"))).alias("tags"), "error")


def rename_tag(tags: Column, old: str, new: str) -> Column:
    return F.array_sort(F.array_distinct(F.transform(tags, lambda t: F.when(t == old, new).otherwise(t))))


def fingerprint_tags(s: DataFrame) -> Column:
    n, r, dd = F.coalesce(F.col("trades"), F.lit(0)), F.coalesce(F.col("oos_is"), F.lit(0.0)), F.coalesce(F.col("drawdown_pct"), F.lit(0.0))
    return F.array_sort(F.array(
        F.when(n >= 1000, "trades>1000").when(n >= 500, "trades>500").when(n >= 100, "trades>100").otherwise("low_trades"), F.when(dd > 25, "high_dd").when(dd > 10, "mod_dd").otherwise("low_dd"), F.when(r >= 0.5, "oos>0.5").when(r >= 0.3, "oos>0.3").otherwise("weak_oos"),
    ))


def digest(values: list[Column], step: float = 0.05) -> Column:
    """16 hex digits over the values rounded to multiples of ``step``; missing ones are left out."""
    rounded = [F.when(v.isNotNull(), F.format_string(f"{k}=%d", F.bround(v / step, 0).cast("long"))) for k, v in enumerate(values)]
    return F.substring(F.sha2(F.concat_ws(",", *rounded), 256), 1, 16)


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))


def curve_digest(curve: Column, samples: int = 16) -> Column:
    """Values of a curve at ``samples`` even places, or all of a shorter one, to 6 digits; empty for a missing one."""
    c = F.coalesce(curve, F.array().cast("array<double>"))
    picked = F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: F.get(c, F.floor(i * (F.size(c) / samples)).cast("int")))
    return F.transform(F.when(F.size(c) <= samples, c).otherwise(picked), lambda x: F.round(x, 6))


def sampled_curves(rows: DataFrame, value: str, order: list[str], key: str = "strategy_id", samples: int = 16) -> DataFrame:
    """(key, curve): the places that ``curve_digest`` takes of the running sum of ``value``, so that no whole curve is gathered."""
    w = Window.partitionBy(key)
    run = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(key, F.sum(value).over(run).alias("v"), (F.count(F.lit(1)).over(run) - 1).alias("i"), F.count(F.lit(1)).over(w).alias("n"))
    place = F.ceil(F.col("i") * samples / F.col("n"))  # the only one that can fall on row i
    taken = (F.col("n") <= samples) | ((place < samples) & (F.floor(place * F.col("n") / samples) == F.col("i")))
    picked = rows.filter(taken).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("c"))
    return picked.select(key, F.transform("c", lambda x: F.round(x["v"], 6)).alias("curve"))


def whole_fingerprints(s: DataFrame, key: str = "strategy_id") -> DataFrame:
    """(key, tags, signature, curve) from metrics, ``params`` (canonical text), ``direction`` and ``curve`` (array).

    Tags add profit factor and direction; the signature joins digests of the parameters and of five metrics.
    """
    pf = F.coalesce("profit_factor", F.lit(0.0))
    more = F.array(F.when(pf >= 2.0, "pf>2.0").when(pf >= 1.5, "pf>1.5").when(pf >= 1.2, "pf>1.2").otherwise("low_pf"), F.when(F.col("direction") != "", F.concat(F.lit("dir:"), "direction")))
    metrics = digest([F.col(c) for c in ("net_profit", "profit_factor", "drawdown_pct", "oos_is", "fitness_oos")])
    params = F.substring(F.sha2(F.coalesce("params", F.lit("{}")), 256), 1, 16)
    return s.select(key, F.array_sort(F.array_compact(F.concat(fingerprint_tags(s), more))).alias("tags"), F.concat_ws(".", params, metrics).alias("signature"), curve_digest(F.col("curve")).alias("curve"))


def curve_correlation(a: Column, b: Column) -> Column:
    """Pearson over the common length; 0 under three values or without variance."""
    n = F.least(F.size(a), F.size(b))

    def centred(c: Column) -> Column:
        x = F.slice(c, 1, n)
        mean = F.aggregate(x, F.lit(0.0), lambda t, v: t + v) / n
        return F.transform(x, lambda v: v - mean)

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda t, v: t + v)

    x, y = centred(a), centred(b)
    size = F.sqrt(dot(x, x) * dot(y, y))
    return F.when((n >= 3) & (size > 0), dot(x, y) / size).otherwise(0.0)


def similarity(tags_a: Column, tags_b: Column, correlation: Column) -> Column:
    """Of two fingerprints of different signature, to 4 digits."""
    return F.round(0.6 * jaccard(tags_a, tags_b) + 0.4 * F.greatest(correlation, F.lit(0.0)), 4)


SIMILARITY = [(">=", 0.95, "near_identical"), (">=", 0.85, "very_similar"), (">=", 0.70, "similar")]


#: Classes that settle their owners at once, and rows that are held against them.
LOT = 1000


def _similar(rows: pd.DataFrame, heads: pd.DataFrame, threshold: float) -> np.ndarray:
    """Whether each of ``rows`` (signature, tags, curve) is similar to each of ``heads``, as a matrix."""

    def coded(tags: pd.Series) -> tuple[np.ndarray, list[frozenset]]:
        number: dict[frozenset, int] = {}
        return np.array([number.setdefault(frozenset(t), len(number)) for t in tags], int), list(number)

    (at, sets), (head_at, head_sets) = coded(rows["tags"]), coded(heads["tags"])
    alike = np.array([[len(x & y) / max(len(x | y), 1) for y in head_sets] for x in sets])[at][:, head_at]
    cor = np.zeros(alike.shape)
    sizes, head_sizes = (np.array([len(x) for x in f["curve"]], int) for f in (rows, heads))
    for a in np.unique(sizes):
        for b in np.unique(head_sizes):
            n, mine, theirs = min(a, b), np.flatnonzero(sizes == a), np.flatnonzero(head_sizes == b)
            if n < 3:
                continue
            x, y = (np.array([np.asarray(f["curve"].iloc[i], float)[:n] for i in where]) for f, where in ((rows, mine), (heads, theirs)))
            x, y = x - x.mean(axis=1, keepdims=True), y - y.mean(axis=1, keepdims=True)
            size = np.sqrt(np.outer((x * x).sum(axis=1), (y * y).sum(axis=1)))
            cor[np.ix_(mine, theirs)] = np.divide(x @ y.T, size, out=np.zeros(size.shape), where=size > 0)
    near = np.floor((0.6 * alike + 0.4 * np.maximum(np.nan_to_num(cor), 0)) * 10_000 + 0.5) / 10_000 >= threshold - 1e-9
    return near | (rows["signature"].to_numpy()[:, None] == heads["signature"].to_numpy()[None, :])


def greedy_duplicates(fp: DataFrame, threshold: float = 0.85, key: str = "strategy_id") -> DataFrame:
    """(key, owner): groups in order of the key; a row belongs to the least owner that is similar enough, and owns itself if there is none.

    Similarity is 1 on an equal signature, else 0.6 tag Jaccard + 0.4 curve correlation (0 at least), to 4 digits.
    Equal fingerprints are one class. In each round the first LOT open classes in order settle which of them are owners, and every
    open class takes the least of these that it is similar to, as a product of matrices; the rest stays open. So work is classes by owners, not pairs,
    and only a lot is ever held beside a batch of rows.
    """
    same = ["signature", "tags", "curve"]
    c = materialise(fp.groupBy(*same).agg(F.min(key).alias("id")), "classes")
    kind = dict(c.dtypes)["id"]
    open_rows, settled = c.select("id", *same), []
    while lot := open_rows.orderBy("id").limit(LOT).collect():  # at most LOT rows
        lot = pd.DataFrame([r.asDict() for r in lot])
        is_head = np.zeros(len(lot), bool)
        near = _similar(lot, lot, threshold)
        for n in range(len(lot)):
            is_head[n] = not (near[n, :n] & is_head[:n]).any()
        heads = lot[is_head].reset_index(drop=True)

        def owned(batches, heads=heads):
            for rows in batches:
                owner = np.full(len(rows), None, object)
                for at in range(0, len(rows), LOT):
                    near = _similar(rows.iloc[at : at + LOT], heads, threshold)
                    hit = near.any(axis=1)
                    owner[at : at + LOT][hit] = heads["id"].to_numpy()[near.argmax(axis=1)[hit]]
                yield rows.assign(owner=owner)

        done = materialise(open_rows.mapInPandas(owned, f"{open_rows.schema.simpleString()[7:-1]}, owner {kind}"), "owned")
        settled.append(done.filter("owner is not null").select("id", "owner"))
        open_rows = done.filter("owner is null").drop("owner")
    least = reduce(DataFrame.union, settled) if settled else c.select("id", F.col("id").alias("owner"))
    named = c.join(least, "id", "left").select(*same, F.coalesce("owner", "id").alias("owner"))
    return fp.join(named, same).select(key, "owner")


def combined_digest(manifest: DataFrame, by: Column, sha: str) -> DataFrame:
    """Per ``by`` one digest of many SHA-256 values (hex), whatever their order: four pieces of 60 bits of each are summed, and the sums hashed."""
    pieces = [F.sum(F.conv(F.substring(sha, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")).cast("string") for k in range(4)]
    return manifest.groupBy(by).agg(F.sha2(F.concat_ws(",", *pieces), 256).alias("combined"), F.count(F.lit(1)).alias("files"))


def manifest_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Files of two manifests (name, sha): added, removed or changed."""
    j = a.select("name", F.col("sha").alias("sa")).join(b.select("name", F.col("sha").alias("sb")), "name", "full_outer")
    state = F.when(F.col("sa").isNull(), "added").when(F.col("sb").isNull(), "removed").when(F.col("sa") != F.col("sb"), "changed")
    return j.withColumn("state", state).filter("state is not null").select("name", "state")
