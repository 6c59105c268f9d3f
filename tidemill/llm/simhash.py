"""SimHash near-dedup: fingerprints of 3-word shingles, linked within a Hamming radius by pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import documents, free_name, materialise, small_batches

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Members of a bucket that are compared in one piece; larger buckets are compared block by block.
BLOCK = 4096
#: Reference fingerprints of the distance table.
PIVOTS = np.random.default_rng(7).integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.arange(16, dtype=np.uint64) % np.uint64(2)


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """64 bits, each 1 if set in over half of the shingles' XXH64 values; zero without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: lower() and split() know ASCII alone
    if not words:
        return 0
    if len(words) <= n:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    stops = np.cumsum(sizes) - 1
    starts = (stops - sizes + 1)[: len(words) - n + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops[n - 1 :].tolist())], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (signed 64-bit) of every row with a doc_id; null texts are empty."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py()) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def distance_table(fp: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each pivot."""
    return np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def pairs_within(fp: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the pairs (x[i], y[i]) lie within RADIUS: the table discards first, the exact distance verifies what is left."""
    table = distance_table(fp)
    near = np.flatnonzero(np.abs(table[x] - table[y]).max(1, initial=0) <= RADIUS)
    return near[np.bitwise_count(fp[x[near]] ^ fp[y[near]]) <= RADIUS]


def pivot_links(fp: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links among the members ``left`` or between ``left`` and ``right`` of one bucket, as index pairs.

    Each member has a row of distances to the pivots. By the triangle inequality two members within
    RADIUS differ by at most RADIUS in every coordinate: members are sorted by the first one, a
    member is held only against the window around it, the largest difference over all pivots discards
    most of those, and the exact distance verifies the rest. A linked member leaves the table and
    is searched from in turn, so a bucket gives at most one link a member.
    """
    table = distance_table(fp)
    one_side = len(right) == 0
    free = [left, left if one_side else right]
    free = [f[np.argsort(table[f, 0], kind="stable")] for f in free]
    if one_side:
        free[1] = free[0]
    side = np.zeros(len(fp), np.int8)
    side[right] = 1
    links: list[tuple[int, int]] = []

    def take(x: int, s: int) -> list[int]:
        f = free[s]
        if not len(f):
            return []
        first = table[f, 0]
        a, b = np.searchsorted(first, table[x, 0] - RADIUS, "left"), np.searchsorted(first, table[x, 0] + RADIUS, "right")
        near = f[a:b]
        near = near[np.abs(table[near] - table[x]).max(1, initial=0) <= RADIUS]
        near = near[np.bitwise_count(fp[near] ^ fp[x]) <= RADIUS]
        if len(near):
            free[s] = f[~np.isin(f, near, assume_unique=True)]
            if one_side:
                free[1 - s] = free[s]
        return near.tolist()

    for root in left.tolist():
        if not (free[0] == root).any():
            continue
        free[0] = free[0][free[0] != root]
        if one_side:
            free[1] = free[0]
        todo = [root]
        while todo:
            x = todo.pop()
            found = take(x, 0 if one_side else 1 - int(side[x]))
            links += [(x, y) for y in found]
            todo += found
    return links


def _masks() -> list[int]:
    """Bits of the pigeonhole tables: one of four 16-bit bands agrees, and of the other 48 bits one of four 12-bit bands."""
    out = []
    for band in range(4):
        rest = [b for b in range(64) if b // 16 != band]
        for part in range(4):
            out.append(sum(1 << b for b in [*range(band * 16, band * 16 + 16), *rest[part * 12 : part * 12 + 12]]))
    return out


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links between the smallest doc_ids of distinct fingerprints, enough to connect all that lie within RADIUS.

    ``fps`` has one row a fingerprint: fp, rep. Two fingerprints within three bits agree on the 28
    bits of at least one of sixteen tables, so buckets of equal bits lose no link. Pivot coordinates alone
    cannot part the rows (they spread by 4 and the radius is 3), hence the tables deal out and the pivots discard.
    A bucket over BLOCK members is dealt as all pairs of its blocks, each pair a row of its own.
    """
    signed = [m - (1 << 64) if m >> 63 else m for m in _masks()]
    keyed = fps.select("fp", "rep", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed))).alias("t", "key"))
    multi = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = keyed.join(multi, ["t", "key"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    held = held.withColumn("nb", blocks).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    pair = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    dealt = held.select("t", "key", *pair, F.struct("rep", "fp", "block").alias("m"))
    buckets = dealt.groupBy("t", "key", "i", "j").agg(F.collect_list("m").alias("ms")).filter(F.size("ms") > 1)  # two blocks at most, BLOCK on average each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ms = b.column("ms")
            at, flat = np.asarray(ms.offsets), ms.values
            rep, fp, block = (np.asarray(flat.field(c)) for c in ("rep", "fp", "block"))
            fp, i, j = fp.view(np.uint64), np.asarray(b.column("i")), np.asarray(b.column("j"))
            two = (np.diff(at) == 2) & (i == j)  # by far the most: all of the batch at once
            x = at[:-1][two].astype(np.int64) - at[0]
            base = slice(int(at[0]), int(at[-1]))
            found = x[pairs_within(fp[base], x, x + 1)] + at[0]
            a, z = rep[found].tolist(), rep[found + 1].tolist()
            for k in np.flatnonzero(~two).tolist():
                here = np.arange(at[k], at[k + 1])
                here = here[np.argsort(rep[here], kind="stable")]
                every, side = np.arange(len(here)), block[here]
                forest = pivot_links(fp[here], every, every[:0]) if i[k] == j[k] else pivot_links(fp[here], every[side == i[k]], every[side == j[k]])
                a += [int(rep[here[p]]) for p, _ in forest]
                z += [int(rep[here[q]]) for _, q in forest]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=["a", "b"])

    small_batches(fps.sparkSession)
    return buckets.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    Alternating large-star and small-star steps: every step joins each node's neighbours to the
    smallest one seen, is written to the shared folder, and ends when nothing changes. Repeated edges, loops
    and edges given both ways count once; without edges there is no row.
    """
    edges = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = materialise(small.filter("u <> v").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row with a doc_id.

    Equal fingerprints (all texts without words have zero) are one class, named by its smallest doc_id;
    only classes are compared. Repeated rows get equal results; an empty table gives none.
    """
    fps = materialise(fingerprints(docs), "fingerprints")
    classes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    found = components(links(classes))
    named = classes.join(found, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with its own columns, whatever their names.

    All texts without words are one class. Rows with a null doc_id stay all; rows that repeat a doc_id stay or go
    together. An empty table stays empty.
    """
    gone = free_name(docs, "_dropped")
    dropped = near_groups(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(dropped, F.col("doc_id").cast("long") == F.col(gone), "left_anti")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``near_groups`` of all documents."""
    return near_groups(documents(spark, sf_dir))
