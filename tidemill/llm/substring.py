"""Substring dedup: suffix automata of reference shards, documents streamed through them for matching statistics."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import documents, materialise, small_batches

#: Words of a window; words of the shingle whose least hash names a window's anchor.
SPAN, GRAM = 50, 8
#: Words that one shard's automaton reads; windows of an anchor beyond which they are counted instead, and by how many their join is salted.
SHARD_WORDS, HOT_WINDOWS, SALT_WINDOWS = 250_000, 40_000, 20_000
#: Anchors, or spans, that a broadcast table may hold (32 bytes each, and a row counts as two: under 100 MB).
BROADCAST_ITEMS = 3_000_000
KEPT = 300_000
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


@cache
def _memo() -> _WordHash:
    return _WordHash()


def word_hashes(text: str | None) -> tuple[list[bytes], np.ndarray]:
    words = (text or "").encode("utf-8", "replace").split()  # on bytes, split() knows the six ASCII blanks alone
    return words, np.fromiter(map(_memo().__getitem__, words), np.uint64, len(words))


def anchors(h: np.ndarray, span: int = SPAN, gram: int = GRAM) -> np.ndarray:
    """The anchor of every window: the least hash of its ``gram``-word shingles, so equal windows have equal anchors."""
    if len(h) < span:
        return np.zeros(0, np.uint64)
    n = len(h) - gram + 1
    g = np.zeros(n, np.uint64)
    for j in range(gram):
        g = (g ^ h[j : j + n]) * _ODD[j % 2]
        g ^= g >> np.uint64(31)
    width, best, have = span - gram + 1, g, 1
    while have < width:  # least of ever wider ranges
        step = min(have, width - have)
        best = np.minimum(best[: len(best) - step], best[step:])
        have += step
    return best


def window_digests(h: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit polynomial hashes of every window of ``span`` words."""
    out = []
    for base in _ODD:
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        powers = np.cumprod(np.full(len(h), base, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers)])
        back = np.cumprod(np.full(len(h) - span + 1, inverse, np.uint64))
        out.append(((sums[span:] - sums[:-span]) * back).view(np.int64))
    return out[0], out[1]


class SuffixAutomaton:
    """Suffix automaton of several words sequences; ``stream`` gives the places where a match of ``span`` words ends."""

    def __init__(self) -> None:
        self.next, self.link, self.length = [{}], [-1], [0]

    def _new(self, length: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of q for the strings that come to it from p by c and are no longer."""
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[int]) -> None:
        last = 0
        nxt, link, length = self.next, self.link, self.length
        for c in words:
            q = nxt[last].get(c)
            if q is not None:  # known from another sequence
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
                continue
            cur, p = self._new(length[last] + 1, 0, {}), last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = cur

    def stream(self, words: list[int], span: int) -> list[int]:
        """Starts of the windows of ``span`` words that some added sequence holds."""
        nxt, link, length = self.next, self.link, self.length
        v = size = 0
        out = []
        for i, c in enumerate(words):
            while v and c not in nxt[v]:
                v = link[v]
                size = length[v]
            q = nxt[v].get(c)
            if q is None:
                size = 0
            else:
                v, size = q, size + 1
                if size >= span:
                    out.append(i - span + 1)
        return out


def _ranges(starts: np.ndarray, span: int) -> list[tuple[int, int]]:
    """The words that windows with these ascending starts cover, as disjoint ranges."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > span) + 1
    return [(int(s[0]), int(s[-1]) + span) for s in np.split(starts, cut)]


def _runs(a: np.ndarray) -> Iterator[tuple[int, int]]:
    cut = np.flatnonzero(a[1:] != a[:-1]) + 1
    yield from zip([0, *cut.tolist()], [*cut.tolist(), len(a)])


def _join_by_items(left: DataFrame, right: DataFrame, on: list[str], how: str, items: str) -> DataFrame:
    """Join that broadcasts ``right`` only if the sum of its array sizes has been found to be under the bound, and shuffles otherwise."""
    held = right.agg(F.sum(F.size(items) + 2)).head()[0] or 0
    return left.join(F.broadcast(right) if held <= BROADCAST_ITEMS else right, on, how)


def shared_anchors(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, anchors: each document's anchors that another doc_id has too, with ``salts``, zero unless the anchor is hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys, found, counts = [], [], [], []
            for d, k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                a, n = np.unique(anchors(word_hashes(t.as_py())[1]), return_counts=True)
                ids.append(np.full(len(a), d, np.int64))
                keys.append(np.full(len(a), k, np.int64))
                found.append(a.view(np.int64))
                counts.append(n.astype(np.int32))
            cat = lambda x, kind=np.int64: pa.array(np.concatenate(x) if x else np.zeros(0, kind))
            yield pa.RecordBatch.from_arrays([cat(ids), cat(keys), cat(found), cat(counts, np.int32)], names=["doc_id", "tkey", "anchor", "n"])

    every = materialise(docs.mapInArrow(run, "doc_id long, tkey long, anchor long, n int"), "anchors")
    shared = every.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), F.sum("n").alias("n")).filter("a < z")
    salts = F.when(F.col("n") > HOT_WINDOWS, F.ceil(F.col("n") / SALT_WINDOWS)).otherwise(0).cast("int")
    held = every.select("doc_id", "tkey", "anchor").join(shared.select("anchor", salts.alias("salts")), "anchor")
    return held.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("anchor", "salts")).alias("anchors"))  # no more than the document's own


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, spans: word ranges covered by windows that start in a document with a smaller doc_id too.

    Equal windows have equal anchors, so only windows whose anchor occurs in two documents need a look. The
    stretch of words around such an anchor goes to the shard of the anchor: shards are the reference, cut to
    SHARD_WORDS, and travel by shuffle, since the reference is the whole corpus and no bound for a broadcast holds.
    In a shard documents stream in the order of doc_id: matching statistics against the automaton
    of all smaller ones give the repeated windows; words of new windows are then added to it.
    An anchor of over HOT_WINDOWS windows would make a shard without bound: its windows are digested
    and the digests' smallest doc_ids found by a pre-aggregated groupBy, which gives the same windows; equal
    windows have one anchor, whose number of salts spreads their join.
    """
    small_batches(docs.sparkSession)
    lists = materialise(shared_anchors(docs), "shared-anchors")
    with_text = _join_by_items(docs, lists, ["doc_id", "tkey"], "inner", "anchors").select("doc_id", "tkey", "text", "anchors.anchor", "anchors.salts")
    names = ["doc_id", "tkey", "start", "anchor", "words", "d1", "d2", "salts"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for d, k, t, held, hot in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), b.column(4)):
                h = word_hashes(t.as_py())[1]
                a = anchors(h)
                known = np.asarray(held.values).view(np.uint64)
                heat = dict(zip(known.tolist(), hot.values.to_pylist()))
                digests = window_digests(h) if any(heat.values()) else None
                for x, y in _runs(a):
                    salts = heat.get(int(a[x]))
                    if salts is None:
                        continue
                    if salts:
                        out += [(d, k, s, None, None, p, q, salts) for s, p, q in zip(range(x, y), digests[0][x:y].tolist(), digests[1][x:y].tolist())]
                    else:
                        out.append((d, k, x, int(a[x : x + 1].view(np.int64)[0]), h[x : y + SPAN - 1].tobytes(), None, None, None))
            cols = list(zip(*out)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    pieces = materialise(with_text.mapInArrow(cut, "doc_id long, tkey long, start int, anchor long, words binary, d1 long, d2 long, salts int"), "pieces")
    cold = pieces.filter("anchor is not null")
    words = cold.agg(F.sum(F.octet_length("words") / 8)).head()[0] or 0
    shards = max(1, int(words // SHARD_WORDS))

    def match(p: pd.DataFrame) -> pd.DataFrame:
        automaton, out = SuffixAutomaton(), []
        p = p.sort_values(["doc_id", "tkey", "start"], kind="stable")
        ids, keys, starts = p["doc_id"].tolist(), p["tkey"].tolist(), p["start"].tolist()
        stretches = [np.frombuffer(w, np.uint64) for w in p["words"]]
        i = 0
        while i < len(ids):
            j, fresh = i, []
            while j < len(ids) and ids[j] == ids[i]:  # all of a document against smaller ones, then it is added itself
                line = stretches[j].tolist()
                old = automaton.stream(line, SPAN)
                new = np.ones(len(line) - SPAN + 1, bool)
                new[old] = False
                out += [(ids[j], keys[j], starts[j] + a, starts[j] + z) for a, z in _ranges(np.array(old, np.int64), SPAN)]
                fresh += [line[a:z] for a, z in _ranges(np.flatnonzero(new), SPAN)]
                j += 1
            for line in fresh:
                automaton.add(line)
            i = j
        return pd.DataFrame(out, columns=["doc_id", "tkey", "a", "z"])

    spans = cold.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInPandas(match, "doc_id long, tkey long, a long, z long")
    hot = pieces.filter("anchor is null").select("doc_id", "tkey", "start", "d1", "d2", "salts")
    first = hot.groupBy("d1", "d2", "salts").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    first = first.select("d1", "d2", "first", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    hot = hot.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.col("salts")).cast("int"))
    again = hot.join(first, ["d1", "d2", "salt"]).filter("first < doc_id").select("doc_id", "tkey", F.col("start").cast("long").alias("a"), (F.col("start") + SPAN).cast("long").alias("z"))
    return spans.union(again).groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("a", "z")).alias("spans"))


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text of the kept words), and its digest kept_sha256, for every row with a doc_id.

    A null text has no words. Rows that repeat a doc_id are no references for each other. Documents
    under SPAN words, and an empty table, lose nothing. Other columns are ignored.
    """
    return _kept(docs, True)


def _kept(docs: DataFrame, texts: bool) -> DataFrame:
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("tkey"), F.col("text").cast("string").alias("text"))
    spans = materialise(repeated_spans(rows), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, kept, digest = [], [], [], []
            for t, s in zip(b.column(1), b.column(2)):
                words = (t.as_py() or "").encode("utf-8", "replace").split()
                n.append(len(words))
                if s.is_valid:
                    drop = np.zeros(len(words), bool)
                    for a, z in zip(*(x.to_pylist() for x in s.values.flatten())):
                        drop[a:z] = True
                    words = [w for w, d in zip(words, drop.tolist()) if not d]
                gone.append(n[-1] - len(words))
                line = b" ".join(words)
                kept.append(line.decode() if texts else None)
                digest.append(hashlib.sha256(line).hexdigest())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(cols[: 4 + texts], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"][: 4 + texts])

    joined = _join_by_items(rows, spans, ["doc_id", "tkey"], "left", "spans").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dedup_substrings`` of all documents, without the kept texts."""
    return _kept(documents(spark, sf_dir), False)


ORACLE = {
    "op1_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50),
wins AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM starts),
firsts AS (SELECT h, min(doc_id) AS m FROM wins GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM wins JOIN firsts USING (h) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS k FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(k, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""
}
