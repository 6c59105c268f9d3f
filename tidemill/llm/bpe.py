"""Byte-level BPE with a hierarchical-bitmap rank queue, applied to whole texts in Arrow batches."""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import documents, small_batches

RANKS = "byte_bpe_multi_50k.tiktoken"
#: A bitmap word has 2^SHIFT bits; the summary word has a bit for each of them.
SHIFT = 8
MASK = (1 << SHIFT) - 1
#: Pre-tokens whose ids a worker keeps at least, after the last look-up of each; it holds twice as many at most.
KEPT = 500_000


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the lowest-ranked adjacent pair is merged, leftmost first, until none is left.

    Positions wait in a bucket under their pair's merge rank. A bit of ``low[w]`` says that rank
    ``w * 2^SHIFT + bit`` has a bucket, a bit of ``top`` that ``low[w]`` is not empty, so finding the first
    set bit of both gives the next rank. The parts form a linked list over byte positions. A queued
    position is stale, and skipped, if its part is gone or its pair has changed since: then its pair has
    another rank, or none. All of this is written out in one function, which runs once a distinct pre-token.
    """
    get = ranks.get
    whole = get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair = [get(piece[i : i + 2]) for i in range(n - 1)]
    pair.append(None)
    buckets: dict[int, list[int]] = {}
    low: dict[int, int] = {}
    top = 0
    for i, r in enumerate(pair):
        if r is not None:
            if r in buckets:
                buckets[r].append(i)
            else:
                buckets[r] = [i]
                w = r >> SHIFT
                low[w] = low.get(w, 0) | 1 << (r & MASK)
                top |= 1 << w
    while top:
        w = (top & -top).bit_length() - 1
        bits = low[w]
        first = bits & -bits
        if bits == first:
            del low[w]
            top ^= 1 << w
        else:
            low[w] = bits ^ first
        rank = (w << SHIFT) + first.bit_length() - 1
        places = buckets.pop(rank)
        if len(places) > 1:
            places.sort()
        lower = False
        for i in places:
            if pair[i] != rank:
                continue
            if lower:  # a lower rank has come up meanwhile: the rest waits
                again = ((i, rank),)
            else:
                j = after[i]  # merge the part at i with the part at j
                k = after[i] = after[j]
                pair[j] = None
                if k < n:
                    before[k] = i
                    r = pair[i] = get(piece[i : after[k]])
                else:
                    r = pair[i] = None
                h = before[i]
                if h >= 0:
                    q = pair[h] = get(piece[h:k])
                    again = ((i, r), (h, q))
                else:
                    again = ((i, r),)
            for at, r in again:
                if r is not None:
                    if r < rank:
                        lower = True
                    if r in buckets:
                        buckets[r].append(at)
                    else:
                        buckets[r] = [at]
                        w = r >> SHIFT
                        low[w] = low.get(w, 0) | 1 << (r & MASK)
                        top |= 1 << w
    out, i = [], 0
    while i < n:
        j = after[i]
        out.append(ranks[piece[i:j]])
        i = j
    return out


@cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


#: Beyond Latin Extended-B.
_FAR = re.compile("[^\x00-\u024f]")


def _latin_split():
    """The public pattern with its classes written out for the code points below 0x250."""
    kind = lambda k: "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == k)
    letter, number, blank = kind("L"), kind("N"), r"\x09-\x0d\x20\x85\xa0"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{blank}{letter}{number}]+|[{blank}]+(?![^{blank}])|[{blank}]+").findall


class Encoder(dict):
    """Pre-token to its ids as little-endian unsigned 32-bit integers. When KEPT are held they become the older generation, from which what is looked up comes back."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.ranks, self.split = load_ranks(path), regex.compile(pattern).findall
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for piece, i in self.ranks.items():
            self.bytes_of[i] = piece
        self.bytes_of = np.array(self.bytes_of, dtype=object)
        # Split anything with the pattern itself; texts of Latin letters alone go by an equal one for the standard module, in half the time.
        self.latin = _latin_split() if pattern == public_tokenizers.PATTERN else None

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT:
            self.older = dict(self)
            self.clear()
        packed = self.older.get(piece)
        if packed is None:
            packed = b"".join([i.to_bytes(4, "little") for i in merge(piece.encode(), self.ranks)])
        self[piece] = packed
        return packed

    def pieces(self, text: str) -> list[str]:
        return self.split(text) if self.latin is None or _FAR.search(text) else self.latin(text)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(self.bytes_of[np.frombuffer(packed, "<u4")].tolist())


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (packed as unsigned 32-bit little-endian), decoded (bytes) of every document.

    A null text is empty and has no ids. ``path`` must exist on the executors, like the package of
    vocabularies itself. Rows with a null doc_id take no part; repeated rows give repeated results.
    """
    return _coded(docs, path, lambda ids, back: (ids, back), "ids binary, decoded binary")


def _coded(docs: DataFrame, path: str | None, what, schema: str) -> DataFrame:
    path = path or public_tokenizers.path(RANKS)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n, one, two = [], [], []
            for text in b.column(1):
                packed = enc.encode(text.as_py() or "")
                first, second = what(packed, enc.decode(packed))
                n.append(len(packed) // 4)
                one.append(first)
                two.append(second)
            kind = pa.binary() if "binary" in schema else pa.string()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(one, kind), pa.array(two, kind)], names=["doc_id", "n_tokens", *(x.split()[0] for x in schema.split(", "))])

    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_tokens long, {schema}")


def _digests(ids: bytes, back: bytes) -> tuple[str, str]:
    return hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the ids and of the decoded bytes of all documents."""
    return _coded(documents(spark, sf_dir), None, _digests, "ids_sha256 string, decoded_sha256 string")
