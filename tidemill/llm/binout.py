"""Training-order materialisation: a keyed Feistel permutation gives every sequence a slot; shards are fixed-stride binary files."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import documents, join_checked, materialise, released_shuffles, scratch, small_batches
from .packing import END_ID, RANKS, token_ids

LENGTH = 2048
#: Sequences of a shard; with the stride this bounds a file (8 MB), which its reader holds whole.
SHARD = 2_048
#: Sequences that are compressed as one block of the scratch table, and the zstd level of blocks and shuffled records.
BLOCK, LEVEL = 256, 3
#: Writing takes turns of slot ranges, so that only one turn's shuffled records are on disk at a time.
TURNS = 4
KEY, ROUNDS = 20_240_817, 4
BASE_ROWS = 200_000


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """Round function: a 64-bit mix of the half and the round's key."""
    x = (x + np.uint64(key & (1 << 64) - 1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def permuted(seq: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A permutation of 0..n-1, chosen by ``key``.

    The balanced Feistel network permutes 0..4^b - 1, the smallest such domain that holds n values.
    A value that falls at or beyond n is put through again, walking its cycle, until it is below n;
    the domain is under 4 n, so the walk takes under four steps on average.
    """
    bits = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(bits)) - 1)
    out = seq.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> bits, x & mask
        for r in range(rounds):
            left, right = right, left ^ (_mixed(right, key * (2 * r + 1) + r) & mask)
        out[todo] = x = left << bits | right
        todo = todo[x >= np.uint64(n)]
    return out.astype(np.int64)


def sequences(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """part, k, n_ids, first_doc, first_at, ids: each input partition's documents, ids end to end, cut at ``length``.

    A row is a block of BLOCK sequences from number ``k`` of its partition on: arrays of their real lengths, first
    documents and places in them, and all their ids in one compressed piece. A document is its ids and END_ID (null and
    empty texts: END_ID alone); the last sequence of a partition is filled up with END_ID. Rows with a null doc_id
    are written like others, under a null first_doc; repeated rows are all written.
    """
    path = public_tokenizers.path(RANKS)
    small_batches(docs.sparkSession)
    names = ["part", "k", "n_ids", "first_doc", "first_at", "ids"]
    kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, size, press = TaskContext.get().partitionId(), 0, 0, zstandard.ZstdCompressor(level=LEVEL).compress
        held, heads = np.empty(BLOCK * length, "<u2"), []  # the block that fills up, and the (document, place) at which its sequences begin

        def block() -> pa.RecordBatch:
            full = -(-size // length)
            held[size : full * length] = END_ID
            n = [min(length, size - i * length) for i in range(full)]
            docs, at = map(list, zip(*heads))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((part, k, n, docs, at, press(held[: full * length].tobytes())), kinds)], names=names)

        for b in batches:
            for d, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids, used = token_ids(text.as_py(), path), 0
                while used < len(ids):
                    take = min(len(ids) - used, len(held) - size)
                    heads += [(d, used + i - size) for i in range(-(-size // length) * length, size + take, length)]
                    held[size : size + take] = ids[used : used + take]
                    size, used = size + take, used + take
                    if size == len(held):
                        yield block()
                        k, size, heads = k + BLOCK, 0, []
        if size:
            yield block()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "part int, k long, n_ids array<long>, first_doc array<long>, first_at array<long>, ids binary")


def _raw_strings(values: list[bytes]) -> pa.Array:
    """A string column of unchecked bytes: Spark's text writer puts them out as they are."""
    a = pa.array(values, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(a), a.buffers())


def write_shards(docs: DataFrame, path: str, length: int = LENGTH, shard: int = SHARD, key: int = KEY) -> DataFrame:
    """Write all sequences in training order under ``path``; returns their directory: sequence_id, slot, shard, byte_offset, n_ids, first_doc, first_at.

    Shard s holds slots s * shard up to the next multiple, in order, one record a slot: ``length`` unsigned
    16-bit little-endian ids and a line feed. A record's place is its slot's remainder times the stride,
    so a reader resumes anywhere by a seek; the stride, not the line feed, parts the records. Shards are ranges of slots:
    each is a partition by its number, sorted and written by Spark's text writer as one file, ``part-<s>`` of its turn's
    folder ``turn=<t>``, and a turn is committed as a whole: the tasks of a lost executor write theirs again. An empty table writes no shard.
    """
    spark = docs.sparkSession
    rows = materialise(sequences(docs, length), "sequences", compression="none")
    counts = materialise(rows.groupBy("part").agg(F.sum(F.size("n_ids")).alias("c")), "part-counts")
    n = counts.agg(F.sum("c")).head()[0] or 0
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))  # a row an input partition
    placed = join_checked(rows, base, ["part"], "inner", BASE_ROWS).withColumn("seq", F.col("base") + F.col("k"))

    def slotted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("slot", pa.array(permuted(np.asarray(b.column("seq")), n, key)))

    def records(first: int, stop: int):
        def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            press, open_ = zstandard.ZstdCompressor(level=LEVEL).compress, zstandard.ZstdDecompressor().decompress
            for b in batches:
                for seq, c, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                    slot = permuted(np.arange(seq, seq + c), n, key)
                    mine = np.flatnonzero((slot >= first) & (slot < stop))
                    if len(mine):
                        raw = memoryview(open_(packed.as_buffer()))
                        out = [press(raw[i * 2 * length : (i + 1) * 2 * length]) for i in mine.tolist()]  # the shuffle moves compressed records
                        yield pa.RecordBatch.from_arrays([pa.array(slot[mine]), pa.array(out, pa.binary())], names=["slot", "packed"])

        return body

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        for b in batches:
            yield pa.RecordBatch.from_arrays([_raw_strings([open_(x.as_buffer()) for x in b.column(0)])], names=["value"])

    shards = -(-n // shard)
    per_turn = max(1, -(-shards // TURNS))
    ids = placed.select("seq", F.size("n_ids").alias("c"), "ids")
    with released_shuffles(spark):
        for t in range(-(-shards // per_turn)):
            first = t * per_turn
            here = min(per_turn, shards - first)
            texts = ids.mapInArrow(records(first * shard, (first + here) * shard), "slot long, packed binary")
            texts = texts.repartitionById(here, (F.floor(F.col("slot") / shard) - first).cast("int")).sortWithinPartitions("slot")
            texts.select("packed").mapInArrow(expand, "value string").write.options(compression="none", lineSep="\n").text(f"{path}/turn={first}")
    each = F.posexplode(F.arrays_zip("n_ids", "first_doc", "first_at")).alias("i", "x")
    listed = placed.select("seq", each).select((F.col("seq") + F.col("i")).alias("seq"), "x.n_ids", "x.first_doc", "x.first_at")
    listed = listed.mapInArrow(slotted, "seq long, n_ids long, first_doc long, first_at long, slot long")
    return listed.select(
        F.col("seq").alias("sequence_id"), "slot", F.floor(F.col("slot") / shard).cast("int").alias("shard"), ((F.col("slot") % shard) * (2 * length + 1)).alias("byte_offset"), "n_ids", "first_doc", "first_at"
    )


def read_shards(spark: SparkSession, path: str, length: int = LENGTH, shard: int = SHARD, first_slot: int = 0) -> DataFrame:
    """slot, ids (packed) from ``first_slot`` on: earlier shards are pruned by their path, earlier records of its shard skipped by the stride.

    Shards that were written by another ``length`` or ``shard`` must be read by the same.
    """
    stride = 2 * length + 1
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary, turn int").load(path)
    s = F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("int") + F.col("turn")
    files = files.select(s.alias("shard"), "content").filter(F.col("shard") >= first_slot // shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, content in zip(b.column(0).to_pylist(), b.column(1)):
                raw = content.as_buffer()
                count = len(raw) // stride
                for k in range(max(0, first_slot - s * shard), count, BLOCK):
                    stop = min(count, k + BLOCK)
                    ids = [raw.slice(i * stride, stride - 1).to_pybytes() for i in range(k, stop)]
                    yield pa.RecordBatch.from_arrays([pa.array(range(s * shard + k, s * shard + stop), pa.int64()), pa.array(ids, pa.binary())], names=["slot", "ids"])

    return files.mapInArrow(run, "slot long, ids binary")


def op10_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory of the shards written for all documents, with the digest of each record as read back from its file."""
    path = scratch(spark, "shards")
    listed = write_shards(documents(spark, sf_dir), path)
    if not listed.head(1):
        return listed.withColumn("ids_crc32", F.lit(None).cast("long"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([crc32(x.as_buffer()) for x in b.column(1)], pa.int64())], names=["slot", "ids_crc32"])

    return listed.join(read_shards(spark, path).mapInArrow(digests, "slot long, ids_crc32 long"), "slot", "left").select(*listed.columns, "ids_crc32")
