"""Mixture-controlled packing: deficit round-robin over source queues, a window a round, without a shuffle of tokens."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import documents, join_checked, materialise, small_batches
from .bpe import load_ranks, merge

#: The vocabulary of byte_bpe_50k.json as ranks: the same ids, several times faster (tests compare both).
RANKS = "byte_bpe_50k.tiktoken"
# Fixed value: the added token of byte_bpe_50k.json, which the library finds in a text under default settings.
ADDED = {"<|endoftext|>": 50256}
_ADDED = re.compile("(" + "|".join(map(re.escape, ADDED)) + ")")
#: White space in a row beyond which ids come from the merge queue of ``bpe`` instead of the library.
BLANK_RUN = 50_000
_BLANK_RUN = re.compile(rf"\s{{{BLANK_RUN}}}")
END_ID = 1
LENGTH = 2048
#: Tokens of a packet, the unit that a queue sends; sequences of a mixing window.
PACKET, WINDOW = 2048, 64
#: The most sources that all have their own queues, and beyond them the largest that do and the queues of the rest.
QUEUES = 1024
OWN, TAIL = 512, 512
#: Exponent of the registered query: a source's target is its tokens to this power, so small sources weigh more while they last.
POWER = 0.7
BASE_ROWS = 200_000


@cache
def tokenizer(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED)


def _merged(text: str, path: str) -> list[int]:
    return [i for piece in regex.findall(public_tokenizers.PATTERN, text) for i in merge(piece.encode(), load_ranks(path))]


def token_ids(text: str | None, path: str) -> np.ndarray:
    """Ids of a whole text (null: empty), the added token's name in it being that token, then END_ID; unsigned 16-bit."""
    text = text or ""
    if len(text) < BLANK_RUN or not _BLANK_RUN.search(text):
        ids = tokenizer(path).encode_to_numpy(text, allowed_special="all")
    else:  # the library's regex gives up on such a run
        ids = [i for k, part in enumerate(_ADDED.split(text)) for i in ([ADDED[part]] if k % 2 else _merged(part, path))]
    out = np.empty(len(ids) + 1, "<u2")
    out[:-1], out[-1] = ids, END_ID
    return out


def tokenised(docs: DataFrame, queue_of: F.Column | None = None) -> DataFrame:
    """part, doc_id, queue, at, n, ids: every document's ids with its place in its queue within its input partition.

    Written once, compressed, to the shared folder. ``part`` numbers the input partitions; queues run
    through the partitions in that order, and through a partition in row order.
    """
    path = public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), {}
        for b in batches:
            ids = [token_ids(t.as_py(), path) for t in b.column(1)]
            queues, at = b.column(2).to_pylist(), []
            for q, x in zip(queues, ids):
                at.append(held.get(q, 0))
                held[q] = at[-1] + len(x)
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(ids), pa.int32()), b.column(0), b.column(2), pa.array(at, pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())], names=["part", "doc_id", "queue", "at", "n", "ids"])

    queue = F.coalesce(F.col("source").cast("string"), F.lit("")) if queue_of is None else queue_of
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), queue.alias("queue"))
    small_batches(docs.sparkSession)
    return materialise(rows.mapInArrow(run, "part int, doc_id long, queue string, at long, n long, ids binary"), "tokens", compression="zstd")


class Mixture:
    """Deficit round-robin over queues of tokens, with every token's place on the line that the rounds make.

    A queue is a row of packets of PACKET tokens; its last one may be shorter. Each round is a window: it adds
    a quantum to every queue's credit, then the queues, in order, send all packets that their credit covers, and
    what is left, under a packet, is the deficit that the queue carries to the next window. Quanta follow ``targets``
    (without them the totals); a phase of such rounds ends when a queue of the targets runs out, and the
    others go on with shares in proportion. The last round of a phase settles what its queues still owe.

    Rounds never wait for each other: with t tokens of a queue in a phase of v rounds, the credit after round w is
    t * (w + 1) // v, so the packets sent by then are known, and any task places any token of any partition.
    """

    def __init__(self, totals: list[int], targets: list[float] | None = None, window: int = WINDOW * LENGTH, packet: int = PACKET):
        self.packet = packet
        left, goal = list(totals), [float(x) for x in (targets or totals)]
        self.phases = []  # (tokens of each queue before, tokens taken of each, rounds, line position at the start)
        line = 0
        while any(left):
            positive = [k for k, n in enumerate(left) if n and goal[k] > 0]
            if targets is None or not positive:
                take = list(left)  # the rest, as it comes
            else:
                first = min(positive, key=lambda k: left[k] / goal[k])
                scale = left[first] / goal[first]
                take = [0] * len(left)
                for k in positive:
                    take[k] = min(left[k], int(goal[k] * scale + 0.5))
                take[first] = left[first]
            done = [n - m for n, m in zip(totals, left)]
            self.phases.append((done, take, max(1, round(sum(take) / window)), line))
            line += sum(take)
            left = [a - b for a, b in zip(left, take)]
        self.total = line
        self._held: dict[tuple[int, int], tuple[list[int], list[int]]] = {}

    def sent(self, take: int, rounds: int, w: int) -> int:
        """Tokens of a queue that a phase has sent before round ``w``."""
        return take if w >= rounds else take * w // rounds // self.packet * self.packet

    def _round(self, phase: int, w: int) -> tuple[list[int], list[int]]:
        """For each queue the tokens sent before round ``w`` and the line position of the first that it sends in it."""
        found = self._held.get((phase, w))
        if found is None:
            if len(self._held) >= 64:
                self._held.clear()
            _, take, rounds, line = self.phases[phase]
            before = [self.sent(t, rounds, w) for t in take]
            at, position = line + sum(before), []
            for t, b in zip(take, before):
                position.append(at)
                at += self.sent(t, rounds, w + 1) - b
            self._held[phase, w] = found = (before, position)
        return found

    def places(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(start in the queue, length, position on the line) of the stretches of ``length`` tokens from ``start``."""
        stop = start + length
        for p, (done, take, rounds, _) in enumerate(self.phases):
            t, skip = take[queue], done[queue]
            a, b = max(start, skip) - skip, min(stop, skip + take[queue]) - skip
            while a < b:
                need = (a // self.packet + 1) * self.packet  # the credit that covers the packet of token a
                w = min(rounds - 1, (need * rounds - 1) // t)  # the first round after which t (w + 1) // rounds >= need
                before, position = self._round(p, w)
                end = min(b, self.sent(t, rounds, w + 1))
                yield skip + a, end - a, position[queue] + a - before[queue]
                a = end


def queue_by_size(docs: DataFrame, source: F.Column, targets: dict[str, float]) -> F.Column:
    """Queues of very many sources: all of ``targets`` and the OWN largest by bytes of text have their own; the rest share TAIL queues by hash.

    A shared queue's name begins with a mark that no source with its own queue begins with.
    """
    sizes = docs.groupBy(source.alias("q")).agg(F.sum(F.octet_length(F.col("text").cast("string"))).alias("n"))
    own = {r["q"] for r in sizes.orderBy(F.desc_nulls_last("n"), "q").limit(OWN).collect()} | set(targets)
    mark = "#"
    while any(q.startswith(mark) for q in own):
        mark += "#"
    return F.when(source.isin(*own), source).otherwise(F.concat(F.lit(mark), F.pmod(F.xxhash64(source), F.lit(TAIL)).cast("string")))


def pack(docs: DataFrame, targets: dict[str, float] | None = None, length: int = LENGTH, window: int = WINDOW, power: float | None = None, packet: int = PACKET) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` ids; only the last sequence is not full.

    A row is a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and queue. The
    queue is the source (null: as empty); beyond QUEUES sources, see ``queue_by_size``.
    ``targets`` gives the wanted proportions by source, 0 where absent (such sources come last); ``power``
    instead gives each queue its tokens to that power. Without both, every window holds the sources' own proportions.
    Pieces are cut where packets, sequences and phases end, so a document has few, however rare its source.
    A null or empty text is one id. Rows with a null doc_id are packed like others, under a null doc_id; of
    rows that repeat a doc_id each is packed; order within a source is that of the input's partitions and rows.
    An empty table gives no piece. Other columns are ignored.
    """
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    few = docs.select(source.alias("q")).distinct().limit(QUEUES + 1).count() <= QUEUES
    tokens = tokenised(docs, None if few else queue_by_size(docs, source, targets or {}))
    sums = materialise(tokens.groupBy("queue", "part").agg(F.sum("n").alias("n")), "queue-sums")
    totals = sums.groupBy("queue").agg(F.sum("n").alias("n")).orderBy("queue").collect()  # at most QUEUES rows, or OWN + TAIL and the targets
    names = {r["queue"]: k for k, r in enumerate(totals)}
    goal = [r["n"] ** power for r in totals] if power is not None and not targets else [targets.get(q, 0.0) for q in names] if targets else None
    mix = docs.sparkSession.sparkContext.broadcast(Mixture([r["n"] for r in totals], goal, window * length, packet))  # a row of integers a phase, at most one phase a queue
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("queue", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = join_checked(tokens, base, ["queue", "part"], "left", BASE_ROWS).select("doc_id", "queue", (F.col("at") + F.col("base")).alias("at"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = mix.value.places
        for b in batches:
            out: list[tuple] = []
            for doc, q, at, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                ids = np.frombuffer(packed.as_buffer(), "<u2").astype("<u4")
                raw = memoryview(ids).cast("B")
                for begin, size, line in places(names[q], at, len(ids)):
                    first = begin - at
                    while size:
                        seq, off = divmod(line, length)
                        part = min(size, length - off)
                        out.append((doc, first, part, crc32(raw[4 * first : 4 * (first + part)]), len(ids), seq, off, q))
                        first, line, size = first + part, line + part, size - part
            cols = list(zip(*out)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.string())], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"])

    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue string")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of LENGTH ids; sources weigh by their tokens to the power POWER while they last."""
    return pack(documents(spark, sf_dir), power=POWER)
