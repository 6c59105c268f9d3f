"""Phrase collocations by dynamic itemset counting: cyclic scans of shards in which a longer phrase is counted once both its parts are frequent."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import documents, join_checked, materialise, released_shuffles, replaced, scratch, small_batches

#: Fixed values of the contract: least occurrences, longest phrase, share (in hundredths) of a phrase that a longer one must hold to replace it, phrases of a language.
LEAST, LONGEST, ABSORB, TOP = 10, 3, 50, 2000
#: Shards of a cycle; the scan stops after each to activate phrases.
SHARDS = 2
#: Frequent words and phrases whose hashes and steps go to the scanning tasks (nine bytes each); of more, Bloom filters go, with BITS bits and PROBES probes a phrase, of SLOTS bytes in all at most.
EXACT_ROWS, SLOTS, BITS, PROBES = 1 << 22, 1 << 26, 12, 4
#: Words that a task counts at once, and different words that it knows before it starts anew.
CHUNK_WORDS, KNOWN_WORDS = 3_000_000, 1_000_000
#: Bytes of a text that are split into words at once, and words from which on a row of numbered words is closed; one of more different words (a very long text) has wider numbers.
PART, ROW_WORDS, NARROW = 1 << 20, 1 << 17, 1 << 16
#: Bytes of text for which there is one more bucket of phrases, and of keys that are packed or sent at once.
BUCKET_BYTES, PACK_BYTES = 1 << 24, 1 << 25
#: Broadcast bound for tables of phrases.
PHRASE_ROWS = 500_000
#: No step.
NEVER = 255
#: Kinds of rows that a step leaves: packed phrases that are still counted, complete ones, hashes of those that became frequent.
ACTIVE, DONE, FREQUENT = 0, 1, 2

#: A-Z to a-z, tab to space, and everything that ends a piece to a full stop, which no word can hold.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 46 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in order; between two pieces stands a full stop."""
    return text.translate(_BYTES).replace(b".", b" . ").split(b" ")


class Words(dict):
    """Number of each word in order of first sight; the empty word and the full stop are no words and have -1."""

    def __init__(self, lang: str):
        self.lang = lang
        super().__init__({b"": -1, b".": -2})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 2
        return n

    def hashes(self) -> np.ndarray:
        """A hash of (language, word) for each number, as ``xxhash64(lang, word)`` gives it in Spark; phrases combine them, so that every task gives a phrase the same."""
        seed = xxhash.xxh64_intdigest(self.lang.encode(), 42)
        return np.array([xxhash.xxh64_intdigest(w, seed) for w in list(self)[2:]], np.uint64)


#: The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _hash_long(x: np.ndarray, seed) -> np.ndarray:
    """XXH64 of eight bytes."""
    turn = lambda v, k: (v << np.uint64(k)) | (v >> np.uint64(64 - k))
    h = turn((seed + _P5 + np.uint64(8)) ^ (turn(x * _P2, 31) * _P1), 27) * _P1 + _P4
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def joined(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its two parts, as ``xxhash64(head, tail)`` gives it in Spark."""
    with np.errstate(over="ignore"):
        return _hash_long(tail, _hash_long(head, np.uint64(42)))


def hash_words(row: list[np.ndarray]) -> np.ndarray:
    """Hash of the phrases whose words have the hashes ``row``, as ``hash_of`` gives it in Spark."""
    while len(row) > 1:
        row = [joined(a, b) for a, b in zip(row, row[1:])]
    return row[0]


class Steps:
    """For frequent phrases of one length, by their hashes: the step at which each became frequent; of two with one hash the first."""

    def __init__(self, hashes: np.ndarray, reach: np.ndarray):
        order = np.lexsort((reach, hashes))
        self.hashes, self.reach = hashes[order], reach[order].astype(np.uint8)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.reach[at], NEVER).astype(np.uint8)


def probes(hashes: np.ndarray, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    """Places of each hash in a filter of ``bits`` bits."""
    high, bits = hashes >> np.uint64(32), np.asarray(bits, np.uint64)
    with np.errstate(over="ignore"):
        by = ((hashes * _P1) >> np.uint64(32)) | np.uint64(1)
    return ((high + np.uint64(k) * by) % bits for k in range(PROBES))


def bloom(hashes: np.ndarray, bits: int) -> bytes:
    held = np.zeros(bits, np.uint8)
    for at in probes(hashes, bits):
        held[at] = 1
    return np.packbits(held, bitorder="little").tobytes()


class FilteredSteps:
    """``Steps`` by Bloom filters: one a step, in parts by the bucket of the hash.

    The first filter that holds a hash gives its step. A phrase that is not frequent may be found too, and one that is may be found for an earlier step
    than its own; what is found once stays, as long as the filters of past steps do not change.
    """

    def __init__(self, buckets: int, rows: list[tuple[int, int, bytes]]):
        """rows: step, bucket and filter."""
        self.buckets, self.filters = np.uint64(buckets), []
        for reach in sorted({r for r, _, _ in rows}):
            offset, bits, own, end = np.zeros(buckets, np.uint64), np.zeros(buckets, np.uint64), [], 0
            for _, bucket, data in (x for x in rows if x[0] == reach):
                offset[bucket], bits[bucket] = end, 8 * len(data)
                own.append(data)
                end += 8 * len(data)
            self.filters.append((reach, offset, bits, np.frombuffer(b"".join(own), np.uint8)))

    def of(self, hashes: np.ndarray) -> np.ndarray:
        found, open_, bucket = np.full(len(hashes), NEVER, np.uint8), np.arange(len(hashes)), (hashes % self.buckets).astype(np.int64)
        for reach, offset, bits, held in self.filters:
            at = open_[bits[bucket[open_]] > 0]
            h, b = hashes[at], bucket[at]
            hit = np.arange(len(at))
            places = probes(h, bits[b])
            for place in places:
                place = (place + offset[b])[hit]
                hit = hit[(held[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0]
            found[at[hit]] = reach
            open_ = open_[found[open_] == NEVER]
        return found


class Known:
    """What scanning tasks know of frequent phrases, by length: exact steps of those of some steps, filters of the others'.

    It only grows, by what became frequent at the last step: a hash that was found keeps its step ever after, whether the find was true or not. So a
    phrase of two parts that were found has one first step in all tasks of all scans.
    """

    def __init__(self, exact: dict[int, list[tuple[int, np.ndarray]]], filters: dict[int, list[tuple[int, int, bytes]]], buckets: int):
        """exact: by length, steps and hashes; filters: by length, rows of ``FilteredSteps``."""
        self.exact = {k: Steps(np.concatenate([h for _, h in own]), np.concatenate([np.full(len(h), step, np.uint8) for step, h in own])) for k, own in exact.items()}
        self.filters = {k: FilteredSteps(buckets, own) for k, own in filters.items()}

    def __contains__(self, length: int) -> bool:
        return length in self.exact or length in self.filters

    def of(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """The step of each hash, or NEVER."""
        found = [table[length].of(hashes) for table in (self.exact, self.filters) if length in table]
        return found[0] if len(found) < 2 else np.minimum(*found)


def packed(keys: pa.Array, f: np.ndarray, mark: np.ndarray) -> bytes:
    """Rows of phrases in few bytes: by columns, by zstd. Sorted keys take least."""
    raw = keys.buffers()
    offsets = np.frombuffer(raw[1], np.int32)[keys.offset : keys.offset + len(keys) + 1]
    parts = [f.astype("<i8").tobytes(), mark.astype("<i4").tobytes(), np.diff(offsets).astype("<i4").tobytes(), memoryview(raw[2])[offsets[0] : offsets[-1]] if raw[2] is not None else b""]
    head = np.array([len(keys), sum(map(len, parts))], "<i8").tobytes()
    return head + pa.Codec("zstd", 3).compress(b"".join(parts), asbytes=True)


def unpacked(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    n, size = np.frombuffer(data, "<i8", 2).tolist()
    raw = pa.Codec("zstd").decompress(memoryview(data)[16:], size)
    f, mark, lengths = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<i4", n, 8 * n), np.frombuffer(raw, "<i4", n, 12 * n)
    offsets = np.zeros(n + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), raw.slice(16 * n)]), f, mark


def mark_of(length: int, start: np.ndarray, reach: int = NEVER) -> np.ndarray:
    """Length, first step and the step at which a phrase became frequent (or NEVER) in one number; the least of a phrase's marks is its mark."""
    return (length << 16) + (start.astype(np.int64) << 8) + reach


def distinct(key: np.ndarray, numbered: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """A place of each different key, the number of every place's key among them (if asked), and how often each occurs; a plain sort, since any place will do."""
    order = np.argsort(key)
    held = key[order]
    new = np.r_[True, held[1:] != held[:-1]]
    first, number = np.flatnonzero(new), None
    if numbered:
        number = np.empty(len(key), np.int64)
        number[order] = np.cumsum(new) - 1
    return order[first], number, np.diff(np.r_[first, len(key)])


Counted = tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]


def count_chunk(ids: np.ndarray, h: np.ndarray, step: int, steps: Known, shards: int, longest: int) -> Iterator[Counted]:
    """(numbers of the first, second, ... words of phrases, their occurrences, first steps, hashes) of all phrases in ``ids`` that are active at ``step``, in the order of their words' numbers; the empty phrase stands for all words.

    h holds the hashes of the words by number.
    """
    size = len(h)
    live = np.flatnonzero(ids >= 0)
    if step < shards:
        n = np.bincount(ids[live], minlength=size)
        at = np.flatnonzero(n)
        zero = np.zeros(len(at) + 1, np.uint8)
        yield [], np.array([len(live)]), zero[:1], np.zeros(1, np.uint64)
        yield [at], n[at], zero[1:], h[at]
    if 1 not in steps or not len(live):
        return
    # of the phrase of the length before that begins at each place: its hash, a number, and the step at which it became frequent
    first, hashes, code = np.full(len(ids), NEVER, np.uint8), np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.int64)
    first[live], hashes[live], code[live] = steps.of(1, h)[ids[live]], h[ids[live]], ids[live]
    for length in range(2, longest + 1):
        begin = np.flatnonzero((first[:-1] != NEVER) & (first[1:] != NEVER))
        if not len(begin):
            return
        key = code[begin] * size + ids[begin + length - 1]
        onward = length in steps and length < longest
        start = np.maximum(first[begin], first[begin + 1]).astype(np.int64) + 1
        if not onward:  # what is not counted now leads no further
            due = np.flatnonzero((start <= step) & (start > step - shards))
            begin, key, start = begin[due], key[due], start[due]
            if not len(begin):
                return
        at, number, n = distinct(key, onward)
        place, start = begin[at], start[at]  # from here on a row a phrase, not a place
        whole = joined(hashes[place], hashes[place + 1])
        due = np.flatnonzero((start <= step) & (start > step - shards))
        if len(due):
            here = place[due]
            yield [ids[here + k] for k in range(length)], n[due], start[due].astype(np.uint8), whole[due]
        if not onward:
            return
        found = steps.of(length, whole)
        on = np.flatnonzero(found[number] != NEVER)
        number, place = number[on], begin[on]
        first[:] = NEVER
        first[place], hashes[place], code[place] = found[number], whole[number], number


def numbered(docs: DataFrame) -> DataFrame:
    """shard, lang, size, words, ids: the words of all texts of ``docs`` (lang, text as bytes, shard), so that texts are split once and not in every scan.

    A row holds whole texts of one language and shard: its different words, joined by a space, and as unsigned numbers of two bytes (four, if it has
    NARROW words) the place of each word among them from 1; 0 is a full stop. size is the bytes of its texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], tuple[Words, list[np.ndarray]]] = {}
        sizes: dict[tuple[int, str], int] = {}
        octets: dict[tuple[int, str], int] = {}

        def row(key: tuple[int, str]) -> pa.RecordBatch:
            (words, parts), (shard, lang) = held.pop(key), key
            sizes.pop(key, None)
            names = list(words)[2:]
            ids = np.maximum(np.concatenate(parts) + 1, 0).astype("<u2" if len(names) < NARROW else "<u4")
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([lang]), pa.array([octets.pop(key)], pa.int64()), pa.array([b" ".join(names)], pa.binary()), pa.array([ids.tobytes()], pa.binary())], names=["shard", "lang", "size", "words", "ids"])

        for b in batches:
            for lang, text, shard in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                key, raw, start = (shard, lang), text.as_py(), 0
                known, parts = held.setdefault(key, (Words(lang), []))
                octets[key] = octets.get(key, 0) + len(raw)
                for end in range(PART, len(raw) + PART, PART):  # a very long text goes in parts, cut before a space
                    cut = len(raw) if end >= len(raw) else max(raw.rfind(b" ", start, end), start)
                    tokens = words_of(raw[start:cut])
                    ids = np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens))
                    parts.append(ids[ids != -1])
                    sizes[key], start = sizes.get(key, 0) + len(ids), cut
                parts.append(np.array([-2], np.int32))
                if sizes.get(key, 0) >= ROW_WORDS:
                    yield row(key)
            if sum(sizes.values()) > CHUNK_WORDS or sum(len(known) for known, _ in held.values()) > KNOWN_WORDS:  # of very many languages
                for key in list(held):
                    yield row(key)
        for key in list(held):
            yield row(key)

    return docs.select("lang", "text", "shard").mapInArrow(run, "shard int, lang string, size long, words binary, ids binary")


def scan(shard: DataFrame, step: int, steps, shards: int, longest: int, buckets: int) -> DataFrame:
    """bucket, data: phrases by a bucket of their hash, ``packed``: occurrences in one shard of ``numbered``, summed by chunks of a task.

    The key is the phrase, a full stop (which no phrase holds) and the language. Keys are in order, so that they take few bytes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Words] = {}
        held: dict[str, list[np.ndarray]] = {}
        size, different, table = 0, 0, steps.value

        def keyed() -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
            for lang, parts in held.items():
                names, after = pa.array(list(words[lang])[2:], pa.binary()), pa.scalar(b"." + lang.encode(), pa.binary())
                order = pc.array_sort_indices(names).to_numpy()
                rank = np.empty(len(order) + 2, np.int32)
                rank[order], rank[-2:] = np.arange(len(order)), (-2, -1)
                names, octets = names.take(pa.array(order)), pc.binary_length(names).to_numpy()[order].astype(np.int64) + 1
                final = pc.binary_join_element_wise(names, after, b"")
                for places, n, start, hashes in count_chunk(rank[np.concatenate(parts)], words[lang].hashes()[order], step, table, shards, longest):
                    ends = np.cumsum(sum((octets[x] for x in places), np.full(len(n), len(lang.encode()), np.int64)))
                    cuts = [0, *(np.flatnonzero(np.diff(ends // PACK_BYTES)) + 1).tolist(), len(n)]
                    for i, j in zip(cuts, cuts[1:]):
                        here = [pa.array(x[i:j]) for x in places]
                        texts = [names.take(x) for x in here[:-1]] + [final.take(x) for x in here[-1:]]
                        phrases = pc.binary_join_element_wise(*texts, b" ") if texts else pa.array([after.as_py()], pa.binary())
                        yield phrases, n[i:j].astype(np.int64), mark_of(len(texts), start[i:j]), (hashes[i:j] % np.uint64(buckets)).astype(np.int32)

        def sent(rows: list) -> Iterator[pa.RecordBatch]:
            keys, f, mark, bucket = pa.concat_arrays([x[0] for x in rows]), *(np.concatenate([x[k] for x in rows]) for k in (1, 2, 3))
            rows.clear()
            order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
            keys, f, mark, bucket = keys.take(pa.array(order)), f[order], mark[order], bucket[order]
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            yield from in_rows(["bucket", "data"], ((int(bucket[i]), packed(keys[i:j], f[i:j], mark[i:j])) for i, j in zip(cuts, cuts[1:])))

        def counted() -> Iterator[pa.RecordBatch]:
            ready, octets = [], 0
            for row in keyed():
                if len(row[0]):
                    ready.append(row)
                    octets += row[0].nbytes
                if octets > 2 * PACK_BYTES:
                    yield from sent(ready)
                    ready, octets = [], 0
            if ready:
                yield from sent(ready)

        for b in batches:
            for lang, own, ids in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                known = words.setdefault(lang, Words(lang))
                own, before = own.as_py().split(b" ") if len(own.as_buffer()) else [], len(known)
                place = np.array([-2, *map(known.__getitem__, own)], np.int32)
                ids = place[np.frombuffer(ids.as_buffer(), "<u2" if len(own) < NARROW else "<u4")]
                held.setdefault(lang, []).append(ids)
                size, different = size + len(ids), different + len(known) - before
                if size > CHUNK_WORDS or different > KNOWN_WORDS:
                    yield from counted()
                    words, held, size, different = {}, {}, 0, 0
        yield from counted()

    return shard.select("lang", "words", "ids").mapInArrow(run, "bucket int, data binary")


def in_rows(names: list[str], rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of rows (numbers, and last bytes), closed from a quarter of PACK_BYTES on."""
    held, octets = [], 0
    kinds = [pa.int32()] * (len(names) - 1) + [pa.binary()]
    batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
    for row in rows:
        held.append(row)
        octets += len(row[-1])
        if octets > PACK_BYTES // 4:
            yield batch()
            held, octets = [], 0
    if held:
        yield batch()


def merged(rows: DataFrame, step: int, least: int, longest: int, shards: int) -> DataFrame:
    """What a step leaves of the ``packed`` phrases of ``rows`` (bucket, data), the rows of a bucket in one partition: kind, bucket, length, f, key, data.

    ACTIVE: the phrases that are counted on, packed. DONE: a row a complete phrase (key, length, f) that has ``least``, and all words (length 0).
    FREQUENT: for each length under ``longest`` the hashes of the phrases that reached ``least`` at this step (data) and how many (f).
    """
    names = ["kind", "bucket", "length", "f", "key", "data"]

    def rows_of(kind: int, bucket: int, length, f, key, data) -> pa.RecordBatch:
        n = len(f)
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        columns = ([kind] * n, [bucket] * n, length, f, [None] * n if key is None else key, [None] * n if data is None else data)
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def hashes(keys: pa.Array, length: int) -> np.ndarray:
        by: dict[bytes, tuple[Words, list[int]]] = {}
        for key in keys.to_pylist():
            phrase, _, lang = key.partition(b".")
            if lang not in by:
                by[lang] = Words(lang.decode()), []
            known, ids = by[lang]
            ids += map(known.__getitem__, phrase.split(b" "))
        return np.sort(np.concatenate([hash_words(list(known.hashes()[np.array(ids).reshape(-1, length).T])) for known, ids in by.values()]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for bucket, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(bucket, []).append(data)
        for bucket in list(held):
            parts = [unpacked(data) for data in held.pop(bucket)]
            table = pa.table({"key": pa.chunked_array([x[0] for x in parts]), "f": np.concatenate([x[1] for x in parts]), "mark": np.concatenate([x[2] for x in parts])})
            parts = None
            table = table.group_by("key", use_threads=False).aggregate([("f", "sum"), ("mark", "min")])
            keys, f, mark = table.column("key").combine_chunks(), table.column("f_sum").to_numpy(), table.column("mark_min").to_numpy().astype(np.int64)
            keys = keys if isinstance(keys, pa.Array) else pa.concat_arrays(keys.chunks)
            length, start, reach = mark >> 16, (mark >> 8) & 255, mark & 255
            new = (reach == NEVER) & (f >= least)
            for size in range(1, longest):
                at = np.flatnonzero(new & (length == size))
                if len(at):
                    yield rows_of(FREQUENT, bucket, [size], [len(at)], None, [hashes(keys.take(pa.array(at)), size).tobytes()])
            mark = np.where(new, mark - NEVER + step, mark)
            complete = start <= step + 1 - shards
            at = np.flatnonzero(complete & ((reach != NEVER) | new | (length == 0)))
            for k in range(0, len(at), 50_000):
                here = at[k : k + 50_000]
                yield rows_of(DONE, bucket, length[here].astype(np.int32), f[here], keys.take(pa.array(here)), None)
            at = np.flatnonzero(~complete)
            if len(at):
                yield rows_of(ACTIVE, bucket, [0], [len(at)], None, [packed(keys.take(pa.array(at)), f[at], mark[at])])

    return rows.mapInArrow(run, "kind int, bucket int, length int, f long, key binary, data binary")


def spelled(key: str = "key") -> tuple[Column, Column]:
    """The phrase and the language of a key of ``scan``, by bytes."""
    phrase = F.substring_index(F.col(key).cast("string"), ".", 1)
    return phrase, F.substring(F.col(key), F.octet_length(phrase) + 2, F.octet_length(key)).cast("string")


def hash_of(longest: int) -> Column:
    """The hash that scans give the phrase (lang, phrase, length) of up to ``longest`` words."""
    words = F.split("phrase", " ", -1)
    row = [F.xxhash64("lang", F.get(words, F.lit(i))) for i in range(longest)]
    found = F.lit(None).cast("long")
    for length in range(1, longest + 1):
        found = F.when(F.col("length") == length, row[0]).otherwise(found)
        row = [F.xxhash64(a, b) for a, b in zip(row, row[1:])]
    return found


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """(lang, length, phrase, f): the exact occurrences of every word and phrase of up to ``longest`` words that has ``least``; and (lang, n), all words.

    Documents are dealt into ``shards``, which are scanned in turn, step 0, 1, 2 and so on, around and around. Words are counted from step 0
    on. A phrase is active from the step after the one at which the later of its parts (without the last, without the first word) reached ``least``, and
    is counted for one full cycle, so over every shard once; with fewer than ``least`` it is then forgotten. Scans end when nothing is active: after
    three cycles at the latest for three words. Scanning tasks know the hashes and steps of up to EXACT_ROWS frequent phrases, and so what is
    active. Of what became frequent at a step that no longer fits they have Bloom filters, ``slots`` bytes at most, which may find a phrase for frequent that is not, or find it for a step too early.
    A table or filter of a step is made once and never changes, so all tasks of all later scans find the same, and what contains such a phrase still is counted over one full cycle; without
    ``least`` it is forgotten. That costs rows, never counts.

    All is summed in a chunk of the task before the one shuffle of a step, in which phrases go packed by buckets of their hashes, and meet the active ones; complete ones are set aside.
    """
    spark = docs.sparkSession
    small_batches(spark)
    lang, text = F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(lang.alias("lang"), text.cast("binary").alias("text"), F.pmod(F.xxhash64(F.col("doc_id").cast("string"), text), F.lit(shards)).cast("int").alias("shard"))
    rows = materialise(numbered(rows), "phrase-shards", compression="zstd", partitionBy="shard")
    buckets = 1 + (rows.agg(F.sum("size")).first()[0] or 0) // BUCKET_BYTES
    here = scratch(spark, "phrases")  # two tables of states take turns, so that the disk holds no more
    active = spark.createDataFrame([], "bucket int, data binary")
    done = spark.createDataFrame([], "key binary, length int, f long")
    exact, filters = defaultdict(list), defaultdict(list)  # of ``Known``
    step, last, rows_left, bytes_left = 0, -1, EXACT_ROWS, slots  # last: the last step at which a phrase of under ``longest`` words became frequent
    with released_shuffles(spark):
        while step < shards or step <= last + shards:
            found = scan(rows.filter(F.col("shard") == step % shards), step, spark.sparkContext.broadcast(Known(exact, filters, buckets)), shards, longest, buckets)
            now = merged(active.union(found).repartitionById(buckets, F.col("bucket")), step, least, longest, shards)
            state = replaced(now, f"{here}/state-{step % 2}", compression="zstd")
            active = state.filter(F.col("kind") == ACTIVE).select("bucket", "data")
            kept = materialise(state.filter(F.col("kind") != ACTIVE), "phrases-done", compression="zstd")
            done = done.union(kept.filter(F.col("kind") == DONE).select("key", "length", "f"))
            new = kept.filter(F.col("kind") == FREQUENT)
            if n := new.agg(F.sum("f")).first()[0]:
                last, fits = step, n <= rows_left
                # a step that does not fit has half of the bytes that are left at most, so that later ones have some
                for r in (new.select("bucket", "length", "data") if fits else _filters(new, min(BITS, 4 * bytes_left / n))).toArrow().to_pylist():
                    if fits:
                        exact[r["length"]].append((step, np.frombuffer(r["data"], np.uint64)))
                    else:
                        filters[r["length"]].append((step, r["bucket"], r["data"]))
                        bytes_left = max(0, bytes_left - len(r["data"]))
                rows_left -= n if fits else 0
            step += 1
    phrase, lang = spelled()
    return done.filter(F.col("length") > 0).select(lang.alias("lang"), "length", phrase.alias("phrase"), "f"), done.filter("length = 0").select(lang.alias("lang"), F.col("f").alias("n"))


def _filters(new: DataFrame, bits: float) -> DataFrame:
    """bucket, length, data: a filter of about ``bits`` bits a phrase for each row of hashes of ``merged``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket, length, data = (c.to_pylist() for c in b.columns)
            own = (np.frombuffer(d, np.uint64) for d in data)
            yield from in_rows(["bucket", "length", "data"], ((i, k, bloom(h, max(64, int(len(h) * bits) // 8 * 8))) for i, k, h in zip(bucket, length, own)))

    return new.select("bucket", "length", "data").mapInArrow(run, "bucket int, length int, data binary")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of 2 to ``longest`` words of each language (null: ``und``).

    Texts (null: empty) are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and those at spaces and tabs into words; phrases
    do not leave a piece. a is the number of occurrences, overlaps included, at least ``least``; n all words of the language. A cut after k words has
    l and r, the occurrences of both sides, and floor(1000000 a a / (l r)); the least counts, ties to the smaller k. A phrase
    that lies in a longer candidate with ABSORB hundredths of its occurrences is left out. Order: score, a (both falling), phrase (bytes).
    All numbers are exact: products are decimals of 38 digits, enough for 10^15 occurrences. Repeated rows and rows with a null doc_id count
    like others, other columns are ignored, and an empty table gives no rows.
    """
    frequent, total = phrase_counts(docs, least, longest, shards, slots)
    found = frequent.filter("length > 1").withColumn("words", F.split("phrase", " ", -1))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
    side = lambda start, size: F.concat_ws(" ", F.slice("words", start, size))
    cuts = cuts.select("lang", "length", "phrase", F.col("f").alias("a"), "k", side(F.lit(1), F.col("k")).alias("left"), side(F.col("k") + 1, F.col("length") - F.col("k")).alias("right"))
    for name, at in (("l", "left"), ("r", "right")):
        cuts = join_checked(cuts, frequent.select("lang", F.col("phrase").alias(at), F.col("f").alias(name)), ["lang", at], "inner", PHRASE_ROWS)
    whole = [F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")]
    score = F.call_function("div", (whole[0] * whole[0]).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)"), (whole[1] * whole[2]).cast("decimal(38,0)"))
    scored = cuts.withColumn("score", score).groupBy("lang", "length", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("length") - 1), lambda size: F.transform(F.sequence(F.lit(1), F.col("length") - size + 1), lambda i: F.concat_ws(" ", F.slice("words", i, size)))))
    longer = found.filter("length > 2").select("lang", F.explode(inner).alias("phrase"), F.col("f").alias("within"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("within").alias("within"))
    left = scored.join(longer, ["lang", "phrase"], "left").filter("within is null or 100 * within < {} * a".format(ABSORB))
    order = Window.partitionBy("lang").orderBy(F.desc("m.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(F.broadcast(total) if total.limit(10_001).count() <= 10_000 else total, "lang").select("lang", "rank", "phrase", "a", "m.l", "m.r", "n", "m.score")


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``collocations`` of all documents."""
    return collocations(documents(spark, sf_dir))


ORACLE = {
    "op13_phrase_mining": rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (SELECT lang, k, unnest([array_to_string(ws[i:i + k - 1], ' ') for i in range(1, len(ws) - k + 2)]) AS phrase FROM w, (SELECT unnest([1, 2, 3]) AS k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= {LEAST}),
cuts AS (SELECT lang, k, phrase, a, cut, array_to_string(ws[:cut], ' ') AS lp, array_to_string(ws[cut + 1:], ' ') AS rp FROM c, (SELECT unnest([1, 2]) AS cut) WHERE cut < k),
scores AS (
  SELECT cuts.lang, cuts.k, cuts.phrase, a, cut, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp AND x.k = cut JOIN f y ON y.lang = cuts.lang AND y.phrase = rp AND y.k = cuts.k - cut
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, array_to_string(ws[i:i + 1], ' ') AS phrase, max(a) AS within FROM c, (SELECT unnest([1, 2]) AS i) WHERE k = 3 GROUP BY ALL),
kept AS (SELECT scores.* FROM scores LEFT JOIN longer ON longer.lang = scores.lang AND longer.phrase = scores.phrase AND scores.k = 2 WHERE within IS NULL OR 100 * within < {ABSORB} * a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n ON n.lang = kept.lang QUALIFY rank <= {TOP}"""
}
