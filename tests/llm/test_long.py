"""Texts of a megabyte, and the registered queries end to end against plain computations."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import public_tokenizers
from test_small import BLANK, brute_fp, brute_spans, split
from tidemill.llm import binout, bpe, exact, packing, quality, queries, secrets, sharding, simhash, substring

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def long_texts():
    rng = random.Random(21)
    prose = " ".join(f"w{rng.randrange(20000)}" for _ in range(160_000))
    return {
        0: prose, 1: "x " * 500_000, 2: prose[400_000:], 3: " " * 1_000_000, 4: "".join(rng.choice("abcdefgh ijk") for _ in range(1_000_000)),
        5: " ".join(f"token={rng.getrandbits(64):016x}{rng.getrandbits(64):016x}" for _ in range(5_000)) + " é " + "f0" * 20_000, 6: "tail",
    }


@pytest.fixture(scope="module")
def long_docs(spark, long_texts):
    return spark.createDataFrame([(d, t, "en", f"s{d % 2}", len(t)) for d, t in long_texts.items()], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_long_exact_and_near(long_docs, long_texts):
    assert {r.doc_id: r.text_sha256 for r in exact.exact_groups(long_docs).collect()} == {d: hashlib.sha256(BLANK.sub(" ", t).encode()).hexdigest() for d, t in long_texts.items()}
    got = {r.doc_id: r.fingerprint for r in simhash.near_groups(long_docs).collect()}
    assert got == {d: f"{brute_fp(t):016x}" for d, t in long_texts.items()}


def test_long_substring(long_docs, long_texts):
    first = {}
    words = {d: split(t) for d, t in long_texts.items()}
    for d, w in words.items():
        for i in range(len(w) - 49):
            first.setdefault(hash(tuple(w[i : i + 50])), d)
    for r in substring.dedup_substrings(long_docs).collect():
        w = words[r.doc_id]
        gone = {p for i in range(len(w) - 49) if first[hash(tuple(w[i : i + 50]))] < r.doc_id for p in range(i, i + 50)}
        assert (r.n_words, r.n_removed) == (len(w), len(gone))
        assert r.kept_sha256 == hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()


def test_long_secrets(long_docs, long_texts):
    for r in secrets.report(long_docs).collect():
        want = brute_spans(long_texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in want) for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(",".join(s for _, _, s in want).encode()).hexdigest()
    red = {r.doc_id: r.text for r in secrets.redact(long_docs).collect()}
    assert red[0] == long_texts[0] and red[5].count("[SECRET]") == 5_001 and "token=" not in red[5]


def test_long_tokens(long_docs, long_texts):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path(bpe.RANKS)), special_tokens={})
    for r in bpe.encode_documents(long_docs).collect():
        if r.doc_id != 3:  # the library's regex gives up on a million blanks
            assert np.frombuffer(bytes(r.ids), "<u4").tolist() == enc.encode_ordinary(long_texts[r.doc_id])
        assert r.n_tokens == len(r.ids) // 4 and bytes(r.decoded) == long_texts[r.doc_id].encode()
    n = defaultdict(int)
    for r in packing.pack(long_docs).collect():
        n[r.doc_id] += r.length
    path = public_tokenizers.path(packing.RANKS)
    assert n == {d: len(packing.token_ids(t, path)) for d, t in long_texts.items()}


def test_long_scores_and_shards(long_docs, spark):
    model = quality.train(spark.createDataFrame([(i, f"a{i} b c", i % 2) for i in range(20)], "doc_id long, text string, quality int"))
    assert quality.score(long_docs, model).filter("score between 0 and 1").count() == 7
    assert sharding.shard_rows(long_docs, 2).agg(F.sum("size")).head()[0] == long_docs.agg(F.sum(F.octet_length("text") + 1)).head()[0]


@pytest.fixture(scope="module")
def table(spark):
    return {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def rows(spark, name):
    return queries.QUERIES[name](spark, DATA).collect()


def test_query_3(spark, table):
    got = {r.doc_id: r for r in rows(spark, "op3_secret_scan")}
    assert got.keys() == table.keys()
    for d, (t, _) in table.items():
        want = brute_spans(t)
        assert [got[d].n_assign, got[d].n_access, got[d].n_hex] == [sum(k == i for _, k, _ in want) for i in range(3)]
        assert got[d].base_sha256 == hashlib.sha256(",".join(s for _, _, s in want).encode()).hexdigest()


def test_query_4(spark, table):
    got = rows(spark, "op4_sharding")
    slots, sizes = defaultdict(list), defaultdict(int)
    assert len(got) == len(table)
    for r in got:
        t = (table[r.doc_id][0] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(t) + 1, zlib.crc32(t), "bytes", None) and 0 <= r.shard < 8
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) <= 1.05 * sum(sizes.values()) / 8 + max(r["size"] for r in got)


def test_query_6(spark, table):
    fp = {d: brute_fp(t) for d, (t, _) in table.items()}
    group = {d: d for d in fp}
    changed = True
    while changed:
        changed = False
        for a in fp:
            for b in fp:
                if group[a] != group[b] and (fp[a] ^ fp[b]).bit_count() <= 3:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op6_simhash_near_dedup")} == {d: (f"{fp[d]:016x}", group[d]) for d in fp}


def test_query_7(spark, table):
    got = {r.doc_id: r for r in rows(spark, "op7_quality_classifier")}
    assert got.keys() == table.keys()
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    sf = "/root/testdata/sf0.01"
    marks = spark.read.parquet(f"{sf}/labels.parquet").join(queries.QUERIES["op7_quality_classifier"](spark, sf).filter("held_out"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in marks) >= 0.95 * len(marks) > 0


def test_query_8(spark, table):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path(bpe.RANKS)), special_tokens={})
    for r in rows(spark, "op8_byte_bpe"):
        t = table[r.doc_id][0] or ""
        ids = np.array(enc.encode_ordinary(t), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_query_9(spark, table):
    path, pieces, seqs = public_tokenizers.path(packing.RANKS), defaultdict(list), defaultdict(list)
    for r in rows(spark, "op9_packing"):
        ids = packing.token_ids(table[r.doc_id][0], path).astype("<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        seqs[r.sequence_id].append((r.offset, r.length))
    end = lambda parts: [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts) + 1)]
    for parts in [*pieces.values(), *seqs.values()]:
        assert [s for s, _ in sorted(parts)] == end(parts)[:-1]
    assert {d: end(p)[-1] for d, p in pieces.items()} == {d: len(packing.token_ids(t, path)) for d, (t, _) in table.items()}
    assert [end(seqs[k])[-1] for k in range(len(seqs) - 1)] == [2048] * (len(seqs) - 1)


def test_query_10(spark, table):
    got, path = rows(spark, "op10_binary_output"), public_tokenizers.path(packing.RANKS)
    line = {d: packing.token_ids(t, path) for d, (t, _) in table.items()}
    assert sorted(r.slot for r in got) == list(range(len(got))) and sum(r.n_ids for r in got) == sum(map(len, line.values()))
    whole = 0
    for r in got:
        if len(line[r.first_doc]) - r.first_at >= binout.LENGTH:  # this record holds one document alone
            assert r.ids_crc32 == zlib.crc32(line[r.first_doc][r.first_at : r.first_at + binout.LENGTH].tobytes())
            whole += 1
    assert whole > 0
