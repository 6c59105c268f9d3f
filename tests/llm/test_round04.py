"""Findings of round 4: phrases beyond the exact table of steps, and their packed form."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemill.llm import phrases


def test_phrases_beyond_the_exact_table(spark, monkeypatch):
    """Steps of more frequent phrases than EXACT_ROWS go as filters: scans then send hardly more bytes than with the exact table, and the result is the same."""
    rng = random.Random(11)
    kinds = [f"w{k}" for k in range(400)]
    docs = [(k, rng.choice(["en", "de", None]), " ".join(rng.choices(kinds, weights=[1 / (i + 4) for i in range(400)], k=200))) for k in range(400)]
    docs = spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(2).localCheckpoint()
    sent, rows, scan = [], [], phrases.scan

    def watched(*a):
        found = scan(*a)
        sent[-1] += found.toArrow().nbytes
        return found

    monkeypatch.setattr(phrases, "scan", watched)
    for exact in (1 << 20, 0):
        monkeypatch.setattr(phrases, "EXACT_ROWS", exact)
        sent.append(0)
        rows.append(sorted(phrases.collocations(docs, slots=1 << 14).collect()))
    assert len(rows[0]) > 500 and rows[0] == rows[1]
    assert sent[1] < 1.1 * sent[0]


@pytest.mark.parametrize("exact", [0, 30, 150, 400])
def test_phrases_where_filters_begin(spark, monkeypatch, exact):
    """From whatever step on filters come, and though they are so full that they find everything, counts are those of the exact table."""
    rng = random.Random(7)
    kinds = [f"w{k}" for k in range(90)]
    docs = [(k, " ".join(rng.choices(kinds, weights=[1 / (i + 1) for i in range(90)], k=60))) for k in range(160)]
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "'en' AS lang", "text").localCheckpoint()
    want = Counter(tuple(w[i : i + n]) for r in docs.collect() for w in [r.text.split(" ")] for n in (1, 2, 3) for i in range(len(w) - n + 1))
    monkeypatch.setattr(phrases, "EXACT_ROWS", exact)
    counts, _ = phrases.phrase_counts(docs, slots=8)
    assert {tuple(r.phrase.split(" ")): r.f for r in counts.collect()} == {p: f for p, f in want.items() if f >= 10}


def test_packed_phrases_come_back():
    keys = pa.array([b"", b"a b.en", b".en", "été x.fr".encode(), b"w" * 70_000, b"last"], pa.binary())
    f, mark = np.array([1, 1 << 40, 0, 3, 4, 5]), phrases.mark_of(3, np.array([0, 1, 2, 3, 4, 250]), 7)
    for i, j in ((0, 6), (1, 4), (0, 1), (2, 2)):
        got = phrases.unpacked(phrases.packed(keys[i:j], f[i:j], mark[i:j]))
        assert got[0].to_pylist() == keys[i:j].to_pylist() and got[1].tolist() == f[i:j].tolist() and got[2].tolist() == mark[i:j].tolist()


def test_filters_of_steps():
    """No frequent phrase is missed or found too late, few others are found, and what a filter has found stays when later steps come."""
    h = np.random.default_rng(2).integers(0, 1 << 64, 60_000, np.uint64)
    buckets, rows = 7, []
    for step, own in ((1, h[:20_000]), (4, h[20_000:30_000])):
        for b in range(buckets):
            part = own[own % np.uint64(buckets) == b]
            rows.append((step, b, phrases.bloom(part, len(part) * phrases.BITS // 8 * 8)))
    early, late = phrases.FilteredSteps(buckets, rows[:buckets]), phrases.FilteredSteps(buckets, rows[::-1])
    assert (late.of(h[:20_000]) == 1).all() and (late.of(h[20_000:30_000]) <= 4).all()
    assert (late.of(h)[early.of(h) != phrases.NEVER] == 1).all()
    assert (late.of(h[30_000:]) != phrases.NEVER).mean() < 0.02


def test_steps_of_phrases_that_share_a_hash():
    steps = phrases.Steps(np.array([9, 5, 9, 7], np.uint64), np.array([3, 2, 1, 0]))
    assert steps.of(np.array([9, 5, 7, 6, 10], np.uint64)).tolist() == [1, 2, 0, phrases.NEVER, phrases.NEVER]
