"""Quality classifier: averaged vectors of hashed words, word pairs and character n-grams, softmax, numpy SGD."""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import documents, free_name, small_batches

#: Parameters of the model. SAMPLE bounds the labelled rows that it is fitted on; word pairs have buckets of their own behind the others.
BUCKETS, PAIRS, DIM, EPOCHS, RATE, SAMPLE, SEED = 1 << 16, 1 << 16, 8, 8, 0.5, 3000, 17
GRAMS = (2, 3, 4)
THRESHOLD = 0.3
#: Words that a worker knows.
KEPT = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(word: bytes) -> list[int]:
    """Buckets of a word and of its character n-grams with boundary marks (characters, not bytes)."""
    marked = "<" + word.decode("utf-8", "replace") + ">"
    grams = [marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)]
    mask = BUCKETS - 1
    return [crc32(word) & mask, *(crc32(g.encode()) & mask for g in grams)]


def pair_buckets(h: np.ndarray) -> np.ndarray:
    """Buckets of the word 2-grams of a text with these word hashes.

    The hash of a pair is that of the difference of its words' hashes, so all pairs of a word with itself share a bucket.
    """
    return BUCKETS + (((h[1:] - h[:-1]) * _MIX) >> np.uint64(40)).astype(np.int64) % PAIRS


class Words(dict):
    """Word to its number; by number its hash, the count of its buckets, and ``of`` of them (the buckets, or the sum of their scores)."""

    def __init__(self, scores: list[float] | None = None):
        super().__init__()
        self.scores, self.hash, self.count, self.of = scores, np.zeros(1024, np.uint64), np.zeros(1024), [] if scores is None else np.zeros(1024)

    def __missing__(self, word: bytes) -> int:
        k, found = len(self), features(word)
        if k == len(self.hash):
            self.hash, self.count = np.concatenate([self.hash, self.hash]), np.concatenate([self.count, self.count])
            if self.scores is not None:
                self.of = np.concatenate([self.of, self.of])
        self.hash[k], self.count[k] = xxhash.xxh64_intdigest(word), len(found)
        if self.scores is None:
            self.of.append(np.array(found, np.int64))
        else:
            self.of[k] = sum(map(self.scores.__getitem__, found))
        self[word] = k
        return k

    def numbers(self, text: str | None) -> np.ndarray:
        """The numbers of a text's words, in order; between texts, all words are forgotten when there are too many."""
        if len(self) >= (KEPT if self.scores is not None else KEPT // 20):
            self.clear()
            self.__init__(self.scores)
        words = (text or "").encode("utf-8", "replace").split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def counted(text: str, memo: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and their shares, which sum to 1 (nothing for an empty text)."""
    k = memo.numbers(text)
    if not len(k):
        return np.zeros(0, np.int64), np.zeros(0)
    ids, n = np.unique(np.concatenate([memo.of[i] for i in k.tolist()] + [pair_buckets(memo.hash[k])]), return_counts=True)
    return ids, n / n.sum()


def fit(texts: list[str], labels: list[int]) -> dict[str, np.ndarray]:
    """Stochastic gradient descent on the softmax loss; same rows in the same order give the same model.

    Word vectors start at random, output weights at zero. Without rows, or with one label only,
    every score is that of the prior.
    """
    rng, memo = np.random.default_rng(SEED), Words()
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS + PAIRS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    rows = [counted(t, memo) for t in texts]
    steps, total = 0, max(1, EPOCHS * len(rows))
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            (ids, share), y = rows[k], labels[k]
            rate = RATE * (1 - steps / total)
            steps += 1
            share = share.astype(np.float32)[:, None]
            mean = (vectors[ids] * share).sum(0) if len(ids) else np.zeros(DIM, np.float32)
            z = mean @ weights + bias
            p = np.exp(z - z.max())
            g = p / p.sum()
            g[y] -= 1
            back = weights @ g
            weights -= rate * np.outer(mean, g)
            bias -= rate * 0.1 * g
            # the step of a bucket is fifty times its share of the text, held to 1: rare n-grams of long texts learn as well
            vectors[ids] -= rate * np.minimum(1, share * 50) * back
    return {"word_score": (vectors @ (weights[:, 1] - weights[:, 0])).astype(np.float64), "bias": np.array([float(bias[1] - bias[0])])}


def _saved(model: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, **model)
    return out.getvalue()


def train(rows: DataFrame, sample: int = SAMPLE) -> bytes:
    """Model fitted in one task on at most ``sample`` labelled rows (columns doc_id, text, quality), lowest hash of doc_id first.

    The bound is what makes one task enough; labels other than 0 and 1 and null texts are no training rows.
    The model, of fixed size (one double a bucket), comes back as bytes.
    """
    small_batches(rows.sparkSession)
    rows = rows.filter("quality in (0, 1) and text is not null and doc_id is not null").select("doc_id", "text", F.col("quality").cast("int").alias("quality"))
    picked = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", F.xxhash64("text")).limit(sample)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [p for p in parts if len(p)]
        frame = pd.concat(held) if held else pd.DataFrame({"text": [], "quality": []})
        out = io.BytesIO()
        np.savez_compressed(out, **fit(list(frame["text"]), [int(q) for q in frame["quality"]]))
        yield pd.DataFrame({"model": [out.getvalue()]})

    row = picked.coalesce(1).mapInPandas(run, "model binary").head()
    return row["model"] if row else _saved(fit([], []))  # an empty table has no task to run in


class _Scores:
    """The score of a mean vector is the mean of its buckets' scores, so a word counts by the sum of its own."""

    def __init__(self, model: bytes):
        with np.load(io.BytesIO(model)) as m:
            self.of, self.bias = m["word_score"], float(m["bias"][0])
        self.words = Words(self.of.tolist())

    def score(self, text: str | None) -> float:
        k, z = self.words.numbers(text), self.bias
        if len(k):
            w = self.words
            z += (w.of[k].sum() + self.of[pair_buckets(w.hash[k])].sum()) / (w.count[k].sum() + len(k) - 1)
        return float(1 / (1 + np.exp(-z)))


@cache
def _scores(model: bytes) -> _Scores:
    return _Scores(model)


def score(docs: DataFrame, model: bytes, name: str = "score") -> DataFrame:
    """``docs`` with column ``name``: the chance of label 1, from the whole text alone; null and empty texts get the prior's."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # one double a bucket, whatever the input

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        s = _scores(sent.value)
        for t in texts:
            yield pd.Series([s.score(x) for x in t], dtype="float64")

    return docs.withColumn(name, scored(F.col("text").cast("string")))


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")), F.lit(5)) == 0


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Training rows: ``sample`` documents with text and a label outside the held-out fifth, one row a doc_id, lowest hash of doc_id first.

    Labels without a document, or of null texts only, are none. Repeated labels of a doc_id count once, by the larger;
    repeated documents by the larger text.
    """
    marks = labels.filter(~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("quality in (0, 1)")
    have = docs.filter("text is not null and doc_id is not null").select("doc_id")
    picked = marks.join(have, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("text").alias("text"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document with a doc_id; repeated rows repeat."""
    docs = documents(spark, sf_dir).select("doc_id", "text").filter("doc_id is not null")
    model = train(labelled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is at least ``threshold``, with their own columns, whatever their names.

    Rows with a null doc_id are scored by their text like others; null and empty texts have the prior's score. Repeated
    rows stay or go together; without usable labels every score is 0.5 and all stay. An empty table stays empty.
    """
    model = train(labelled(docs, labels))
    name = free_name(docs, "_score")
    return score(docs, model, name).filter(F.col(name) >= threshold).drop(name)
