"""Exact dedup over a log-structured merge index (expressions only, no Python on the executors)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import BLANKS, documents, free_name, join_checked, materialise, text_of

#: Copies of one text that are verified against one shipped image of the kept text.
SALT_ROWS = 64
#: Sorted runs of a flush, and runs that one compaction merges into a run of the next level.
RUNS, FAN_IN = 4, 4
#: Keys and set bits of a 64-bit filter word.
WORD_KEYS, WORD_BITS = 4, 4
#: Broadcast bound for tables of rows of 24 bytes or so.
BROADCAST_ROWS = 1_000_000


def normalised(name: str = "text") -> Column:
    """The text (null: empty) with every run of white space as one space.

    Single spaces, by far the most runs, are no match of the pattern and so cost nothing.
    """
    return F.regexp_replace(text_of(name), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


class DigestIndex:
    """Log-structured merge index of digests: sorted runs of (key, doc_id, n) in levels, a filter for each run.

    ``flush`` turns rows into runs of level 0: the memtables are the partial aggregates of the tasks (a hot key is one
    row in each), a run has one entry a key with its smallest doc_id and number of rows. ``compact`` merges FAN_IN runs into
    one of the next level until one run is left. An entry is merged only if the filter of another run of its group
    may hold its key; all others, most of a corpus, are surely alone in the group and pass on as they are. The filters are broadcast to
    the entries up to BROADCAST_ROWS words; beyond that the probe is a join that shuffles the entries (24 bytes or so each, no text).
    More rows may be flushed later: their runs are compacted with the run that is there.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.runs = spark, 0
        self.entries = spark.createDataFrame([], "run int, key binary, doc_id long, n long")

    def flush(self, rows: DataFrame, runs: int = RUNS) -> None:
        """Add ``rows`` (doc_id, key, run from 0 to runs - 1) as new runs of level 0."""
        own = rows.groupBy("run", "key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))
        own = own.select((F.col("run") + self.runs).cast("int").alias("run"), "key", "doc_id", "n")
        own = materialise(own.sortWithinPartitions("run", "key"), "runs")
        self.entries = self.entries.union(own) if self.runs else own
        self.runs += runs

    def probed(self) -> DataFrame:
        """Entries with ``at`` (their group, the run of the next level) and ``maybe``: whether another run's filter in the group has the key.

        A filter is a Bloom filter in 64-bit words: a key sets WORD_BITS bits of one word. A row of the filter table
        is a word, with the bits that each of the FAN_IN runs has there, so a probe is one look-up.
        """
        words = max(1, self.entries.count() // (WORD_KEYS * self.runs))
        h = F.xxhash64("key", F.lit(1))
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(WORD_BITS)]
        mask = bits[0]
        for b in bits[1:]:
            mask = mask.bitwiseOR(b)
        held = self.entries.select("*", F.floor(F.col("run") / FAN_IN).cast("int").alias("at"), F.pmod(F.xxhash64("key"), F.lit(words)).alias("word"), mask.alias("mask"))
        slot = F.pmod("run", F.lit(FAN_IN))
        filters = materialise(held.groupBy("at", "word").agg(*(F.bit_or(F.when(slot == i, F.col("mask"))).alias(f"b{i}") for i in range(FAN_IN))), "filters")
        seen = [(slot != i) & (F.coalesce(F.col(f"b{i}"), F.lit(0)).bitwiseAND(F.col("mask")) == F.col("mask")) for i in range(FAN_IN)]
        maybe = seen[0]
        for x in seen[1:]:
            maybe = maybe | x
        return join_checked(held, filters, ["at", "word"], "left", BROADCAST_ROWS).select("at", "key", "doc_id", "n", maybe.alias("maybe"))

    def compact(self) -> DataFrame:
        """The one run that is left: key, doc_id (the smallest), n."""
        while self.runs > 1:
            probed = materialise(self.probed(), "probed")
            merged = probed.filter("maybe").groupBy("at", "key").agg(F.min("doc_id").alias("doc_id"), F.sum("n").alias("n"))
            level = probed.filter("not maybe").select("at", "key", "doc_id", "n").union(merged).withColumnRenamed("at", "run")
            self.entries = materialise(level.sortWithinPartitions("run", "key"), "runs")
            self.runs = -(-self.runs // FAN_IN)
        return self.entries.select("key", "doc_id", "n")


def exact_groups(docs: DataFrame, key_bytes: int = 16) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after white-space normalisation; null counts as empty.
    Every hit of the index (a second row of a key) is compared byte for byte with the text of
    the key's smallest doc_id; keys where a comparison fails are grouped anew by whole texts,
    so short digests (``key_bytes``) change the cost, never the result.
    Rows with a null doc_id take no part. Rows that repeat a doc_id are one document: each gets
    the same verdict. An empty table gives an empty result; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sha = F.unhex(F.sha2(normalised(), 256))
    rows = docs.filter("doc_id is not null").select("doc_id", sha.alias("sha"), F.pmod(F.spark_partition_id(), F.lit(RUNS)).alias("run"))
    rows = materialise(rows, "digests").withColumn("key", F.substring("sha", 1, key_bytes))
    index = DigestIndex(docs.sparkSession)
    index.flush(rows.select("doc_id", "key", "run"))
    multi = index.compact().filter("n > 1").withColumnRenamed("doc_id", "keep_id")
    found = join_checked(rows, multi, ["key"], "left", BROADCAST_ROWS)
    found = found.select("doc_id", "sha", F.coalesce("keep_id", "doc_id").alias("keep_id"), F.coalesce("n", F.lit(1)).alias("n"))
    hits = join_checked(rows.select("doc_id", "key"), multi, ["key"], "inner", BROADCAST_ROWS).distinct()
    texts = join_checked(docs, hits, ["doc_id"], "inner", BROADCAST_ROWS).select("doc_id", "key", "keep_id", "n", normalised().alias("norm"))
    texts = texts.filter(F.substring(F.unhex(F.sha2("norm", 256)), 1, key_bytes) == F.col("key"))  # a repeated doc_id may carry other texts
    texts = materialise(texts, "hit-texts")

    salts = F.ceil(F.col("n") / SALT_ROWS).cast("int")
    copies = texts.withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts).cast("int"))
    images = texts.filter("doc_id = keep_id").select("key", F.col("norm").alias("image"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    images = images.groupBy("key", "salt").agg(F.min("image").alias("image"))
    wrong = copies.join(images, ["key", "salt"]).filter("norm <> image").select("key").distinct()
    again = texts.join(wrong, "key")
    sizes = again.groupBy("key", "norm").agg(F.min("doc_id").alias("own_id"), F.count(F.lit(1)).alias("own_n"))
    mended = again.join(sizes, ["key", "norm"]).select("doc_id", F.unhex(F.sha2("norm", 256)).alias("sha"), "own_id", "own_n").distinct()
    mended = materialise(mended, "mended")  # empty unless two texts share a key
    out = join_checked(found, mended, ["doc_id", "sha"], "left", 10_000)
    keep = F.coalesce("own_id", "keep_id")
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("own_n", "n").alias("group_size"), (F.col("doc_id") == keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns, whatever their names.

    Null texts count as empty and are copies of each other. Rows with a null doc_id have no smallest and stay all;
    rows that repeat a doc_id stay or go together. An empty table stays empty.
    """
    gone = free_name(docs, "_dropped")
    dropped = exact_groups(docs).filter(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(dropped, F.col("doc_id").cast("long") == F.col(gone), "left_anti")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``exact_groups`` of all documents."""
    return exact_groups(documents(spark, sf_dir))


ORACLE = {
    "op2_exact_dedup": rf"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{BLANKS}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)"""
}
