"""Approximate nearest neighbours by an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import materialise, small_batches

#: Parameters. The codebooks and the number of probes are fitted on at most SAMPLE vectors and PROBE_QUERIES of them.
SAMPLE, PROBE_QUERIES, ROUNDS, SEED = 16_384, 256, 10, 5
RECALL = 0.97
K = 10
#: Words of a codebook follow the square root of the rows up to this; a cell then holds ROWS_PER_CELL rows on average.
MAX_WORDS, ROWS_PER_CELL = 1_024, 48
#: Vectors of a list and queries that one task compares at once.
LIST_ROWS, QUERY_ROWS = 16_384, 1_024


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and vec (doubles) of the rows that take part: not null, not zero, all components finite, and as long as most.

    Of vectors of several lengths the most frequent length counts (of equally frequent ones the larger).
    """
    vec = F.col("embedding").cast("array<double>")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).filter("vec_id is not null and vec is not null")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head(1)
    return rows.filter(F.size("vec") == (sizes[0]["d"] if sizes else 0))


def kmeans(x: np.ndarray, k: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        near = nearest_word(x, c)
        sums, n = np.zeros_like(c), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest_word(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    norms = (c * c).sum(1)[None, :]
    return np.concatenate([(norms - 2 * x[k : k + 2048] @ c.T).argmin(1) for k in range(0, max(1, len(x)), 2048)])


def traverse(d1: np.ndarray, d2: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells (i * len(d2) + j) in the order of d1[i] + d2[j], from a heap, until they hold ``wanted`` entries.

    Both distance lists are sorted; the cell at ranks (a, b) comes up when (a-1, b) and (a, b-1) are out.
    """
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    o1, o2, n2 = o1.tolist(), o2.tolist(), len(d2)
    reach = [0] * len(s1)  # next column of each row of the rank table
    heap, out, held = [(s1[0] + s2[0], 0, 0)], [], 0
    while heap and held < wanted:
        _, a, b = heapq.heappop(heap)
        cell = o1[a] * n2 + o2[b]
        if sizes[cell]:
            out.append(cell)
            held += int(sizes[cell])
        reach[a] = b + 1
        if b + 1 < n2 and (a == 0 or reach[a - 1] > b + 1):
            heapq.heappush(heap, (s1[a] + s2[b + 1], a, b + 1))
        if a + 1 < len(s1) and reach[a + 1] == b:
            heapq.heappush(heap, (s1[a + 1] + s2[b], a + 1, b))
    return out


class MultiIndex:
    """Codebooks for the two halves of a vector, and the share of all entries that a query visits."""

    def __init__(self, sample: np.ndarray, rows: int, recall: float = RECALL, k: int = K):
        self.half = sample.shape[1] // 2
        words = int(min(MAX_WORDS, max(2, round((rows / ROWS_PER_CELL) ** 0.5))))
        self.books = [kmeans(np.ascontiguousarray(h), words) for h in (sample[:, : self.half], sample[:, self.half :])] if self.half else [kmeans(sample, words), np.zeros((1, 0))]
        if not self.half:
            self.half = sample.shape[1]
        self.share = self._fit_share(sample, recall, k)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest_word(x[:, : self.half], self.books[0]) * len(self.books[1]) + nearest_word(x[:, self.half :], self.books[1])

    def order(self, q: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
        d1, d2 = (((b - h) ** 2).sum(1) for b, h in zip(self.books, (q[: self.half], q[self.half :])))
        return traverse(d1, d2, sizes, wanted)

    def _fit_share(self, x: np.ndarray, recall: float, k: int) -> float:
        """Share of entries up to which ``recall`` of the sample queries' true neighbours come up."""
        cells, n = self.cells(x), len(self.books[0]) * len(self.books[1])
        sizes, needed = np.bincount(cells, minlength=n), []
        for i in np.random.default_rng(SEED).choice(len(x), min(PROBE_QUERIES, len(x)), replace=False):
            d = ((x - x[i]) ** 2).sum(1)
            d[i] = np.inf
            true = np.argsort(d, kind="stable")[: min(k, len(x) - 1)]
            order = self.order(x[i], sizes, len(x))
            upto = np.zeros(n)
            upto[order] = np.cumsum(sizes[order])
            needed += (upto[cells[true]] / len(x)).tolist()
        return float(np.quantile(needed, recall)) if needed else 1.0


def search(rows: DataFrame, queries: F.Column, k: int = K, recall: float = RECALL, index: MultiIndex | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``rows`` that ``queries`` selects the k nearest other rows found.

    score is the Euclidean distance in doubles on the original vectors; ties go to the smaller vec_id. Of more
    than k + 1 equal vectors only the k + 1 smallest ids can be in any answer, so the lists hold those alone:
    a very common vector costs no more than a rare one, and no answer changes. Rows that repeat a vec_id are one
    row (with the least of their vectors). A query with fewer than k other rows gets them all.
    """
    spark = rows.sparkSession
    small_batches(spark, 2048)
    data = materialise(usable(rows).groupBy("vec_id").agg(F.min("vec").alias("vec")), "vectors")
    total = data.count()
    out_type = "query_id long, rank int, vec_id long, score double"
    if total < 2:
        return spark.createDataFrame([], out_type)
    if index is None:
        sample = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec").toPandas()  # SAMPLE vectors
        index = MultiIndex(np.stack(sample["vec"].to_numpy()), total, recall, k)
    model = spark.sparkContext.broadcast(index)  # two codebooks of MAX_WORDS words at most
    n_cells = len(index.books[0]) * len(index.books[1])
    n2 = len(index.books[1])

    @F.pandas_udf("int")
    def cell_of(vec: pd.Series) -> pd.Series:
        return pd.Series(model.value.cells(np.stack(vec.to_numpy())) if len(vec) else [], dtype="int32")

    equal = Window.partitionBy("vec").orderBy("vec_id")
    lists = data.withColumn("_nth", F.row_number().over(equal)).filter(F.col("_nth") <= k + 1).drop("_nth")
    lists = materialise(lists.withColumn("cell", cell_of("vec")), "lists")
    sizes = np.zeros(n_cells, np.int64)
    for r in lists.groupBy("cell").count().collect():  # MAX_WORDS^2 rows at most
        sizes[r["cell"]] = r["count"]
    held = int(sizes.sum())
    wanted = max(k + 1, int(np.ceil(index.share * held)))
    sent = spark.sparkContext.broadcast(sizes)

    def probes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for q, v in zip(p["vec_id"], p["vec"]):
                cells = np.array(model.value.order(np.asarray(v), sent.value, wanted))
                for g in np.unique(cells // n2):
                    out.append((q, v, int(g), cells[cells // n2 == g].tolist()))
            yield pd.DataFrame(out, columns=["query_id", "qvec", "g", "cells"])

    # a list group is a first word; groups over LIST_ROWS are cut, and so are the queries over QUERY_ROWS that meet one
    by_group = sizes.reshape(-1, n2).sum(1)
    cuts = F.array(*(F.lit(int(max(1, -(-c // LIST_ROWS)))) for c in by_group))
    asked = materialise(data.filter(queries).mapInPandas(probes, "query_id long, qvec array<double>, g int, cells array<int>"), "probes")
    blocks = max(1, -(-asked.groupBy("g").count().agg(F.max("count")).head()[0] // QUERY_ROWS)) if asked.head(1) else 1
    left = asked.withColumn("cut", F.explode(F.sequence(F.lit(0), F.get(cuts, F.col("g")) - 1))).withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    right = lists.withColumn("g", F.floor(F.col("cell") / n2).cast("int"))
    right = right.withColumn("cut", F.pmod(F.xxhash64("vec_id"), F.get(cuts, F.col("g"))).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def rerank(qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(qs) and len(xs):
            xs = xs.sort_values("cell", kind="stable")
            x, ids, cell = np.stack(xs["vec"].to_numpy()), xs["vec_id"].to_numpy(), xs["cell"].to_numpy()
            for q, v, cells in zip(qs["query_id"], qs["qvec"], qs["cells"]):
                first, stop = np.searchsorted(cell, cells, "left"), np.searchsorted(cell, cells, "right")  # the inverted lists of the cells
                n = stop - first
                at = np.repeat(stop - np.cumsum(n), n) + np.arange(n.sum())
                at = at[ids[at] != q]
                d = np.sqrt(((x[at] - np.asarray(v)) ** 2).sum(1))
                if len(at) > 4 * k:
                    near = d <= np.partition(d, k - 1)[k - 1]
                    at, d = at[near], d[near]
                best = np.lexsort((ids[at], d))[:k]
                out += zip([q] * len(best), ids[at[best]], d[best])
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    by = ["g", "cut", "block"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(rerank, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The K nearest of every vector whose vec_id is divisible by 100."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
