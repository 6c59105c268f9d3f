"""Hard negatives by exact inner products: length buckets with sorted coordinate lists, pruned by feasible value ranges of an anchor's focus coordinates."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import join_checked, materialise, small_batches

#: Fixed values of the contract: scale of a component, positives of an anchor, negatives of a pair, bounds of a negative's score in tenths of the positive's.
SCALE, POSITIVES, NEGATIVES, LEAST, MOST = 256, 5, 10, 3, 9
#: Lengths in a bucket differ by this factor at most; a bucket is cut into tiles of so many components at most on average, and anchors are sent in blocks.
RATIO, TILE_VALUES, ANCHOR_ROWS = 1.25, 1 << 20, 4096
#: Coordinates of an anchor whose lists are intersected, and rows of a tile that are scored first for a threshold.
FOCUS, TRIAL = 4, 128
#: Broadcast bound for tables of one row a tile or bucket.
TILE_ROWS = 200_000
#: Rounding of cosines can't lose a row within this slack.
SLACK = 1e-9


def labelled(rows: DataFrame) -> DataFrame:
    """vec_id, label, vec (doubles), len (of the scaled vector) of the rows that take part.

    A row with a null vec_id, label or vector, or with a null or non-finite component, takes no part. Rows that repeat a
    vec_id are one row, that with the least (label, vector).
    """
    vec = F.col("embedding").cast("array<double>")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vec.alias("vec"))
    rows = rows.filter("vec_id is not null and label is not null and vec is not null")
    rows = rows.filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("m")).select("vec_id", "m.label", "m.vec")
    squares = F.aggregate(F.transform("vec", lambda x: F.pow(F.floor(x * SCALE), F.lit(2.0))), F.lit(0.0), lambda a, x: a + x)
    return rows.withColumn("len", F.sqrt(squares))


def tiled(data: DataFrame, keys: list[str], dim: int) -> DataFrame:
    """``data`` with ``bucket`` (by length) and ``cut``: with ``keys`` they name a tile of bounded size; equal vectors spread over the cuts of a bucket."""
    data = data.withColumn("bucket", F.when(F.col("len") > 0, F.floor(F.log("len") / math.log(RATIO)).cast("int")).otherwise(-(1 << 30)))
    cuts = data.groupBy(*keys, "bucket").agg(F.ceil(F.count(F.lit(1)) * max(1, dim) / TILE_VALUES).alias("cuts"))
    return join_checked(data, cuts, [*keys, "bucket"], "inner", TILE_ROWS).withColumn("cut", F.pmod(F.xxhash64("vec_id"), F.col("cuts")).cast("int")).drop("cuts")


class Tile:
    """Rows of about equal length: scaled integer vectors, unit vectors, and a sorted list of every coordinate that an anchor has asked for."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("vec_id", kind="stable")
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.raw = matrix(rows["vec"])
        self.x = np.floor(self.raw * SCALE)
        with np.errstate(over="ignore"):
            length = np.sqrt((self.x**2).sum(1))  # infinite for giants, which are then not pruned
        self.shortest, self.longest = float(length.min()), float(length.max())
        self.unit = self.x / np.where(length > 0, length, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.largest = float(np.abs(self.x).max(initial=0))

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact inner products with the rows ``at``: in doubles while all sums stay under 2^53, in whole numbers of any size beyond."""
        scaled = np.floor(q * SCALE)
        if float(np.abs(scaled).max(initial=0)) * self.largest * max(1, len(q)) < 2.0**53:
            x = self.x if len(at) == len(self.x) else self.x[at]
            return (x @ scaled).astype(np.int64)
        whole = [whole_number(v) for v in q.tolist()]
        return np.array([sum(map(int.__mul__, whole, map(whole_number, r))) for r in self.raw[at].tolist()] or [0], dtype=object)[: len(at)]

    def feasible(self, q: np.ndarray, least: float, most: float = math.inf) -> np.ndarray:
        """Rows (places in the tile) whose inner product with ``q`` can lie in [least, most].

        With angles a and b of the anchor's and a row's unit vector to a coordinate axis, the angle c between the two vectors
        lies in [|a - b|, min(a + b, 2 pi - a - b)]. A least and a most cosine bound c, so b has a feasible range, which is a range of the
        coordinate's sorted list. The ranges of the anchor's largest coordinates are intersected.
        """
        scaled = np.floor(q * SCALE)
        with np.errstate(over="ignore"):
            length, every = float(np.sqrt((scaled**2).sum())), np.arange(len(self.ids))
        if not 0 < length < math.inf or not self.longest < math.inf:
            return every
        low = least / (length * (self.longest if least > 0 else self.shortest)) if self.longest and (least > 0 or self.shortest) else -math.inf
        high = most / (length * (self.shortest if most > 0 else self.longest)) if self.shortest else math.inf
        if low > 1 + SLACK:
            return every[:0]
        wide = math.acos(max(-1.0, min(1.0, low - SLACK)))
        near = math.acos(max(-1.0, min(1.0, high + SLACK)))
        held, asked = np.zeros(len(every), np.int8), 0
        for f in np.argsort(-np.abs(scaled), kind="stable")[:FOCUS].tolist():
            a = math.acos(max(-1.0, min(1.0, scaled[f] / length)))
            first, last = max(0.0, a - wide, near - a), min(math.pi, a + wide, 2 * math.pi - near - a)
            if first > last + SLACK:
                return every[:0]
            order, values = self.coordinate(f)
            i, j = np.searchsorted(values, math.cos(min(math.pi, last)) - SLACK, "left"), np.searchsorted(values, math.cos(min(math.pi, first)) + SLACK, "right")
            if j - i < len(every):
                held[order[i:j]] += 1
                asked += 1
        return np.flatnonzero(held == asked)


def whole_number(x: float) -> int:
    """floor(SCALE * x), also where the product is beyond a double's whole numbers."""
    return int(x) * SCALE if abs(x) >= 2.0**52 else math.floor(x * SCALE)


def matrix(vectors: pd.Series) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros, which add nothing to an inner product."""
    widest = max(map(len, vectors), default=0)
    if all(len(v) == widest for v in vectors):
        return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, widest))
    return np.stack([np.pad(np.asarray(v, np.float64), (0, widest - len(v))) for v in vectors])


def widened(tile: Tile, qs: pd.Series) -> np.ndarray:
    """Anchors as rows of the tile's width; what they have beyond meets zeros."""
    q, d = matrix(qs), tile.raw.shape[1]
    return q[:, :d] if q.shape[1] >= d else np.pad(q, ((0, 0), (0, d - q.shape[1])))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by the smaller id."""
    if len(scores) > 4 * k and scores.dtype != object:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)


def saturated(scores: list) -> list[int]:
    return [max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in scores]


def nearest_in(asks: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of a tile for every anchor: a trial of a few rows gives a threshold, the lists leave what can reach it, exact products decide."""
    out = []
    if len(asks) and len(rows):
        tile = Tile(rows)
        q = widened(tile, asks["qvec"])
        trial = np.unique(np.linspace(0, len(tile.ids) - 1, min(TRIAL, len(tile.ids))).astype(np.int64))
        for n, (anchor, least) in enumerate(zip(asks["anchor_id"], asks["least"])):
            least = -math.inf if pd.isna(least) else least
            at = trial[tile.ids[trial] != anchor]
            if len(at) >= k and len(tile.ids) > TRIAL:
                least = max(least, sorted(tile.scores(q[n], at).tolist())[-k])
            at = tile.feasible(q[n], float(least))
            at = at[tile.ids[at] != anchor]
            s = tile.scores(q[n], at)
            top = best(s, tile.ids[at], k)
            out += zip([anchor] * len(top), tile.ids[at[top]].tolist(), saturated(s[top].tolist()))
    return pd.DataFrame(out, columns=["anchor_id", "vec_id", "score"])


def negatives_in(asks: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """For every anchor and positive the k best rows of a tile with another label and a score in the pair's window."""
    out = []
    if len(asks) and len(rows):
        tile = Tile(rows)
        q = widened(tile, asks["qvec"])
        trial = np.unique(np.linspace(0, len(tile.ids) - 1, min(TRIAL, len(tile.ids))).astype(np.int64))
        for n, (anchor, label, least, windows) in enumerate(zip(asks["anchor_id"], asks["label"], asks["least"], asks["windows"])):
            windows = [(int(w["positive_id"]), int(w["score"]), int(w["lo"]), int(w["hi"])) for w in windows]
            if len(tile.ids) > TRIAL:
                s = tile.scores(q[n], trial)[tile.labels[trial] != label]
                kth = [sorted(s[(s >= lo) & (s <= hi)].tolist())[-k:] for _, _, lo, hi in windows]
                if all(len(x) == k for x in kth):
                    least = max(least, min(x[0] for x in kth))
            at = tile.feasible(q[n], float(least), float(max(hi for *_, hi in windows)))
            at = at[tile.labels[at] != label]
            s = tile.scores(q[n], at)
            for positive, score, lo, hi in windows:
                fits = np.flatnonzero((s >= lo) & (s <= hi))
                top = fits[best(s[fits], tile.ids[at[fits]], k)]
                out += zip([anchor] * len(top), [positive] * len(top), [score] * len(top), tile.ids[at[top]].tolist(), saturated(s[top].tolist()))
    return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def probed(asks: DataFrame, tiles: DataFrame, keys: list[str], block: Column, kernel, schema: str) -> DataFrame:
    """``kernel`` on every tile and block of anchors that ask for it. A tile is sent once to each block of ANCHOR_ROWS anchors, not to each anchor."""
    asks = materialise(asks.withColumn("block", block), "asks")
    wanted = asks.select(*(F.col(c).alias(c) for c in [*keys, "block"])).distinct()
    sent = join_checked(tiles, wanted, keys, "inner", TILE_ROWS)
    by = [*keys, "block"]
    return asks.groupBy(*by).cogroup(sent.groupBy(*by)).applyInPandas(kernel, schema)


def two_passes(anchors: DataFrame, tiles: DataFrame, on: list[str], block: Column, kernel, schema: str, name: str, threshold) -> DataFrame:
    """What ``kernel`` finds in all tiles that can matter, the longest first.

    The first pass takes every anchor to one tile of the longest bucket; from its results ``threshold`` gives (anchor_id, bar), a score that the
    anchor's answers are sure to reach. The second pass takes it to the other tiles, but for those too short to reach the bar.
    ``anchors``: anchor_id, qvec, qlen, least (a known bar or null) and whatever the kernel reads.
    """
    keys = list(dict.fromkeys([*on, "bucket", "cut"]))
    stats = tiles.groupBy(*keys).agg(F.max("len").alias("longest"))
    first = Window.partitionBy(*on).orderBy(F.desc("bucket"), "cut") if on else Window.orderBy(F.desc("bucket"), "cut")  # a row a tile
    stats = materialise(stats.withColumn("nth", F.row_number().over(first)), f"{name}-tiles")
    if on:
        meet = lambda part, cond: join_checked(anchors, part, on, "inner", TILE_ROWS).filter(cond)
    else:
        meet = lambda part, cond: anchors.join(F.broadcast(part) if part.count() <= TILE_ROWS else part, cond)
    reach = F.col("least").isNull() | (F.col("least") <= 0) | (F.col("qlen") * F.col("longest") * (1 + SLACK) >= F.col("least"))
    found = materialise(probed(meet(stats.filter("nth = 1"), reach), tiles, keys, block, kernel, schema), name)
    rest = stats.filter("nth > 1")
    if not rest.head(1):
        return found
    anchors = anchors.join(threshold(found), "anchor_id", "left").withColumn("least", F.greatest("least", "bar")).drop("bar")
    return found.union(materialise(probed(meet(rest, reach), tiles, keys, block, kernel, schema), name))


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for each row of ``rows`` (vec_id, embedding, label) that ``anchors`` selects.

    The score of two rows is the inner product of their vectors, each component as floor(SCALE * x), in whole numbers; the positives of an anchor are the
    ``positives`` other rows of its label with the highest scores, and for each the ``negatives`` highest rows of another label with
    LEAST * p <= 10 * n <= MOST * p are returned; ties go to the smaller vec_id. Answers are exact: pruning drops only rows that cannot be in them.
    ``labelled`` says which rows take part. Shorter vectors count as filled up with zeros; a score beyond 64 bits is held at the bound. An anchor without
    another row of its label has no positives, a pair without a fitting row no negatives, an empty table no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    small_batches(spark, 2048)
    data = materialise(labelled(rows), "labelled")
    shape = data.agg(F.max(F.size("vec")), F.count_if(anchors)).head()
    dim, blocks = shape[0] or 0, max(1, -(-shape[1] // ANCHOR_ROWS))
    block = F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int")
    chosen = data.filter(anchors).select(F.col("vec_id").alias("anchor_id"), "label", F.col("vec").alias("qvec"), F.col("len").alias("qlen"))

    def kth(found: DataFrame, by: list[str], score: str, k: int) -> DataFrame:
        """The k-th best score so far of each group that has so many."""
        nth = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score)))
        return found.withColumn("nth", nth).filter(F.col("nth") == k).groupBy("anchor_id").agg(F.min(score).alias("bar"), F.count(F.lit(1)).alias("groups"))

    own = materialise(tiled(data, ["label"], dim), "label-tiles")
    near = two_passes(
        chosen.withColumn("least", F.lit(None).cast("long")), own, ["label"], block, lambda asks, part: nearest_in(asks, part, positives), "anchor_id long, vec_id long, score long", "positives",
        lambda found: kth(found, ["anchor_id"], "score", positives).drop("groups"),
    )
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= positives)
    p = F.col("score").cast("decimal(20,0)")
    near = near.withColumn("lo", F.call_function("div", p * LEAST + 9, F.lit(10).cast("decimal(2,0)"))).withColumn("hi", F.call_function("div", p * MOST, F.lit(10).cast("decimal(2,0)")))
    near = near.filter("score >= 0 and lo <= hi")
    windows = near.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("vec_id").alias("positive_id"), "score", "lo", "hi")).alias("windows"), F.min("lo").alias("least"))  # ``positives`` a row at most
    asks = materialise(chosen.join(windows, "anchor_id"), "windows")
    n_windows = asks.select("anchor_id", F.size("windows").alias("w"))

    def bar(found: DataFrame) -> DataFrame:
        """Only where every pair of the anchor has its full number of negatives is the least of their last scores a bar."""
        full = kth(found, ["anchor_id", "positive_id"], "negative_score", negatives)
        return full.join(n_windows, "anchor_id").filter("groups = w").select("anchor_id", "bar")

    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = two_passes(asks, materialise(tiled(data, [], dim), "tiles"), [], block, lambda asks, part: negatives_in(asks, part, negatives), schema, "negatives", bar)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hard_negatives`` of every vector whose vec_id is divisible by 100; where vec_id is divisible by 7 the label is the next of ten."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


ORACLE = {
    "op12_hard_negatives": f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS own, list_inner_product(a.vec, b.vec)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.own AND {10 * LEAST} * p.score <= 100 * s.score AND 100 * s.score <= {10 * MOST} * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""
}
