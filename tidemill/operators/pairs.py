"""All pairs of many series: a Gram matrix in tiles of series and stretches of the order."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import small
from ..session import materialise

#: Series of a side of a tile, on average, and places of a stretch.
SERIES, PLACES = 256, 4096


def pair_moments(rows: DataFrame, value: str, key: str = "series_id", order: str = "idx") -> DataFrame:
    """sym_a, sym_b (a before b), n, and the sums a, b, aa, bb, ab over the places that both series of a pair have; pairs without a common place give no row.

    A join of all series on the order would make a row for each pair and place. Here a tile holds the values of two blocks of series over one stretch of
    places as two matrices, whose products are the sums of all their pairs at once, so rows are pairs by stretches, and a value is sent
    once to each block of series. Values are taken from their series' mean first, which keeps variances exact and changes no correlation. Nulls are no
    values; ``order`` is a whole number, and a series has one value a place (the largest of several).
    """
    rows = rows.select(F.col(key).alias("k"), F.col(order).cast("long").alias("t"), F.col(value).cast("double").alias("x")).filter("k is not null and t is not null and x is not null")
    rows = rows.groupBy("k", "t").agg(F.max("x").alias("x"))
    means = materialise(rows.groupBy("k").agg(F.avg("x").alias("m")), "series-means")
    blocks = max(1, -(-means.count() // SERIES))
    rows = rows.join(small(means), "k").select("k", "t", (F.col("x") - F.col("m")).alias("x"), F.pmod(F.xxhash64("k"), F.lit(blocks)).cast("int").alias("own"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tiles = rows.select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.floor(F.col("t") / PLACES).alias("stretch"), "own", "k", "t", "x")
    kind = dict(rows.dtypes)["k"]

    def products(p: pd.DataFrame) -> pd.DataFrame:
        names, at = np.unique(p["k"].to_numpy(), return_inverse=True)
        places, when = np.unique(p["t"].to_numpy(), return_inverse=True)
        x, there = np.zeros((len(places), len(names))), np.zeros((len(places), len(names)))
        x[when, at], there[when, at] = p["x"].to_numpy(), 1.0
        own = np.zeros(len(names), np.int64)
        own[at] = p["own"].to_numpy()
        left, right = np.flatnonzero(own == p["i"].iloc[0]), np.flatnonzero(own == p["j"].iloc[0])
        a, b, ta, tb = x[:, left], x[:, right], there[:, left], there[:, right]
        sums = {"n": ta.T @ tb, "a": a.T @ tb, "b": ta.T @ b, "aa": (a * a).T @ tb, "bb": ta.T @ (b * b), "ab": a.T @ b}
        first, second = np.meshgrid(left, right, indexing="ij")
        keep = (sums["n"] > 0) & ((first < second) if p["i"].iloc[0] == p["j"].iloc[0] else True)
        first, second, sums = first[keep], second[keep], {c: s[keep] for c, s in sums.items()}
        turn = first > second  # names are sorted, so the smaller number is the earlier name
        for c, d in (("a", "b"), ("aa", "bb")):
            sums[c], sums[d] = np.where(turn, sums[d], sums[c]), np.where(turn, sums[c], sums[d])
        return pd.DataFrame({"sym_a": names[np.minimum(first, second)], "sym_b": names[np.maximum(first, second)], **sums})

    parts = tiles.groupBy("i", "j", "stretch").applyInPandas(products, f"sym_a {kind}, sym_b {kind}, n double, a double, b double, aa double, bb double, ab double")
    return parts.groupBy("sym_a", "sym_b").agg(F.sum("n").cast("long").alias("n"), *(F.sum(c).alias(c) for c in ("a", "b", "aa", "bb", "ab")))


def correlations(rows: DataFrame, value: str, key: str = "series_id", order: str = "idx") -> DataFrame:
    """sym_a, sym_b, rho: Pearson correlation of every pair over its common places; null without variance."""
    n, a, b = (F.col(c) for c in ("n", "a", "b"))
    va, vb = F.col("aa") - a * a / n, F.col("bb") - b * b / n
    return pair_moments(rows, value, key, order).select("sym_a", "sym_b", F.when((va > 0) & (vb > 0), (F.col("ab") - a * b / n) / F.sqrt(va * vb)).alias("rho"))
