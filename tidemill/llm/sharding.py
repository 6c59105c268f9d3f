"""Sharding by a minimax contiguous partition of ordered atomic groups (expressions only)."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import documents, materialise, text_of

#: Group ends that the driver takes at most for the last part of the search.
DRIVER_ENDS = 200_000
PROBES = 16


def _ends(groups: DataFrame) -> DataFrame:
    """Groups with ``bytes_end`` and ``rows_end``: sums over all groups up to and with each one.

    The order is size, largest first, then gid: large groups stand where many small ones can even
    them out. Range partitions are summed on their own; only one total per partition meets in one place.
    """
    order = [F.desc("bytes"), F.asc("gid")]
    dealt = materialise(groups.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "groups")
    sums = dealt.groupBy("part").agg(F.sum("bytes").alias("b"), F.sum("n").alias("r"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in "br"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ends = dealt.join(F.broadcast(sums), "part").select("gid", "bytes", (F.sum("bytes").over(inside) + F.col("b0")).alias("bytes_end"), (F.sum("n").over(inside) + F.col("r0")).alias("rows_end"))
    return materialise(ends, "group-ends")


def _furthest(ends: DataFrame, marks: list[int]) -> list[int]:
    """For each mark the last group end that is not beyond it (0 if none): one pass for all marks."""
    marks_sorted = sorted(set(marks))
    at = F.size(F.filter(F.array(*(F.lit(m).cast("long") for m in marks_sorted)), lambda m: m < F.col("bytes_end")))
    rows = ends.groupBy(at.alias("at")).agg(F.max("bytes_end").alias("e")).collect()  # a row a mark at most
    best, run = {}, 0
    got = {r["at"]: r["e"] for r in rows}
    for k, m in enumerate(marks_sorted):
        run = max(run, got.get(k, 0))
        best[m] = run
    return [best[m] for m in marks]


def _cuts_of(ends: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """Greedy cuts for several capacities at once: every shard is filled until the next group would not fit."""
    cuts = [[] for _ in capacities]
    for _ in range(shards):
        found = _furthest(ends, [(c[-1] if c else 0) + cap for c, cap in zip(cuts, capacities)])
        for c, e in zip(cuts, found):
            c.append(e)
    return cuts


def minimax_cuts(ends: DataFrame, shards: int, driver_ends: int = DRIVER_ENDS) -> list[int]:
    """Ends (in bytes) of the shards for the smallest capacity with which ``shards`` shards hold all groups.

    The capacity lies between the even share (or the largest group) and that plus the largest group.
    Rounds of PROBES capacities, checked greedily in passes over the ends, narrow it until the ends
    among which cuts can still fall are few; then a plain binary search over those decides.
    """
    top = ends.agg(F.max("bytes_end").alias("total"), F.max("bytes").alias("most")).head()
    if not top or top["total"] is None:
        return [0] * shards
    total, most = top["total"], top["most"]
    low, high = max(-(-total // shards), most), max(-(-total // shards), most) + most
    first, last = _cuts_of(ends, [low, high], shards)
    if first[-1] >= total:
        return first
    while True:
        near = F.lit(False)
        for a, b in zip(first, last):
            near = near | F.col("bytes_end").between(a, b)
        few = ends.filter(near).select("bytes_end").limit(driver_ends + 1).collect()
        if len(few) <= driver_ends:
            break
        step = max(1, (high - low) // (PROBES + 1))
        caps = sorted({min(high, low + step * k) for k in range(1, PROBES + 1)})
        for cap, cuts in zip(caps, _cuts_of(ends, caps, shards)):
            if cuts[-1] >= total:
                high, last = cap, cuts
                break
            low, first = cap, cuts
        if high - low <= 1:
            return last
    known = sorted({r["bytes_end"] for r in few} | {0})

    def greedy(cap: int) -> list[int]:
        out = []
        for _ in range(shards):
            out.append(known[bisect_right(known, (out[-1] if out else 0) + cap) - 1])
        return out

    while high - low > 1:  # low does not hold all, high does
        mid = (low + high) // 2
        low, high = (low, mid) if greedy(mid)[-1] >= total else (mid, high)
    return greedy(high)


def shard_rows(docs: DataFrame, shards: int = 8, driver_ends: int = DRIVER_ENDS) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null) for every row with a doc_id.

    Rows of one text (null and empty count as one) stay together, whatever their number; the group's
    smallest doc_id names it. Slots number the rows of a shard from 0 by group order, then doc_id.
    Repeated rows get slots of their own. An empty table gives an empty result.
    """
    text = text_of()
    rows = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("sha")
    )
    rows = materialise(rows, "sizes")
    groups = rows.groupBy("sha").agg(F.min("doc_id").alias("gid"), F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    groups = materialise(groups, "text-groups")
    ends = _ends(groups.select("gid", "bytes", "n"))
    cuts = minimax_cuts(ends, shards, driver_ends)
    # the rows before each shard: the count at the last group within the shard before
    marks = ends.filter(F.col("bytes_end").isin(cuts)).select("bytes_end", "rows_end").collect()
    rows_at = {m["bytes_end"]: m["rows_end"] for m in marks} | {0: 0}
    starts = [0, *(rows_at[c] for c in cuts[:-1])]

    order = [F.desc("bytes"), F.asc("gid"), F.asc("doc_id")]
    placed = rows.join(groups.select("sha", "gid", "bytes"), "sha").drop("sha")
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = materialise(placed.select("doc_id", "size", "text_crc32", "at"), "placed")
    part = F.shiftright("at", 33)
    sums = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("r"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("r").over(before), F.lit(0)).alias("r0"))
    ranked = placed.join(F.broadcast(sums), part == F.col("part")).withColumn("rank", F.col("r0") + F.col("at").bitwiseAND((1 << 33) - 1))
    shard = F.lit(0)
    first = F.lit(0).cast("long")
    for k in range(1, shards):
        shard = F.when(F.col("rank") >= starts[k], F.lit(k)).otherwise(shard)
        first = F.when(F.col("rank") >= starts[k], F.lit(starts[k]).cast("long")).otherwise(first)
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), shard.cast("int").alias("shard"), (F.col("rank") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(documents(spark, sf_dir))
