"""Helpers shared by the corpus operators: scratch tables, checked broadcasts, distributed prefix sums."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship

#: White space of every contract here: the space and the five ASCII controls.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``; see ``session.scratch_path``."""
    return scratch_path(spark, name)


def materialise(df: DataFrame, name: str, partitionBy: str | None = None, **options: str) -> DataFrame:
    """Write to a scratch table and read it back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path, partitionBy=partitionBy)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replaced(df: DataFrame, path: str, **options: str) -> DataFrame:
    """``materialise`` to a path of the scratch folder whose earlier table is no longer read, and goes: for loops whose tables would pile up."""
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def released_shuffles(spark: SparkSession):
    """Inside, a finished write's shuffle files are removed at once, not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Before Python runs on the executors: they get this package, and Arrow batches of so many rows, so that very long texts fit a worker.

    The setting stays: frames are lazy, and it counts when they run, after the operator has returned.
    """
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def join_checked(left: DataFrame, right: DataFrame, on: list[str], how: str, max_rows: int) -> DataFrame:
    """Join that broadcasts ``right`` only if a count shows at most ``max_rows`` rows, and shuffles otherwise."""
    if len(right.limit(max_rows + 1).select(F.lit(1)).groupBy().count().filter(F.col("count") <= max_rows).head(1)):
        right = F.broadcast(right)
    return left.join(right, on, how)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by underscores until the frame has no such column (in any case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
