"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_LOCAL: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application; Spark's file server carries it to every executor."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="spark-"), f"{root.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``.

    Where that is unset, a local master gets a temporary folder of its own; on a cluster a machine-local
    folder would lose data, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="spark-")
        base = _LOCAL[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
