import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    os.environ.setdefault("TZ", "UTC")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "3").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
