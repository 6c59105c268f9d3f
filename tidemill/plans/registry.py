"""All registered queries of the analytics operators, with their DuckDB oracles where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from ..sources.views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
#: Module of plans that registers each query.
MODULE: dict[str, str] = {}


def query(name: str, sql: str | None = None, digits: int = 6):
    """Register a function of the views. Operators keep full precision; double columns are rounded here, as in the oracle.

    ``sql`` names float columns in a first line ``-- floats: a b``.
    """

    def put(f: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            df = f(Views(spark, sf_dir))
            return df.select(*((F.round(F.col(c), digits) + F.lit(0.0)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        MODULE[name] = f.__module__.rpartition(".")[2]
        if sql is not None:
            head, _, body = sql.strip().partition("\n")
            floats = head.removeprefix("-- floats:").split() if head.startswith("-- floats:") else []
            ORACLE_SQL[name] = with_views(body if head.startswith("-- floats:") else sql.strip(), floats, digits)
        return f

    return put


from . import bars, catalog, indicators, io, risk, selection, stats, text, trades, workflows  # noqa: E402, F401
