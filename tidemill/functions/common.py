"""Column expressions that many operators share."""

from __future__ import annotations

from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero or the result is not finite."""
    x = a / F.nullif(b, F.lit(0.0))
    return F.when(F.abs(x) < float("inf"), x)


def bands(x: Column, steps: list[tuple[str, float, str]], other: str) -> Column:
    """Verdict: the first (operator, limit, name) that holds, else ``other``."""
    out = None
    test = {"<": lambda v, c: v < c, "<=": lambda v, c: v <= c, ">": lambda v, c: v > c, ">=": lambda v, c: v >= c}
    for op, limit, name in steps:
        cond = test[op](x, F.lit(limit))
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(other)


def bands_sql(x: str, steps: list[tuple[str, float, str]], other: str) -> str:
    """The same verdict for an oracle."""
    return "CASE " + " ".join(f"WHEN {x} {op} {limit} THEN '{name}'" for op, limit, name in steps) + f" ELSE '{other}' END"


def halves_up(x: str, digits: int = 6) -> str:
    """For an oracle: ``x`` to 10 digits and then to ``digits``, halves away from zero in decimals as Spark rounds; DuckDB's rounding of doubles turns halves at random."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, 10)), {digits}) AS DOUBLE)"


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def normal_cdf(z: Column | str) -> Column:
    """Standard normal distribution function; Spark SQL has no error function. For result rows, not for raw rows."""

    @F.pandas_udf("double")  # made here: workers import this module without a session
    def cdf(z: pd.Series) -> pd.Series:
        return z.map(NormalDist().cdf, na_action="ignore").astype("float64")

    return cdf(z)


def with_total(rows: DataFrame, **totals: Column) -> DataFrame:
    """``rows`` with columns of aggregates over all of them: one row, partially aggregated and broadcast, not a window that would gather the rows in one task."""
    return rows.join(F.broadcast(rows.agg(*(c.alias(n) for n, c in totals.items()))))


def small(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """``df`` marked for a broadcast if a count shows at most ``rows`` rows, as it is otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def hhi(share: str, n: Column) -> tuple[Column, Column]:
    """Sum of squared shares, and that scaled to 0..1 over n members (1 for one)."""
    raw = F.sum(F.col(share) * F.col(share))
    return raw, F.when(n > 1, (raw - 1 / n) / (1 - 1 / n)).otherwise(1.0)
