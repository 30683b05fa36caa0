"""Latest-per-key reductions.

Both are windows whose only consumer is a rank filter, so Catalyst plans a
partial ``WindowGroupLimit`` before the shuffle: each map task forwards only
its local leaders per key, which keeps one hot key (even a third of all
rows) from landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def latest_with_ties(df: DataFrame, keys: Sequence[str], order: str | Column = "msg_tm") -> DataFrame:
    """A1: rows whose ``order`` equals the key's maximum; ties all kept, NULL times never win."""
    o = F.col(order) if isinstance(order, str) else order
    w = Window.partitionBy(*_cols(keys)).orderBy(o.desc_nulls_last())
    return df.withColumn("_rk", F.rank().over(w)).where((F.col("_rk") == 1) & o.isNotNull()).drop("_rk")


def latest_one(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Exactly one row per key, the first by ``order`` (all descending, NULLs last).

    Give enough ``order`` columns to make the choice unique; with ties left the
    pick is arbitrary, as ``row_number`` is.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(*[c.desc_nulls_last() for c in _cols(order)])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def key_max(df: DataFrame, keys: Sequence[str], col: str = "msg_tm", alias: str = "max_time") -> DataFrame:
    """The per-key maximum as a column on every row.

    An aggregate (summed up in the tasks first) that is joined back, so that a hot key's
    rows need not meet in one task; NULL keys form a group like any other.
    """
    found = df.groupBy(*[c.alias(f"_k{i}") for i, c in enumerate(_cols(keys))]).agg(F.max(col).alias(alias))
    same = [c.eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(_cols(keys))]
    return df.join(found, same).drop(*[f"_k{i}" for i in range(len(keys))])
