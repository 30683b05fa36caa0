"""Projection helpers (F2-F5): update-column drop, all-NULL row drop, audit stamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.schemas import UPDATE_COLUMNS


def drop_update_columns(df: DataFrame) -> DataFrame:
    """history rows never carry the update audit pair."""
    return df.drop(*UPDATE_COLUMNS)


def drop_all_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows whose columns (or ``subset``) are all NULL."""
    return df.na.drop(how="all", subset=list(subset) if subset else None)


def stamp_insert(df: DataFrame) -> DataFrame:
    """Insert time and user, set by the writer (both, always; D14)."""
    return df.withColumn("row_insert_tsp", F.current_timestamp()).withColumn("insert_user_id", F.current_user())


def stamp_update(df: DataFrame) -> DataFrame:
    """update time and user of a current-state row."""
    return df.withColumn("row_updt_tsp", F.current_timestamp()).withColumn("update_user_id", F.current_user())
