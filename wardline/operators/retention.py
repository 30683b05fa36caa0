"""Retention (R1-R2): drop every row of an encounter discharged before the cut-off,
then keep only child rows whose encounter survived.

Both are joins on the encounter key written as anti / semi joins, so Spark
needs no de-duplication and AQE may turn either into a broadcast join when
the runtime size of the key side is below the broadcast threshold.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.schemas import KEY


def _as_of(as_of: dt.date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def expired_keys(master: DataFrame, days: int = 2, as_of=None, key: str = KEY,
                 discharge: str = "hosp_disch_time") -> DataFrame:
    """Encounters with a discharge date before ``as_of - days``, each once.

    The DISTINCT is a partial (map-side) aggregation, so an encounter holding a
    large share of the rows collapses before the shuffle and the join's key side
    stays one row per encounter.
    """
    d = F.col(discharge)
    cut = F.date_sub(_as_of(as_of), days)
    return master.where(d.isNotNull() & (F.to_date(d) < cut)).select(key).distinct()


def key_fates(master: DataFrame, days: int = 2, as_of=None, key: str = KEY, discharge: str = "hosp_disch_time") -> DataFrame:
    """Each encounter of the master once, and whether it is ``expired`` (as :func:`expired_keys` has it): both key sets
    of a retention from one scan and one aggregation."""
    old = F.to_date(F.col(discharge)) < F.date_sub(_as_of(as_of), days)
    return master.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.coalesce(old, F.lit(False))).alias("expired"))


def prune_master(master: DataFrame, days: int = 2, as_of=None, key: str = KEY,
                 discharge: str = "hosp_disch_time") -> DataFrame:
    """All rows of expired encounters go; rows with a NULL key stay."""
    return master.join(expired_keys(master, days, as_of, key, discharge), key, "left_anti")


def prune_child(child: DataFrame, kept_master: DataFrame, key: str = KEY) -> DataFrame:
    """R2: child rows whose encounter is still in the (pruned) master; orphans and NULL keys go.
    The master's keys are de-duplicated map-side first (A5)."""
    return child.join(kept_master.select(key).distinct(), key, "left_semi")


def retention_job(spark, master_path: str, child_paths: list[str], days: int = 2, as_of=None, key: str = KEY,
                  discharge: str = "hosp_disch_time", cluster_by: str | None = "row_insert_tsp") -> dict[str, int]:
    """Prune the master and its children together; the number of files rewritten of each table.

    Only files that hold a row to drop are rewritten, found by a join over the key column and
    the file that each row comes from; what is left of them is clustered by ``cluster_by`` as it
    is written (K16 for these files; ``compact`` does it for a whole table). The others are
    renamed across. All rewrites are staged before the first table is swapped, master last, so a
    failure part-way leaves every table as it was (D21); a swap that was cut off is finished or
    undone by the next run. The tables are staged side by side, as none needs another's rewrite. A table that an ingest appended to meanwhile fails with ``ConcurrentWrite``.
    """
    from wardline.session import scratch_path
    from wardline.sinks.tables import ConcurrentWrite, data_files, files_of, partition_columns, read_files, recover, replace_files, stage, with_file

    tables = [*child_paths, master_path]
    for p in tables:
        recover(spark, p)
    seen = {p: data_files(spark, p) for p in tables}
    if not seen[master_path]:
        raise ValueError(f"{master_path} holds no files: its children would all go")
    master = read_files(spark, master_path, seen[master_path])
    fates = scratch_path(spark, "retention-keys")
    key_fates(master, days, as_of, key, discharge).write.parquet(fates)
    expired = spark.read.parquet(fates).where("expired").select(key)
    kept = spark.read.parquet(fates).where("NOT expired").select(key)

    def rewritten(p: str) -> tuple[str | None, set[str]] | None:
        rows = with_file(read_files(spark, p, seen[p]), key)
        dropped = rows.join(expired, key, "left_semi") if p == master_path else rows.join(kept, key, "left_anti")
        touched = files_of(dropped, seen[p])
        if not touched:
            return None
        rows = read_files(spark, p, touched)
        left = rows.join(expired, key, "left_anti") if p == master_path else rows.join(kept, key, "left_semi")
        if cluster_by and cluster_by in left.columns:
            parts = partition_columns(spark, p)
            spread = F.xxhash64(*[F.col(c) for c in left.columns])
            left = left.repartitionByRange(len(touched), *parts, cluster_by, spread).sortWithinPartitions(*parts, cluster_by)
            return stage(left, p, rewritten=True, clustered=True), touched
        return stage(left, p, rewritten=True), touched

    given = [p for p in tables if seen[p]]
    with ThreadPoolExecutor(max_workers=len(given)) as pool:
        staged = {p: done for p, done in zip(given, pool.map(rewritten, given), strict=True) if done}
    late = [p for p in seen if data_files(spark, p) != seen[p]]
    if late:  # before any table is swapped
        raise ConcurrentWrite(f"written to during retention: {', '.join(late)}")
    for p, (folder, touched) in staged.items():  # the master is the last
        replace_files(spark, p, folder, touched, seen[p])
    return {p: len(staged[p][1]) if p in staged else 0 for p in tables}
