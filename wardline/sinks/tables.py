"""Path-based tables (parquet directories on the shared file system): K12-K17.

Every rewrite is staged: the new contents are written next to the table and
swapped in by two renames, so a failed job leaves the old version intact
and a table is never overwritten while it is being read (Spark refuses that).
A rewrite notes the table's files before it reads them and fails if there are
others when it comes to the swap, so rows that a running ingest appends
meanwhile are not lost.

Rewritten files are named ``folded-*``, which the table tail passes over: rows
that were rewritten are not new.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardline.schemas import CURRENT, HISTORY

#: Folder of the batches that compaction has folded, and the mark of the last of them.
BATCH = "_batch_id"
FOLDED = -1
FOLDED_PREFIX = "folded-"
#: A name pattern for every other file, whoever wrote it: it differs from the prefix at some sign, or ends before it.
NOT_REWRITTEN = "{" + ",".join(f"{FOLDED_PREFIX[:i]}[^{c}]*,{FOLDED_PREFIX[:i + 1]}" for i, c in enumerate(FOLDED_PREFIX[:-1])) + f",{FOLDED_PREFIX[:-1]}[^-]*" + "}"


class ConcurrentWrite(RuntimeError):
    """The table got other files between a rewrite's read and its swap."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def data_files(spark: SparkSession, path: str) -> set[str]:
    """The data files below a table's folder; hidden files and folders (``_…``, ``.…``) aside."""
    fs, p, _ = _fs(spark, path)
    found: set[str] = set()
    todo = [p] if fs.exists(p) else []
    while todo:
        for st in fs.listStatus(todo.pop()):
            name = st.getPath().getName()
            if st.isDirectory() and (not name.startswith(("_", ".")) or "=" in name):
                todo.append(st.getPath())
            elif st.isFile() and not name.startswith(("_", ".")):
                found.add(st.getPath().toString())
    return found


def write_property(spark: SparkSession, path: str, name: str, value: str) -> None:
    """A small fact about a table, beside its data (hidden from scans)."""
    _write_text(spark, f"{path.rstrip('/')}/_wardline_{name}", value)


def read_property(spark: SparkSession, path: str, name: str) -> str | None:
    fs, p, jvm = _fs(spark, f"{path.rstrip('/')}/_wardline_{name}")
    if not fs.exists(p):
        return None
    return _read_text(spark, p.toString())


def ensure_table(spark: SparkSession, path: str, schema: StructType, partition_by: list[str] | None = None) -> bool:
    """Create an empty table when missing (an existing empty table is left alone, D17).
    Returns True when it created one."""
    if exists(spark, path):
        return False
    w = spark.createDataFrame([], schema).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    write_property(spark, path, "schema", schema.json())
    return True


def create_tables(spark: SparkSession, root: str, buckets: int | None = None) -> dict[str, str]:
    """The four history tables (by batch) and the four current-state tables (by bucket) under ``root``."""
    from wardline.sinks.upsert import create_current

    out = {name: f"{root.rstrip('/')}/{name}" for name in (*HISTORY, *CURRENT)}
    for name, schema in HISTORY.items():
        ensure_table(spark, out[name], StructType(list(schema.fields)).add(BATCH, "integer"), [BATCH])
    for name, schema in CURRENT.items():
        create_current(spark, out[name], schema, **({"buckets": buckets} if buckets else {}))
    return out


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table, one without any file included."""
    schema = read_property(spark, path, "schema")
    if schema is None or data_files(spark, path):
        return spark.read.option("ignoreMissingFiles", "false").parquet(path)
    return spark.createDataFrame([], StructType.fromJson(json.loads(schema)))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a path table, read from its top-level ``name=value`` folders."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and "=" in name:
            first = name.split("=", 1)[0]
            deeper = partition_columns(spark, st.getPath().toString())
            return [first, *deeper]
    return []


def swap_in(spark: SparkSession, staged: str, path: str, seen: set[str] | None = None) -> None:
    """Replace ``path`` by the fully written ``staged`` directory (two renames).

    ``seen`` are the files that the rewrite read; others by now mean rows it does not
    hold, and the swap fails instead of losing them. Properties move along.
    """
    fs, target, jvm = _fs(spark, path)
    src = jvm.org.apache.hadoop.fs.Path(staged)
    old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:8]}")
    had = fs.exists(target)
    if had and seen is not None and data_files(spark, path) != seen:
        fs.delete(src, True)
        raise ConcurrentWrite(f"{path} was written to while it was being rewritten")
    if had:
        for st in fs.listStatus(target):
            name = st.getPath().getName()
            if name.startswith("_wardline_") and not fs.exists(jvm.org.apache.hadoop.fs.Path(src, name)):
                write_property(spark, staged, name.removeprefix("_wardline_"), read_property(spark, path, name.removeprefix("_wardline_")))
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if had and seen is not None:
        late = {f.replace(old.toString(), target.toString(), 1) for f in data_files(spark, old.toString())}
        if {f.rsplit("/", 1)[-1] for f in late} != {f.rsplit("/", 1)[-1] for f in seen}:
            fs.rename(old, target)
            fs.delete(src, True)
            raise ConcurrentWrite(f"{path} was written to while it was being rewritten")
    if not fs.rename(src, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot swap {staged} into {path}")
    if had:
        fs.delete(old, True)


def stage(df: DataFrame, path: str, partition_by: list[str] | None = None, rewritten: bool = False, clustered: bool = False) -> str:
    """Write ``df`` beside ``path``; returns the staged directory. The table's own
    partitioning is kept unless ``partition_by`` says otherwise, and each folder's rows are
    brought together first (large folders still go to several tasks), unless they are ``clustered`` already."""
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex[:8]}"
    if partition_by is None:
        partition_by = [c for c in partition_columns(spark, path) if c in df.columns]
    if partition_by and not clustered:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(staged)
    if rewritten:
        mark_rewritten(spark, staged)
    return staged


def mark_rewritten(spark: SparkSession, staged: str) -> None:
    """Name the data files so that a tail of the table passes them over."""
    fs, _, jvm = _fs(spark, staged)
    for f in data_files(spark, staged):
        p = jvm.org.apache.hadoop.fs.Path(f)
        if not p.getName().startswith(FOLDED_PREFIX):
            fs.rename(p, jvm.org.apache.hadoop.fs.Path(p.getParent(), FOLDED_PREFIX + p.getName()))


FILE = "_file"


def with_file(rows: DataFrame, *columns: str) -> DataFrame:
    """Columns of a table's scan, and a hash of the file that each row comes from: a path would be most of such a row."""
    return rows.select(*columns, F.xxhash64(F.col("_metadata.file_path")).alias(FILE))


def files_of(rows: DataFrame, files: set[str]) -> set[str]:
    """Which of a table's ``files`` rows of :func:`with_file` come from: one number a file reaches the driver.
    Of two files with one hash both are given."""
    spark, path = rows.sparkSession, rows.sparkSession._jvm.org.apache.hadoop.fs.Path
    named = spark.createDataFrame([(f, path(f).toUri().toString()) for f in sorted(files)], "file string, uri string")
    hashes = [(r[0], r[1]) for r in named.select("file", F.xxhash64("uri")).collect()]
    found = {r[0] for r in rows.select(FILE).distinct().collect()}
    if not found <= {h for _, h in hashes}:
        raise ValueError("rows come from a file that is none of the table's")
    return {f for f, h in hashes if h in found}


def read_files(spark: SparkSession, path: str, files: set[str]) -> DataFrame:
    """Rows of some of a table's files, partition columns included; a file that vanished is an error."""
    return spark.read.option("ignoreMissingFiles", "false").option("basePath", path).parquet(*sorted(files))


def replace_files(spark: SparkSession, path: str, staged: str | None, touched: set[str], seen: set[str]) -> None:
    """Put a rewrite of the ``touched`` files in their place: the staged folder takes the table's other files, by
    renames (they keep name and time), and becomes the table. ``staged`` None: nothing is left of them.

    A journal beside the table is written first. After a crash :func:`recover` rolls the rewrite back if the
    table had not yet been moved aside, else forward; meanwhile readers find no table rather than half of one.
    """
    fs, target, jvm = _fs(spark, path)
    base = path.rstrip("/")
    if data_files(spark, path) != seen:
        if staged:
            fs.delete(jvm.org.apache.hadoop.fs.Path(staged), True)
        raise ConcurrentWrite(f"{path} was written to while it was being rewritten")
    if staged is None:
        staged = f"{base}.staged-{uuid.uuid4().hex[:8]}"
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(staged))
    old, here = f"{base}.old-{uuid.uuid4().hex[:8]}", target.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    kept = sorted(f.removeprefix(here).lstrip("/") for f in seen - touched)
    _write_text(spark, f"{base}.journal", json.dumps({"staged": staged, "old": old, "kept": kept}))
    if not fs.rename(target, jvm.org.apache.hadoop.fs.Path(old)):
        recover(spark, path)
        raise OSError(f"cannot move {path} aside")
    aside = jvm.org.apache.hadoop.fs.Path(old).makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    if {f.removeprefix(aside) for f in data_files(spark, old)} != {f.removeprefix(here) for f in seen}:  # an append came between
        fs.rename(jvm.org.apache.hadoop.fs.Path(old), target)
        recover(spark, path)
        raise ConcurrentWrite(f"{path} was written to while it was being rewritten")
    recover(spark, path)


def recover(spark: SparkSession, path: str) -> None:
    """Finish, or undo, a rewrite of single files that was cut off."""
    base = path.rstrip("/")
    fs, target, jvm = _fs(spark, path)
    journal = jvm.org.apache.hadoop.fs.Path(f"{base}.journal")
    if not fs.exists(journal):
        return
    plan = json.loads(_read_text(spark, journal.toString()))
    staged, old = (jvm.org.apache.hadoop.fs.Path(plan[k]) for k in ("staged", "old"))
    if fs.exists(old) and not fs.exists(target):  # forward
        for name in plan["kept"]:
            src, dst = jvm.org.apache.hadoop.fs.Path(old, name), jvm.org.apache.hadoop.fs.Path(staged, name)
            if fs.exists(src):
                fs.mkdirs(dst.getParent())
                if not fs.rename(src, dst):
                    raise OSError(f"cannot move {src.toString()}")
        for st in fs.listStatus(old):  # the table's properties
            if st.getPath().getName().startswith("_wardline_"):
                fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(staged, st.getPath().getName()))
        if not fs.rename(staged, target):
            raise OSError(f"cannot swap {plan['staged']} into {path}")
    for gone in (staged, old):
        if fs.exists(gone):
            fs.delete(gone, True)
    fs.delete(journal, False)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p, _ = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def overwrite_table(spark: SparkSession, df: DataFrame, path: str, partition_by: list[str] | None = None, clustered: bool = False) -> None:
    """Full overwrite through a staged copy (safe even when ``df`` reads ``path``); ``clustered`` as in :func:`stage`."""
    swap_in(spark, stage(df, path, partition_by, clustered=clustered), path)


def truncate_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """Empty the table, keeping its schema."""
    overwrite_table(spark, spark.createDataFrame([], schema), path)


def insert_select(df: DataFrame, path: str, schema: StructType) -> None:
    """Positional INSERT ... SELECT: columns taken in order, cast to the table's types.

    As many columns as the table has, or an error.
    """
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns given, the table has {len(schema.fields)}")
    cols = [F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(df.columns, schema.fields, strict=True)]
    df.select(*cols).write.mode("append").parquet(path)


def append_batch_rows(df: DataFrame, batch_id: int, path: str, observed: tuple = ()) -> bool:
    """Append a batch under its id; a retried batch replaces itself, a folded one is left alone.

    ``observed`` is an Observation and its metrics. Returns whether the rows were written.
    """
    mark = read_property(df.sparkSession, path, "folded")
    if mark is not None and batch_id <= int(mark):
        return False
    out = df.withColumn(BATCH, F.lit(int(batch_id)))
    if observed:
        out = out.observe(*observed)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)
    return True


def commit_batch(spark: SparkSession, batch_id: int, commits: str, rows: dict[str, int]) -> None:
    """The record that all tables of a batch are written, made after the last of them; rows by table."""
    write_property(spark, commits, f"batch_{int(batch_id)}", json.dumps(rows))


def committed(spark: SparkSession, commits: str) -> list[int]:
    """The batches that are committed: one number a batch."""
    fs, p, _ = _fs(spark, commits)
    mark = "_wardline_batch_"
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n.removeprefix(mark)) for n in names if n.startswith(mark))


def read_committed(spark: SparkSession, path: str, commits: str) -> DataFrame:
    """A history's rows of committed batches (and of folded ones, which were): of a batch that was cut off
    between two tables no table shows a row. The batch is a partition column, so other batches' files are not read."""
    done = [FOLDED, *committed(spark, commits)]
    rows = read_history(spark, path)
    return rows.join(F.broadcast(spark.createDataFrame([(b,) for b in done], f"{BATCH} integer")), BATCH, "left_semi")


def compact(spark: SparkSession, path: str, col: str = "row_insert_tsp", files: int | None = None, keep_batches: int = 1) -> None:
    """Rewrite the table range-partitioned and sorted on ``col`` (one-column clustering).

    A history's batch folders are folded into one, but for the newest ``keep_batches``,
    which a restarted stream may replay; the mark of the last folded batch keeps
    older replays out. Equal values of ``col`` are split by a hash of the row, so a
    batch that shares one stamp still goes to as many files as its size asks for.
    ``files`` defaults to what the table's scan would be cut into.
    """
    seen = data_files(spark, path)
    if not seen:
        return
    df = spark.read.option("ignoreMissingFiles", "false").parquet(path)
    n = files or max(1, df.rdd.getNumPartitions())
    parts = partition_columns(spark, path)
    mark = None
    if parts == [BATCH]:
        newest = sorted(r[0] for r in df.where(F.col(BATCH) != FOLDED).select(BATCH).distinct().collect())  # one number a batch
        older = newest[: max(0, len(newest) - keep_batches)]
        mark = max(older, default=None)
        if mark is not None:
            df = df.withColumn(BATCH, F.when(F.col(BATCH) <= mark, F.lit(FOLDED)).otherwise(F.col(BATCH)))
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    clustered = df.repartitionByRange(n, *[F.col(c) for c in parts], F.col(col), spread).sortWithinPartitions(*parts, col)
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex[:8]}"
    w = clustered.write.mode("errorifexists")
    (w.partitionBy(*parts) if parts else w).parquet(staged)
    mark_rewritten(spark, staged)
    if mark is not None:
        write_property(spark, staged, "folded", str(mark))
    swap_in(spark, staged, path, seen)
