"""The exactly-once load from landing files into append-only raw tables.

Layout of a raw store::

    <store>/data/<entity>/load_id=<id>/dt=<day>/*.parquet
    <store>/ledger/load_id=<id>/*.parquet        one row per file, and the columns they brought
    <store>/failures/*.parquet                   files that could not be read

Plain parquet has no transactions, so the ledger is the commit: a load writes its
rows under a load id of its own, then its ledger rows in one small file. Readers
take only load ids the ledger knows. A run that dies in between leaves rows
nobody reads, and its files are still new to the next run. A load id is never
used by two runs, and a committed one never written again.

A column in another type than the table's is cast, as an insert by name would. A
file that cannot be read, or has values that cannot be cast, does not hold up the others: it is set aside in ``failures`` and is still new to
the next run. Any other error (no space left, executors lost too often) ends the
load as it is.

The columns a load brought are kept with its ledger rows, so they become known in
the same commit, and a read opens no footers to find them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from antecede.sources.landing import FILES_AT_ONCE, merge_columns, nanoseconds_accepted, partition_files, read_files

ENTITIES = ("events", "bouts", "fighters")

LEDGER_DDL = """entity STRING, file_path STRING, dt DATE, row_count BIGINT, loaded_at TIMESTAMP, load_id STRING"""

FILES_DDL = "file_path STRING, dt DATE, size_bytes BIGINT"

FAILURES_DDL = "entity STRING, file_path STRING, reason STRING, failed_at TIMESTAMP"

REPORT_DDL = "entity STRING, files_loaded BIGINT, files_skipped BIGINT, rows_loaded BIGINT"

# Files per commit: bounds the path list a load holds at once.
FILES_PER_COMMIT = 10_000


@dataclass(frozen=True)
class LoadResult:
    """What one load of an entity did."""

    entity: str
    files_loaded: int
    files_skipped: int
    rows_loaded: int
    files_failed: int = 0


def _data(store: str, entity: str) -> str:
    return f"{store}/data/{entity}"


def read_ledger(spark: SparkSession, store: str, entity: str | None = None) -> DataFrame:
    """One row per loaded file; empty before the first load."""
    schema = StructType.fromDDL(LEDGER_DDL)
    try:
        ledger = spark.read.schema(schema).parquet(f"{store}/ledger")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        ledger = spark.createDataFrame([], schema)
    return ledger if entity is None else ledger.filter(F.col("entity") == entity)


def read_failures(spark: SparkSession, store: str, entity: str | None = None) -> DataFrame:
    """One row each time a file could not be read."""
    schema = StructType.fromDDL(FAILURES_DDL)
    try:
        failures = spark.read.schema(schema).parquet(f"{store}/failures")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        failures = spark.createDataFrame([], schema)
    return failures if entity is None else failures.filter(F.col("entity") == entity)


def known_columns(spark: SparkSession, store: str, entity: str) -> StructType:
    """The columns that committed loads of an entity have brought, in the order they came."""
    try:
        kept = spark.read.schema("entity STRING, place BIGINT, added STRING").parquet(f"{store}/ledger")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return StructType()
    # One value for each load that brought a new column.
    mine = kept.filter((F.col("entity") == entity) & F.col("added").isNotNull()).select("place", "added").distinct()
    return merge_columns(StructType.fromJson(json.loads(r["added"])) for r in mine.orderBy("place", "added").collect())


def added_columns(known: StructType, columns: StructType) -> StructType:
    """What a load brings beyond the known columns."""
    names = {field.name.lower() for field in known}
    return StructType([StructField(f.name, f.dataType) for f in columns if f.name.lower() not in names])


def read_raw(spark: SparkSession, store: str, entity: str, declared: StructType | None = None) -> DataFrame:
    """The raw table: committed loads only, every column any file had, ``dt`` as
    a date. Before the first load it is empty, with the ``declared`` columns. The
    semi join is on a partition column, so only the folders of committed loads are
    read."""
    columns = merge_columns(x for x in (known_columns(spark, store, entity), declared) if x is not None)
    partitions = [StructField("load_id", StringType()), StructField("dt", StringType())]
    fields = [f for f in columns if f.name not in ("load_id", "dt", "_file_path")]
    try:
        rows = spark.read.schema(StructType(fields + partitions)).parquet(_data(store, entity))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        rows = spark.createDataFrame([], StructType(fields + partitions))
    committed = read_ledger(spark, store, entity).select("load_id").distinct()
    rows = rows.join(committed, "load_id", "left_semi").drop("load_id")
    return rows.withColumn("dt", F.col("dt").cast("date"))


def commit_ledger(
    spark: SparkSession,
    files: DataFrame,
    counts: DataFrame,
    store: str,
    entity: str,
    load_id: str,
    known: StructType,
    columns: StructType,
) -> None:
    """Write the ledger rows of one load, and with them the columns it has beyond the ``known``
    ones. ``files`` may hold files without rows; they are logged with a count of 0."""
    added = added_columns(known, columns)
    rows = files.join(counts, "file_path", "left").select(
        F.lit(entity).alias("entity"),
        "file_path",
        "dt",
        F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
        F.current_timestamp().alias("loaded_at"),
        F.lit(len(known.fields)).cast("bigint").alias("place"),
        F.lit(added.json() if added.fields else None).cast("string").alias("added"),
    )
    rows.coalesce(1).write.mode("overwrite").parquet(f"{store}/ledger/load_id={load_id}")


def append_rows(rows: DataFrame, store: str, entity: str, load_id: str) -> None:
    """Write the rows of one load, by day. Writing the same load id again
    replaces it."""
    rows.write.mode("overwrite").partitionBy("dt").parquet(f"{_data(store, entity)}/load_id={load_id}")


def rows_per_file(spark: SparkSession, store: str, entity: str, load_id: str) -> DataFrame:
    """(file_path, row_count) of one load, from what was written."""
    rows = spark.read.schema("_file_path STRING").parquet(f"{_data(store, entity)}/load_id={load_id}")
    return rows.groupBy(F.col("_file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("row_count"))


def _chunks(files: DataFrame, size: int) -> Iterator[list]:
    """The files in order, ``size`` at a time; one job where they are no more than that."""
    first = files.limit(size + 1).collect()
    if len(first) <= size:
        yield from [first] if first else []
        return
    rows = files.toLocalIterator()
    while chunk := list(islice(rows, size)):
        yield chunk


#: What errors say that lie in a file, not in the cluster.
_FILE_ERRORS = (
    "FAILED_READ_FILE",
    "CANNOT_READ_FILE_FOOTER",
    "CANNOT_MERGE_SCHEMAS",
    "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE",
    "UNABLE_TO_INFER_SCHEMA",
    "PARQUET_TYPE",
    "PARQUET_COLUMN_DATA_TYPE_MISMATCH",
    "PATH_NOT_FOUND",
    "CAST_INVALID_INPUT",
    "CAST_OVERFLOW",
    "CAST_WITHOUT_SUGGESTION",
)


def lies_in_file(error: Exception) -> bool:
    """Whether an error is one of reading a file."""
    return any(token in str(error) for token in _FILE_ERRORS)


def _sort_out(spark: SparkSession, files: list, known: StructType) -> tuple[list, list[tuple]]:
    """The files that can be read into a table of the ``known`` columns, and (path, reason) of the
    others: each is read alone to its end, several at a time. Nothing is written."""

    def trouble(file) -> Exception | None:
        try:
            read_files(spark, [file["file_path"]], known).write.format("noop").mode("overwrite").save()
        except Exception as error:
            return error

    with ThreadPoolExecutor(FILES_AT_ONCE) as pool:
        found = list(zip(files, pool.map(trouble, files), strict=True))
    for _, error in found:
        if error is not None and not lies_in_file(error):
            raise error
    bad = [(f["file_path"], next(iter(str(e).strip().splitlines()), type(e).__name__)[:500]) for f, e in found if e is not None]
    return [f for f, e in found if e is None], bad


def load_files(spark: SparkSession, files: list, store: str, entity: str) -> tuple[int, int, int]:
    """Commit some files (rows of ``FILES_DDL``) under one load id; (loaded, rows, failed). To be
    used under :func:`nanoseconds_accepted`."""
    load_id = f"load-{uuid.uuid4().hex}"
    known, bad = known_columns(spark, store, entity), []
    try:
        rows = read_files(spark, [f["file_path"] for f in files], known)
        append_rows(rows, store, entity, load_id)
    except Exception as error:
        if not lies_in_file(error):
            raise
        files, bad = _sort_out(spark, files, known)
        if not bad:
            raise
        _set_aside(spark, store, entity, bad)
        if not files:
            return 0, 0, len(bad)
        rows = read_files(spark, [f["file_path"] for f in files], known)
        append_rows(rows, store, entity, load_id)  # what the first try left is replaced
    listed = spark.createDataFrame(files, FILES_DDL)
    counts = rows_per_file(spark, store, entity, load_id)
    commit_ledger(spark, listed, counts, store, entity, load_id, known, rows.schema)
    done = read_ledger(spark, store, entity).filter(F.col("load_id") == load_id)
    return len(files), done.agg(F.sum("row_count").alias("n")).first()["n"], len(bad)


def _set_aside(spark: SparkSession, store: str, entity: str, bad: list[tuple]) -> None:
    rows = spark.createDataFrame([(entity, *b) for b in bad], "entity STRING, file_path STRING, reason STRING")
    stamped = rows.withColumn("failed_at", F.current_timestamp())
    stamped.coalesce(1).write.mode("append").parquet(f"{store}/failures")


def load_entity(
    spark: SparkSession, root: str, entity: str, store: str, files_per_commit: int = FILES_PER_COMMIT
) -> LoadResult:
    """Append every not yet loaded file of an entity, each file once."""
    files = partition_files(spark, root, entity)
    known = read_ledger(spark, store, entity).select("file_path")
    flagged = files.join(known.withColumn("_known", F.lit(True)), "file_path", "left")
    skipped = flagged.agg(F.count_if("_known").alias("n")).first()["n"]
    new = flagged.filter(F.col("_known").isNull()).drop("_known").orderBy("dt", "file_path")

    total = [0, 0, 0]
    with nanoseconds_accepted(spark):
        for chunk in _chunks(new, files_per_commit):
            total = [a + b for a, b in zip(total, load_files(spark, chunk, store, entity), strict=True)]
    return LoadResult(entity, total[0], skipped, total[1], total[2])


def load_all(
    spark: SparkSession, root: str, store: str, entities: Sequence[str] = ENTITIES
) -> list[LoadResult]:
    """Load every entity, in order; each stands alone."""
    return [load_entity(spark, root, entity, store) for entity in entities]


def report(spark: SparkSession, results: Sequence[LoadResult]) -> DataFrame:
    """Load results as a table."""
    rows = [(r.entity, r.files_loaded, r.files_skipped, r.rows_loaded) for r in results]
    return spark.createDataFrame(rows, REPORT_DDL)
