"""The landing layer: ``<root>/<entity>/dt=YYYY-MM-DD/part=<name>/*.parquet``.

Every value lands as text, exactly as the source rendered it, with four columns
of lineage. Files that other tools wrote straight into ``dt=...`` read back as
well.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

BASE_PART = "base"

FILES_AT_ONCE = 16

# Columns of the landing layer that are not text.
LINEAGE_TYPES = {"_ingested_at": TimestampType()}

FILE_SCHEMA = StructType(
    [
        StructField("file_path", StringType()),
        StructField("dt", StringType()),
        StructField("size_bytes", LongType()),
    ]
)


def new_batch_id() -> str:
    """An opaque id shared by all records of one run; made once, on the driver."""
    return uuid.uuid4().hex


def stamp_lineage(
    df: DataFrame,
    source_url: Column | str,
    batch_id: str,
    payload: Sequence[str] | None = None,
) -> DataFrame:
    """Adds source, batch, UTC ingest time and the raw values as JSON. NULLs stay
    in the payload; text is not escaped to ASCII."""
    fields = F.struct(*(payload if payload is not None else df.columns))
    return df.withColumns(
        {
            "_source_url": F.lit(source_url) if isinstance(source_url, str) else source_url,
            "_batch_id": F.lit(batch_id),
            "_ingested_at": F.current_timestamp(),
            "_raw_payload": F.to_json(fields, {"ignoreNullFields": "false"}),
        }
    )


def write_landing(
    df: DataFrame,
    root: str,
    entity: str,
    on: Column | dt.date | None = None,
    part: str | None = None,
) -> None:
    """Land records under their day, today by default.

    Writing the same part of a day again replaces it; a new part name adds to the
    day, so a long run can land as it goes.
    """
    day = F.current_date() if on is None else F.lit(on) if isinstance(on, dt.date) else on
    rows = df.withColumns({"dt": day.cast("date"), "part": F.lit(part or BASE_PART)})
    if isinstance(on, Column):
        # Many days at once: bring each day's rows together, so that not every
        # task writes a file for every day. AQE splits a day that is too large.
        rows = rows.hint("rebalance", F.col("dt"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "part")
        .parquet(f"{root}/{entity}")
    )


def day_of(path: Column) -> Column:
    """The ``dt=`` value of a file path, as an explicit DATE; NULL outside such a folder."""
    return F.try_to_date(F.regexp_extract(path, r"/dt=([0-9-]+)/", 1))


def canonical_path(path: Column) -> Column:
    """One spelling per file: ``file:/x`` and ``file:///x`` are the same."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def partition_files(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Every parquet file of an entity as (file_path, dt, size_bytes). A missing
    folder gives no rows. Only the listing is read, never the content."""
    try:
        listing = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(f"{root}/{entity}")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_SCHEMA).withColumn("dt", F.col("dt").cast("date"))
    files = listing.select(
        canonical_path(F.col("path")).alias("file_path"),
        day_of(F.col("path")).alias("dt"),
        F.col("length").alias("size_bytes"),
    )
    return files.filter(F.col("dt").isNotNull())


NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


@contextmanager
def nanoseconds_accepted(spark: SparkSession) -> Iterator[None]:
    """Some writers store ``_ingested_at`` in nanoseconds, a parquet type Spark
    refuses unless it may read it as a plain number. That counts both when a file's
    schema is read and when its rows are; afterwards the session is as it was."""
    before = spark.conf.get(NANOS_AS_LONG, None)
    spark.conf.set(NANOS_AS_LONG, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(NANOS_AS_LONG)
        else:
            spark.conf.set(NANOS_AS_LONG, before)


def tag_files(rows: DataFrame) -> DataFrame:
    """Rows as read from files, plus ``_file_path`` and ``dt`` from the path; a
    nanosecond ``_ingested_at`` is brought to microseconds."""
    path = F.col("_metadata.file_path")
    tagged = rows.select("*", canonical_path(path).alias("_file_path"), day_of(path).alias("dt"))
    if dict(tagged.dtypes).get("_ingested_at") == "bigint":
        tagged = tagged.withColumn("_ingested_at", F.timestamp_micros(F.expr("_ingested_at div 1000")))
    return tagged


def merge_columns(schemas: Iterable[StructType]) -> StructType:
    """Every column of any of them; the first to name one gives its type."""
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for field in schema:
            fields.setdefault(field.name.lower(), StructField(field.name, field.dataType))
    return StructType(list(fields.values()))


def common_columns(schemas: Iterable[StructType]) -> StructType:
    """Every column of any of them; text where their types differ."""
    schemas = list(schemas)
    types: dict[str, set] = {}
    for field in (f for schema in schemas for f in schema):
        types.setdefault(field.name.lower(), set()).add(field.dataType)
    merged = merge_columns(schemas)
    return StructType([StructField(f.name, f.dataType if len(types[f.name.lower()]) == 1 else StringType()) for f in merged])


def conform(rows: DataFrame, columns: StructType) -> DataFrame:
    """``rows`` with the types of ``columns``, as an insert by name would cast them, and lineage
    with its own. A value that does not fit is an error when it is read."""
    types = LINEAGE_TYPES | {f.name.lower(): f.dataType for f in columns}
    differ = [f for f in rows.schema if types.get(f.name.lower(), f.dataType) != f.dataType]
    return rows.withColumns({f.name: F.col(f"`{f.name}`").cast(types[f.name.lower()]) for f in differ}) if differ else rows


def _alike(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """The files in groups that can be read as one."""
    groups: list[tuple[StructType, list[str]]] = []

    def schema_of(path: str) -> StructType:
        return spark.read.option("recursiveFileLookup", "true").parquet(path).schema

    with ThreadPoolExecutor(FILES_AT_ONCE) as pool:
        schemas = list(pool.map(schema_of, paths))
    for path, schema in zip(paths, schemas, strict=True):
        for k, (columns, members) in enumerate(groups):
            if _same_types(columns, schema):
                groups[k] = (merge_columns([columns, schema]), [*members, path])
                break
        else:
            groups.append((schema, [path]))
    return [members for _, members in groups]


def _same_types(a: StructType, b: StructType) -> bool:
    types = {f.name.lower(): f.dataType for f in a}
    return all(types.get(f.name.lower(), f.dataType) == f.dataType for f in b)


def read_files(spark: SparkSession, paths: Sequence[str], columns: StructType | None = None) -> DataFrame:
    """The given files as one table, columns matched by name and missing ones
    NULL, with the tags of :func:`tag_files`. To be used, and its rows read, under
    :func:`nanoseconds_accepted`. Columns have the types of ``columns`` where these
    name them; else, where files differ, they are text; ``_ingested_at`` is a time. Files that cannot be merged are read apart; only
    then is each file's footer looked at alone."""
    columns = columns or StructType()

    def read(some: Sequence[str]) -> DataFrame:
        merged = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
        return conform(tag_files(merged.parquet(*some)), columns)

    try:
        return read(paths)
    except Exception as error:  # its class depends on where the schemas were merged
        groups = _alike(spark, paths) if _cannot_merge(error) else []
        if len(groups) < 2:
            raise
    parts = list(map(read, groups))
    common = common_columns(part.schema for part in parts)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [conform(part, common) for part in parts])


def _cannot_merge(error: Exception) -> bool:
    return "CANNOT_MERGE_SCHEMAS" in str(error) or "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE" in str(error)


def landed_keys(spark: SparkSession, root: str, entity: str, column: str, on: dt.date | None = None) -> DataFrame:
    """Distinct non-null values of one column already landed on a day, today by
    default. Reads that column of that partition only."""
    day = (on or dt.datetime.now(dt.UTC).date()).isoformat()
    try:
        rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/{entity}/dt={day}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], StructType([StructField(column, StringType())]))
    return rows.select(column).filter(F.col(column).isNotNull()).distinct()
