"""The exactly-once load as a Structured Streaming job.

What streams is the listing of files (path and size, no content). The checkpoint
remembers which files were taken; each micro-batch hands its files to the same
load the batch way uses (:mod:`antecede.sources.load`). So both take the same:
times of different precision, columns that come late, files without rows, files
that cannot be read, which are set aside. There is no schema to fix for a run.

The ledger decides what is loaded. A replayed batch finds the files it has
committed there and takes the rest; batch loads and any number of streams can
share one store. Files set aside earlier are tried again when a run begins, since
the source names a path only once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from antecede.sources.landing import canonical_path, day_of, nanoseconds_accepted, partition_files
from antecede.sources.load import LoadResult, load_files, read_failures, read_ledger

LISTING_DDL = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def load_stream(
    spark: SparkSession,
    root: str,
    entity: str,
    store: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
) -> LoadResult:
    """Take every new file once, then stop (``availableNow``)."""
    before = _totals(spark, store, entity)
    failed = 0

    def take(files: DataFrame) -> None:
        nonlocal failed
        known = read_ledger(spark, store, entity).select("file_path")
        new = files.join(known, "file_path", "left_anti").orderBy("dt", "file_path").collect()  # files_per_batch at most
        if new:
            with nanoseconds_accepted(spark):
                failed += load_files(spark, new, store, entity)[2]

    again = read_failures(spark, store, entity).select("file_path").distinct()
    if not again.isEmpty():
        take(partition_files(spark, root, entity).join(again, "file_path", "left_semi"))
    listing = _listing(spark, root, entity, files_per_batch)
    if listing is not None:
        query = listing.writeStream.foreachBatch(lambda files, _: take(files)).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()
    after = _totals(spark, store, entity)
    return LoadResult(entity, after[0] - before[0], before[0], after[1] - before[1], failed)


def _listing(spark: SparkSession, root: str, entity: str, files_per_batch: int) -> DataFrame | None:
    """Files of an entity as a stream of (file_path, dt, size_bytes); None if nothing has landed."""
    try:
        files = (
            spark.readStream.format("binaryFile")
            .schema(LISTING_DDL)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .option("maxFilesPerTrigger", files_per_batch)
            .load(f"{root}/{entity}")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    path = F.col("path")
    listed = files.select(canonical_path(path).alias("file_path"), day_of(path).alias("dt"), F.col("length").alias("size_bytes"))
    return listed.filter(F.col("dt").isNotNull())


def _totals(spark: SparkSession, store: str, entity: str) -> tuple[int, int]:
    row = read_ledger(spark, store, entity).agg(F.count("*").alias("f"), F.sum("row_count").alias("r")).first()
    return row["f"], row["r"] or 0
