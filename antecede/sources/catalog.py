"""Where layers live: the layer's name is the database's name, verbatim."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from antecede.session import scratch_path

LAYERS = ("raw", "staging", "marts")


def database_for(layer: str | None, default: str = "default") -> str:
    """The database of a layer; no prefix is added."""
    return default if layer is None else layer.strip()


def full_name(layer: str | None, name: str) -> str:
    """``database.name``, quoted for SQL."""
    return f"`{database_for(layer)}`.`{name}`"


def create_layers(spark: SparkSession, layers: Sequence[str] = LAYERS) -> None:
    """The databases of the layers, where they do not exist."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database_for(layer)}`")


def publish(
    df: DataFrame,
    layer: str,
    name: str,
    how: str = "table",
    partition_by: tuple[str, ...] = (),
    bucket_by: tuple[str, ...] = (),
    buckets: int = 0,
    at: str | None = None,
) -> DataFrame:
    """Materialise a model and return a reader of it.

    ``table`` writes it (which also cuts the plan behind it), ``view`` registers
    the plan under the layer's name in this session, ``inline`` does neither.

    Tables that are joined on a key again and again are worth bucketing by it:
    rows are shuffled once, when written, and sorted, so that joins of two such
    tables with the same number of ``buckets`` shuffle nothing. Choose it so that
    a bucket of the largest table fits a task. ``at`` puts the files in a folder of
    one's own; the warehouse decides otherwise.
    """
    spark: SparkSession = df.sparkSession
    if how == "inline":
        return df
    if how == "view":
        view = f"{database_for(layer)}__{name}"
        df.createOrReplaceTempView(view)
        return spark.table(view)
    if how != "table":
        raise ValueError(f"unknown materialisation {how!r}")
    create_layers(spark, [layer])
    if bucket_by and buckets < 1:
        raise ValueError("give the number of buckets")
    if bucket_by:
        # By the key first: else every task would write a file for every bucket.
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.mode("overwrite").format("parquet")
    if at:
        writer = writer.option("path", at)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(full_name(layer, name))
    return spark.table(full_name(layer, name))


def publish_view(spark: SparkSession, layer: str, name: str, query: str) -> DataFrame:
    """A lasting view of the layer's database, written in SQL; it may use other layers' tables and
    views by name and the functions of the database, but nothing temporary."""
    create_layers(spark, [layer])
    spark.sql(f"CREATE OR REPLACE VIEW {full_name(layer, name)} AS {query}")
    return spark.table(full_name(layer, name))


def ensure_table(sample: DataFrame, layer: str, name: str, at: str | None = None) -> DataFrame:
    """The table, made empty with the sample's columns if it does not exist."""
    spark: SparkSession = sample.sparkSession
    if not spark.catalog.tableExists(f"{database_for(layer)}.{name}"):
        return publish(spark.createDataFrame([], sample.schema), layer, name, at=at)
    return spark.table(full_name(layer, name))


def own_place(spark: SparkSession, layer: str, name: str) -> str:
    """A fresh folder for a table's files, under the shared folder."""
    return scratch_path(spark, f"{database_for(layer)}-{name}")
