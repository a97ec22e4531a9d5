"""Connected components of a link table, by alternating large and small stars.

Every round rewrites the links so that nodes point at the smallest neighbour they know. Both
halves are one aggregation by node and one equi-join, so a hub with any number of links is a
partial aggregate and a join that adaptive execution can split. The rounds grow with the
logarithm of the longest chain; each is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from antecede.session import scratch_path


def _fingerprint_of(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .where("u <> v")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``links`` has columns ``u`` and ``v`` of one ordered type. Returns ``node`` and
    ``root`` (the smallest node reachable) for every node that has a link to another."""
    spark = links.sparkSession
    at = scratch_path(spark, "links")
    links.select("u", "v").where("u <> v").distinct().write.parquet(at)
    now, before = spark.read.parquet(at), None
    while (seen := _fingerprint_of(now)) != before and seen[0]:
        before = seen
        at = scratch_path(spark, "links")
        _small_star(_large_star(now)).write.parquet(at)
        now = spark.read.parquet(at)
    return (
        now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    )
