"""Mixing sources to target weights.

Words per source are summed first (partial aggregation: a source with a third of all rows is
one row a task). Targets are found on that table by re-sharing excess until no source is above
its limit; a round is one aggregate of two numbers, whatever the number of sources. A document
then appears ``floor(rate)`` times, and once more if a hash of its id falls below the fraction.

The per-source table is joined by equality; Spark broadcasts it only where it is below
``spark.sql.autoBroadcastJoinThreshold``, and else splits a source that is too large.

Defined results: a null text has no words; null is a source of its own and comes last; a source
without words has target and rate 0; rows with equal ids draw alike; a null id draws as a value
of its own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from antecede.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
_PARTS = 64


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space."""
    # A word starts where a non-space follows a space or the beginning: count those places.
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("-"))


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources with ``place``, counted from 0 by code point, null last, without one task for all."""
    spark = sources.sparkSession
    at = scratch_path(spark, "sources")
    order = [F.col("source").asc_nulls_last()]
    (
        sources.repartitionByRange(_PARTS, *order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("row", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
        .write.parquet(at)
    )
    ranged = spark.read.parquet(at)
    per_part = ranged.groupBy("part").agg(F.count("*").alias("n"))  # at most _PARTS rows
    before = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return ranged.join(F.broadcast(before), "part").withColumn("place", F.col("before") + F.col("row") - 1)


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, limit: float = 2.0
) -> DataFrame:
    """``sizes`` has ``source`` and ``size`` per document. Returns ``source``, ``source_size``
    and ``target``: ``share`` of all words dealt out by weight (taken in turn), no source getting
    more than ``limit`` times its own; excess is dealt out again among the others."""
    spark = sizes.sparkSession
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    at = scratch_path(spark, "source-sizes")
    _numbered(per_source).select(
        "source",
        "source_size",
        F.get(turn, F.pmod("place", F.lit(len(weights))).cast("int")).alias("weight"),
    ).write.parquet(at)
    table = spark.read.parquet(at)
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    cap = F.col("source_size") * F.lit(float(limit))
    # The level is what one unit of weight gets. Sources whose limit is below it stop there, which
    # raises the level for the others; it only rises, so this ends when no further source stops.
    level, stopped = 0.0, -1
    while True:
        done = cap <= F.col("weight") * F.lit(level) if stopped >= 0 else F.lit(False)
        n, held, free = table.agg(
            F.coalesce(F.sum(done.cast("long")), F.lit(0)),
            F.coalesce(F.sum(F.when(done, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~done, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == stopped or free == 0:
            break
        level, stopped = max(level, (total - held) / free), n
    target = F.least(cap, F.col("weight") * F.lit(level)) if free or stopped >= 0 else cap
    target = cap if free == 0 else target
    return table.select("source", "source_size", target.alias("target"))


def copies(id_: Column, rate: Column, seed: int = 0) -> Column:
    """``floor(rate)`` and one more with the fraction as its probability, by a hash of the id."""
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(id_.cast("string"), F.lit("null"))), 11)
    uniform = draw.cast("double") / F.lit(float(1 << 53))
    return (F.floor(rate) + (uniform < rate - F.floor(rate)).cast("long")).cast("long")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    limit: float = 2.0,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` with ``__size``, ``__source_size``, ``__target`` and ``__copies``."""
    key = _source_key(F.col(source_col))
    sized = docs.withColumn("__size", word_count(F.col(text_col)))
    targets = source_targets(
        sized.select(F.col(source_col).alias("source"), F.col("__size").alias("size")), weights, share, limit
    ).select(
        _source_key(F.col("source")).alias("__key"),
        F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"),
    )
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(F.lit(0.0))
    return (
        sized.withColumn("__key", key)
        .join(targets, "__key")
        .withColumn("__copies", copies(F.col(id_col), rate, seed))
        .drop("__key")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with its own columns only."""
    own = [c for c in mixed.columns if c not in ("__size", "__source_size", "__target", "__copies")]
    return mixed.where("__copies > 0").select(
        *own, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("__copy")
    ).drop("__copy")
