"""Near duplicates by SimHash and multi-index hashing.

A fingerprint has one bit per hash bit: 1 where over half the word shingles' XXH64 have it.
Fingerprints link at ``max_distance`` or fewer differing bits. Each is cut into segments; two
that link agree, by the pigeonhole principle, within a small radius in one segment. So every
distinct fingerprint is filed once under the value of each segment, and looks up the Hamming
ball around its own segment values; matches are verified over all bits.

A bucket with more than ``hot_bucket`` fingerprints is not compared pair by pair. Its members
and those that look it up are linked through the points halfway between them: two fingerprints
at ``d`` differing bits share a point at ``d // 2`` from one and the rest from the other, so
linking all around a point to one of them keeps every connection and grows with the members,
not with their pairs.

Only fingerprints, never texts, are shuffled; equal fingerprints are one row before that.

Defined results: a null or blank text has fingerprint zero, linked like any other; a text with
fewer words than a shingle is one shingle of all its words; repeated rows are rows of their own
with one component; a row whose id is null takes part, but is never a component's id unless
all its members' ids are null; other columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from antecede.llm.components import components
from antecede.session import scratch_path

BITS = 64
HOT_BUCKET = 1000
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_PIECE = 1 << 20


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """Words, about a megabyte of text at a time."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + _PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


def simhash(text: str | None, words: int, seed: int = 42) -> int:
    """Fingerprint of one text, as an unsigned integer."""
    votes, total, carried = np.zeros(BITS, np.int64), 0, []
    for piece in _pieces((text or "").encode("utf-8", "surrogatepass").lower()):
        carried += piece
        if len(carried) < words:
            continue
        joined = b" ".join(carried)
        ends = np.cumsum(np.fromiter(map(len, carried), np.int64, len(carried)) + 1) - 1
        starts = np.concatenate(([0], ends[: -words] + 1)).tolist()
        digest = xxhash.xxh64_digest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)]
        for k in range(0, len(hashes), 1 << 16):
            some = np.frombuffer(b"".join(hashes[k : k + (1 << 16)]), np.uint8).reshape(-1, 8)
            votes += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
        total += len(hashes)
        carried = carried[len(carried) - words + 1 :] if words > 1 else []
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(carried), seed) if carried else 0
    return int.from_bytes(np.packbits(2 * votes > total).tobytes(), "big")


def fingerprint(text: Column, words: int = 4) -> Column:
    """SimHash of a text column as a 64-bit integer (two's complement)."""

    @pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, words) for t in texts], np.uint64).view(np.int64))

    return prints(text)


def as_hex(print_: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(print_)), BITS // 4, "0")


def _ball(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def segments(max_distance: int, count: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment searched. With ``d = count * q + a`` differing
    bits, one of the first ``a + 1`` segments has at most ``q`` of them or another at most
    ``q - 1``."""
    q, a = divmod(max_distance, count)
    cut, at = [], 0
    for i in range(count):
        width = BITS // count + (i < BITS % count)
        cut.append((at, width, q if i <= a else q - 1))
        at += width
    return [s for s in cut if s[2] >= 0]


def _filed(prints: DataFrame, cut: list[tuple[int, int, int]], balls: bool) -> DataFrame:
    """(key, fp) of each segment; with ``balls``, of each point around its value."""
    keys = []
    for i, (shift, width, radius) in enumerate(cut):
        own = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        own = own.bitwiseOR(F.lit(i << 48))
        keys += [own.bitwiseXOR(F.lit(m)) for m in (_ball(width, radius) if balls else [0])]
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _hot_links(hot: DataFrame, max_distance: int) -> DataFrame:
    """Links that connect whatever lies within ``max_distance``, through points halfway."""
    near, far = max_distance // 2, max_distance - max_distance // 2
    masks = np.array(_ball(BITS, far), np.uint64).view(np.int64)  # 2,081 of them for 4 bits
    points = hot.select("fp", F.explode(F.lit(masks)).alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("point"), "fp", (F.bit_count("mask") <= near).alias("core")
    )
    heads = points.where("core").groupBy("point").agg(F.min("fp").alias("head"))
    return points.join(heads, "point").where("fp <> head").select(F.col("head").alias("u"), F.col("fp").alias("v")).distinct()


def links(prints: DataFrame, max_distance: int = 4, segment_count: int = 3, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Links ``u``, ``v`` between distinct fingerprints (column ``fp``, one row each) that
    connect exactly what lies within ``max_distance`` of each other, directly or in steps.
    Outside hot buckets these are all pairs that link."""
    cut = segments(max_distance, segment_count)
    table, probes = _filed(prints, cut, False), _filed(prints, cut, True)
    at = scratch_path(prints.sparkSession, "hot-buckets")
    table.groupBy("key").count().where(F.col("count") > hot_bucket).select("key").write.parquet(at)
    hot_keys = prints.sparkSession.read.parquet(at)
    hot = not hot_keys.isEmpty()
    if hot:
        members = probes.join(hot_keys, "key", "left_semi").select("fp").distinct()
        table, probes = (x.join(hot_keys, "key", "left_anti") for x in (table, probes))
    other = table.select("key", F.col("fp").alias("v"))
    found = (
        probes.join(
            other,
            (probes["key"] == other["key"])
            & (F.col("fp") < F.col("v"))
            & (F.bit_count(F.col("fp").bitwiseXOR(F.col("v"))) <= max_distance),
        )
        .select(F.col("fp").alias("u"), "v")
        .distinct()
    )
    return found.unionByName(_hot_links(members, max_distance)) if hot else found


def _linked(
    docs: DataFrame, id_col: str, text_col: str, words: int, max_distance: int, segment_count: int, hot_bucket: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``id``, ``fp`` of every row; ``fp``, ``head`` (its smallest id), ``n`` of every fingerprint; and
    ``fp``, ``head``, ``root`` (the component's own fingerprint) of those that have a link."""
    spark = docs.sparkSession
    at = scratch_path(spark, "fingerprints")
    docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), words).alias("fp")).write.parquet(at)
    each = spark.read.parquet(at)
    heads_at = scratch_path(spark, "distinct-fingerprints")
    each.groupBy("fp").agg(F.min("id").alias("head"), F.count("*").alias("n")).write.parquet(heads_at)
    heads = spark.read.parquet(heads_at)
    roots = components(links(heads.select("fp"), max_distance, segment_count, hot_bucket))
    return each, heads, heads.join(roots, heads["fp"] == roots["node"]).select("fp", "head", "root")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    max_distance: int = 4,
    segment_count: int = 3,
    hot_bucket: int = HOT_BUCKET,
) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (hex) and ``component_id``, the smallest id
    reachable over links. ``segment_count`` trades lookups for bucket size and never changes the
    result: 3 makes 46 lookups of 21 bits, for up to some hundred million documents; 2 makes
    562 of 32 bits."""
    spark = docs.sparkSession
    each, heads, linked = _linked(docs, id_col, text_col, words, max_distance, segment_count, hot_bucket)
    least = linked.groupBy("root").agg(F.min("head").alias("component"))
    linked = linked.join(least, "root").select("fp", "component")
    # Only fingerprints with a link or a copy need a look-up; the rest are their own component.
    copies = heads.where("n > 1").join(linked, "fp", "left_anti").select("fp", F.col("head").alias("component"))
    classes_at = scratch_path(spark, "classes")
    linked.unionByName(copies).write.parquet(classes_at)
    classes = spark.read.parquet(classes_at)
    return each.join(classes, "fp", "left").select(
        F.col("id").alias(id_col), as_hex(F.col("fp")).alias("fingerprint"), F.coalesce("component", "id").alias("component_id")
    )


def first_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    max_distance: int = 4,
    segment_count: int = 3,
    hot_bucket: int = HOT_BUCKET,
) -> DataFrame:
    """One row of each component of ``near_duplicates``: that with the smallest id, null after all
    others (of several rows with it, that of least fingerprint; of equal ones, one)."""
    spark = docs.sparkSession
    _, heads, linked = _linked(docs, id_col, text_col, words, max_distance, segment_count, hot_bucket)
    least = linked.groupBy("root").agg(F.min(F.struct(F.col("head").isNull().alias("unnamed"), "head", "fp")).alias("least"))
    alone = heads.join(linked, "fp", "left_anti").select("head", "fp")
    # A fingerprint is in one component only, an id need not be: rows are told apart by both.
    chosen_at = scratch_path(spark, "survivors")
    least.select("least.head", "least.fp").unionByName(alone).write.parquet(chosen_at)
    chosen = spark.read.parquet(chosen_at)
    printed = docs.withColumn("__fp", fingerprint(F.col(text_col), words))
    same = printed[id_col].eqNullSafe(chosen["head"]) & (printed["__fp"] == chosen["fp"])
    return printed.join(chosen, same, "left_semi").dropDuplicates([id_col, "__fp"]).drop("__fp")
