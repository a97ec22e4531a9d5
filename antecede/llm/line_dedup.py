"""Incremental, reversible line dedup.

A line's key is the line without ASCII white space at both ends and with A-Z lower-cased, held
as its 128-bit hash. ``LineStore`` keeps how many documents contain each key as an append-only
table of changes by shard: adding documents appends +1 for each of their distinct keys, removing
them appends -1, so a removal leaves what never adding them would have left. Each shard has a
cuckoo filter of the keys present. A batch asks it first: a key it does not know is new for
certain, and only the others are looked up in the exact table.

Dropping lines asks cuckoo filters of the frequent keys in the same way: they are sent to the
tasks that read the documents while their size is below ``FILTER_BYTES``, and the few keys they
let through are held against the exact table. Beyond that size every key is joined; the result
is the same.

Defined results: a null or empty text is one empty line, whose key is too short to count; every
row is a document, also when ids repeat or are null; other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from antecede.llm.cuckoo import CuckooFilter, Full
from antecede.session import scratch_path

SHARDS = 64
SHARD_KEYS = 4_000_000
FILTER_BYTES = 64 << 20
_NO_KEY = b""


def line_key(line: str, min_chars: int = 1) -> bytes:
    """128-bit key of a line; empty for one too short to count."""
    bare = line.encode("utf-8", "surrogatepass").strip().lower()
    short = len(bare) < min_chars or min_chars > 1 and len(bare.decode("utf-8", "surrogatepass")) < min_chars
    return _NO_KEY if short else xxhash.xxh3_128_digest(bare)


def _keys(text: str | None, min_chars: int) -> list[bytes]:
    return [line_key(x, min_chars) for x in (text or "").split("\n")]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), ">u8").reshape(-1, 2)[:, 0].astype(np.uint64)


def document_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int = 1) -> DataFrame:
    """One row per document and distinct key: ``id``, ``key``."""

    @pandas_udf("array<binary>")
    def distinct(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: list(set(_keys(t, min_chars)) - {_NO_KEY}))

    return docs.select(F.col(id_col).alias("id"), F.explode(distinct(F.col(text_col))).alias("key"))


def _shard(key: str, shards: int):
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def _filter_shards(keys: DataFrame, room: float = 1.0) -> DataFrame:
    """One cuckoo filter (``shard``, ``filter``, ``n``) of the rows of each shard."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.build(np.unique(_hashes(part["key"].tolist())), room)
        return pd.DataFrame({"shard": [part["shard"].iloc[0]], "filter": [made.dumps()], "n": [len(part)]})

    return keys.select("shard", "key").groupBy("shard").applyInPandas(build, "shard int, filter binary, n long")


class LineStore:
    """Exact counts of documents per line key, and a cuckoo filter of the present keys for each
    shard, in a folder all executors reach. ``shards`` bounds what one task holds: choose it so
    that a shard has some millions of keys."""

    def __init__(self, spark: SparkSession, path: str | None = None, shards: int = SHARDS, min_chars: int = 1):
        self.spark, self.shards, self.min_chars = spark, shards, min_chars
        self.path = path or scratch_path(spark, "line-store")
        self._changes: list[str] = []
        self._filters: str | None = None

    def counts(self) -> DataFrame:
        """``shard``, ``key``, ``refs`` of every key that some document has."""
        if not self._changes:
            return self.spark.createDataFrame([], "shard int, key binary, refs long")
        changes = self.spark.read.parquet(*self._changes)
        if len(self._changes) > 1:
            changes = changes.groupBy("shard", "key").agg(F.sum("refs").alias("refs"))
        return changes.where("refs > 0")

    def frequent(self, min_docs: int) -> DataFrame:
        return self.counts().where(F.col("refs") >= min_docs)

    def filters(self) -> DataFrame:
        if self._filters is None:
            return self.spark.createDataFrame([], "shard int, filter binary, n long")
        return self.spark.read.parquet(self._filters)

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        self._apply(docs, id_col, text_col, 1)

    def remove(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Take back documents that were added, with the texts they had."""
        self._apply(docs, id_col, text_col, -1)

    def add_keys(self, pairs: DataFrame) -> None:
        """As ``add``, from rows of ``document_keys``."""
        self._change(pairs, 1)

    def _apply(self, docs: DataFrame, id_col: str, text_col: str, sign: int) -> None:
        self._change(document_keys(docs, id_col, text_col, self.min_chars), sign)

    def _change(self, pairs: DataFrame, sign: int) -> None:
        at = f"{self.path}/changes-{len(self._changes)}"
        delta = pairs.groupBy("key").agg((F.count("*") * sign).alias("refs"))
        delta.select(_shard("key", self.shards).alias("shard"), "key", "refs").write.parquet(at)
        batch = self.spark.read.parquet(at)
        if self._filters is None:
            made = _filter_shards(batch)
        else:
            before = self.counts()
            self._changes.append(at)
            made = self._refilter(batch, before, sign)
            self._changes.pop()
        self._changes.append(at)
        to = f"{self.path}/filters-{len(self._changes)}"
        made.write.parquet(to)
        self._filters = to

    def _refilter(self, batch: DataFrame, before: DataFrame, sign: int) -> DataFrame:
        """The filters after a batch: new keys inserted, keys no document has any more deleted."""
        if sign < 0:
            edits = batch.join(self.counts(), ["shard", "key"], "left_anti")
        else:
            asked = self._known(batch)
            edits = asked.where("not maybe").unionByName(
                asked.where("maybe").join(before, ["shard", "key"], "left_anti")
            )
        edits = edits.select("shard", "key")
        # A filter that is full is built anew from the exact keys of its shard.
        edited = f"{self.path}/edited-{len(self._changes)}"
        _edited(self.filters(), edits, sign).write.parquet(edited)
        done = self.spark.read.parquet(edited)
        full = done.where("filter is null").select("shard")
        if full.isEmpty():
            return done
        rebuilt = _filter_shards(self.counts().join(full, "shard", "left_semi"), room=2.0)
        return done.where("filter is not null").unionByName(rebuilt)

    def _known(self, batch: DataFrame) -> DataFrame:
        """``batch`` with ``maybe``: false where the shard's filter rules the key out."""

        def ask(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            out = keys[["shard", "key"]].copy()
            known = len(filters) and len(keys)
            out["maybe"] = CuckooFilter.loads(filters["filter"].iloc[0]).contains(_hashes(keys["key"].tolist())) if known else False
            return out

        return (
            batch.select("shard", "key").groupBy("shard").cogroup(self.filters().groupBy("shard"))
            .applyInPandas(ask, "shard int, key binary, maybe boolean")
        )


def _edited(filters: DataFrame, edits: DataFrame, sign: int) -> DataFrame:
    def edit(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        shard = int((old if len(old) else keys)["shard"].iloc[0])
        n = (int(old["n"].iloc[0]) if len(old) else 0) + sign * len(keys)
        hashes = np.unique(_hashes(keys["key"].tolist())) if len(keys) else np.zeros(0, np.uint64)
        try:
            if not len(old):
                data = CuckooFilter.build(hashes).dumps()
            else:
                now = CuckooFilter.loads(old["filter"].iloc[0])
                (now.insert if sign > 0 else now.delete)(hashes)
                data = now.dumps()
        except Full:
            data = None
        return pd.DataFrame({"shard": [shard], "filter": [data], "n": [n]})

    return filters.groupBy("shard").cogroup(edits.groupBy("shard")).applyInPandas(edit, "shard int, filter binary, n long")


def _let_through(pairs: DataFrame, frequent: DataFrame, shards: int) -> DataFrame:
    """Rows of ``pairs`` whose key may be frequent, if the filters are small enough to send."""
    at = scratch_path(pairs.sparkSession, "frequent-filters")
    _filter_shards(frequent).write.parquet(at)
    filters = pairs.sparkSession.read.parquet(at)
    size = filters.agg(F.sum(F.length("filter"))).first()[0] or 0
    if size > FILTER_BYTES:
        return pairs
    held = {r["shard"]: r["filter"] for r in filters.collect()}  # at most FILTER_BYTES
    sent = pairs.sparkSession.sparkContext.broadcast(held)

    # Of key and shard alone: an id column with nulls would come back from pandas as floats.
    @pandas_udf("boolean")
    def maybe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        loaded = {k: CuckooFilter.loads(v) for k, v in sent.value.items()}
        for keys, of in batches:
            keep, hashes = np.zeros(len(keys), bool), _hashes(keys.tolist())
            for shard, known in loaded.items():
                rows = np.flatnonzero(of.to_numpy() == shard)
                keep[rows] = known.contains(hashes[rows])
            yield pd.Series(keep)

    return pairs.where(maybe("key", _shard("key", shards)))


def drop_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """``docs`` with the lines gone whose key at least ``min_docs`` documents have, and columns
    ``__lines`` and ``__dropped`` (numbers of lines before, and dropped). The other columns stay.
    Without ``shards`` there are so many that none has more than about ``SHARD_KEYS`` keys."""
    spark = docs.sparkSession
    pairs_at = scratch_path(spark, "line-keys")
    document_keys(docs, id_col, text_col, min_chars).write.parquet(pairs_at)
    pairs = spark.read.parquet(pairs_at)
    shards = shards or max(SHARDS, -(-pairs.count() // SHARD_KEYS))  # from the footers
    store = LineStore(spark, shards=shards, min_chars=min_chars)
    store.add_keys(pairs)
    frequent_at = scratch_path(spark, "frequent-lines")
    store.frequent(min_docs).write.parquet(frequent_at)
    frequent = spark.read.parquet(frequent_at)
    hits = _let_through(pairs, frequent, shards).join(frequent.select("key"), "key", "left_semi")
    drops = hits.groupBy("id").agg(F.collect_set("key").alias("__keys"))

    @pandas_udf("struct<text string, lines long, dropped long>")
    def cut(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
        out = []
        for text, gone in zip(texts, keys, strict=True):
            lines = (text or "").split("\n")
            kept = lines
            if gone is not None and len(gone):
                gone = set(gone)
                kept = [x for x in lines if line_key(x, min_chars) not in gone]
            out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["text", "lines", "dropped"])

    joined = docs.join(drops, docs[id_col].eqNullSafe(drops["id"]), "left")
    return joined.withColumn("__cut", cut(F.col(text_col), F.col("__keys"))).select(
        *[F.col("__cut.text").alias(c) if c == text_col else docs[c] for c in docs.columns],
        F.col("__cut.lines").alias("__lines"),
        F.col("__cut.dropped").alias("__dropped"),
    )


def sha256_hex(text: str | None) -> str:
    return hashlib.sha256((text or "").encode("utf-8", "surrogatepass")).hexdigest()
