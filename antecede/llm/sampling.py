"""Document fingerprints by consistent weighted sampling.

A document is a bag of terms: its words (runs of anything but ASCII white space, A-Z
lower-cased), weighted by how often they occur. For every slot and term, two gamma(2, 1) draws ``r`` and ``c`` and a uniform ``b``, all functions of the term
and the slot alone, give ``t = floor(ln w / r + b)`` and ``ln a = ln c - r * (t - b) - r``; the
slot's sample is the term with the least ``a``, with its ``t``. Two documents agree in a slot with
probability equal to their generalised Jaccard similarity (sum of least over sum of greatest
weights), so the share of equal slots estimates it.

The draws are hashes, computed where they are needed: nothing is fitted, gathered or sent. A
task keeps those of the terms it met first, up to a fixed number.

Defined results: a null text is empty; a text without words has the fingerprint of all zeros,
and two such are alike (1.0); equal texts have equal fingerprints; repeated rows are rows of
their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from antecede.llm.tokens import mixed, word_hashes

SLOTS = 64
CACHED_TERMS = 1 << 17
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 12
_TEXTS = 64


def _uniforms(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two uniforms in (0, 1) from the halves of each hash."""
    high, low = (keys >> np.uint64(32)).astype(np.uint32), keys.astype(np.uint32)
    scale = np.float32(2.0**-32)
    least = np.float32(2.0**-33)
    return high.astype(np.float32) * scale + least, low.astype(np.float32) * scale + least


def draws(terms: np.ndarray, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``r``, ``ln c`` and ``b`` for each term hash and slot."""
    with np.errstate(over="ignore"):
        base = terms[:, None] + np.arange(1, slots + 1, dtype=np.uint64)[None, :] * _GOLDEN
        first, second, third = (mixed(base ^ np.uint64(s)) for s in (0, 0x5851F42D4C957F2D, 0x14057B7EF767814F))
    u1, u2 = _uniforms(first)
    v1, v2 = _uniforms(second)
    b, _ = _uniforms(third)
    return -np.log(u1 * u2), np.log(-np.log(v1 * v2)), b


def samples(terms: np.ndarray, weights: np.ndarray, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """For each weighted term and slot: ``ln a``, and a 32-bit value of the sample (term and ``t``).
    The value at the least of a column is that slot's sample."""
    r, lnc, b = draws(terms, slots)
    t = np.floor(np.log(weights.astype(np.float32))[:, None] / r + b)
    with np.errstate(over="ignore"):
        drawn = mixed(terms[:, None] + t.astype(np.int64).astype(np.uint64) * _GOLDEN)
    return lnc - r * (t - b) - r, (drawn >> np.uint64(32)).astype(np.uint32)


class Sampler:
    """Signatures of texts; keeps the samples of up to ``CACHED_TERMS`` weighted terms."""

    def __init__(self, slots: int = SLOTS):
        self.slots = slots
        self.keys = np.zeros(0, np.uint64)  # sorted; of the terms kept
        self.rows = np.zeros(0, np.int64)
        self.size = 0
        self.order = np.empty((0, slots), np.float32)
        self.drawn = np.empty((0, slots), np.uint32)

    def _located(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The row of each weighted term; those beyond the kept ones lie behind them until the
        next call."""
        keys = mixed(terms + weights.astype(np.uint64) * _GOLDEN)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        found = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        new, first, inverse = np.unique(keys[~found], return_index=True, return_inverse=True)
        lone = np.flatnonzero(~found)[first]
        need = self.size + len(new)
        if need > len(self.order):
            for name in ("order", "drawn"):
                old = getattr(self, name)
                more = np.empty((2 * need, self.slots), old.dtype)
                more[: self.size] = old[: self.size]
                setattr(self, name, more)
        for k in range(0, len(new), _CHUNK):
            some = lone[k : k + _CHUNK]
            at_row = slice(self.size + k, self.size + k + len(some))
            self.order[at_row], self.drawn[at_row] = samples(terms[some], weights[some], self.slots)
        rows = np.empty(len(keys), np.int64)
        rows[found] = self.rows[at[found]] if len(self.keys) else 0
        rows[~found] = self.size + inverse
        if (room := min(CACHED_TERMS - self.size, len(new))) > 0:
            both = np.concatenate((self.keys, new[:room]))
            sort = np.argsort(both, kind="stable")
            self.keys = both[sort]
            self.rows = np.concatenate((self.rows, np.arange(self.size, self.size + room)))[sort]
            self.size += room
        return rows

    def of_texts(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text: its signature, one 32-bit value a slot."""
        hashes, first = word_hashes(texts)
        out = np.zeros((len(texts), self.slots), np.uint32)
        bags = [np.unique(hashes[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:], strict=True)]
        rows = self._located(np.concatenate([t for t, _ in bags]), np.concatenate([n for _, n in bags]))
        slot, at = np.arange(self.slots), 0
        for k, (terms, _) in enumerate(bags):
            if len(terms):
                own = rows[at : at + len(terms)]
                order = self.order.take(own, axis=0)
                out[k] = self.drawn[own[(order == order.min(0)).argmax(0)], slot]
                at += len(terms)
        return out


def signature_hex(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def signature(text: Column, slots: int = SLOTS) -> Column:
    """The fingerprint of a text column: 8 hex digits a slot."""

    @pandas_udf("string")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sampler = Sampler(slots)
        for texts in batches:
            held = texts.tolist()
            yield pd.Series([signature_hex(x) for k in range(0, len(held), _TEXTS) for x in sampler.of_texts(held[k : k + _TEXTS])])

    return made(text)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal slots of two fingerprints: an estimate of generalised Jaccard similarity."""
    slots = F.length(a) / 8
    equal = F.aggregate(
        F.sequence(F.lit(0), (slots - 1).cast("int")),
        F.lit(0),
        lambda n, i: n + (F.substr(a, i * 8 + 1, F.lit(8)) == F.substr(b, i * 8 + 1, F.lit(8))).cast("int"),
    )
    return equal / slots


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _parts(docs: DataFrame, id_col: str, count: int) -> list[int]:
    """Ids that cut the table into about ``count`` even ranges."""
    if count < 2:
        return []
    at = [k / count for k in range(1, count)]
    cuts = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), at, 20 * count)).first()[0]
    return sorted(set(cuts or []))


def edit_likeness(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS, parts: int | None = None
) -> DataFrame:
    """Fingerprints of every text and of its edited form (``edited`` with the next document by
    id; ties by text; null ids first; the first document follows the last), and their likeness:
    ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``. Ids are integers.

    Documents are dealt into ranges of ids; the first of each range also goes to the range
    before, as its last row's successor. That is the one shuffle of the texts."""
    spark = docs.sparkSession
    count = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _parts(docs, id_col, count)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # The range of an id is the number of cuts at or below it.
    place = F.size(F.filter(F.lit(np.array(cuts, np.int64)), lambda c: c <= F.col("id"))) if cuts else F.lit(0)
    dealt = base.withColumn("part", F.when(F.col("id").isNull(), 0).otherwise(place))
    key = F.coalesce("id", F.lit(-(1 << 63)))
    found = sorted(dealt.groupBy("part").agg(F.min(key).alias("first")).collect())  # one row a range
    if not found:
        return _empty(spark)
    wrap = {row["first"]: found[k - 1]["part"] for k, row in enumerate(found)}
    also = F.create_map(*[F.lit(x) for pair in wrap.items() for x in pair])
    follows = F.element_at(also, key)
    # A range's successor is one row; of several with its id, the least text. Sorting finds it.
    rows = dealt.select("id", "text", "part", F.lit(0).alias("role")).unionByName(
        dealt.where(follows.isNotNull())
        .groupBy("id")
        .agg(F.min("text").alias("text"))
        .select("id", "text", follows.alias("part"), F.lit(1).alias("role"))
    )
    laid = rows.repartition(count, "part").sortWithinPartitions("part", "role", F.col("id").asc_nulls_first(), "text")

    # No nulls among the ids in pandas, which would turn them into floats.
    laid = laid.select(key.alias("id"), F.col("id").isNotNull().alias("named"), "text", "part", "role")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler, held = Sampler(slots), None
        for whole in batches:
            for k in range(0, len(whole), _TEXTS):
                batch = whole.iloc[k : k + _TEXTS]
                texts = batch["text"].tolist()
                ids = [i if named else None for i, named in zip(batch["id"].tolist(), batch["named"], strict=True)]
                rows = list(zip(batch["part"], batch["role"], ids, texts, sampler.of_texts(texts), strict=True))
                rows = rows if held is None else [held, *rows]
                pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if a[0] == b[0] and not a[1]]
                changed = [edited(a[3], b[3]) for a, b in pairs]
                held = rows[-1]
                if pairs:
                    found = sampler.of_texts(changed)
                    out = [_compared(a, b, c, f) for (a, b), c, f in zip(pairs, changed, found, strict=True)]
                    yield pd.DataFrame(out, columns=_COLUMNS, dtype=object)

    return laid.mapInPandas(compare, _SCHEMA)


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _empty(spark) -> DataFrame:
    return spark.createDataFrame([], _SCHEMA)


def _compared(mine: tuple, following: tuple, changed: str, other: np.ndarray) -> tuple:
    _, _, id_, text, own = mine
    return (
        id_,
        len(text),
        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        signature_hex(own),
        signature_hex(other),
        float((own == other).mean()),
        float((own == following[4]).mean()),
    )
