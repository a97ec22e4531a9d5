"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's evidence is the sum of weights of binned measures of its own
and of the lines before and after it (shares of kinds of characters, word lengths, repetition,
endings); a weight for each pair of neighbouring labels ties the lines together. Forward-backward
gives each line's probability of being good; their mean, weighted by line length, is the
document's score.

The weights are fitted by gradient ascent on the likelihood of labelled documents, all of whose
lines carry the document's label, over a bounded sample: at most ``MAX_TRAINING`` documents, those
of least hash, of at most ``MAX_TRAINING_LINES`` lines. Only their binned measures reach the driver
(some twenty bytes a line), the weights go back to the tasks, and every whole text is scored there.

Defined results: a null or empty text is one empty line and scored as such; labels that are null
or belong to no document are not used; rows with equal ids are scored each on its own; without
any labelled document every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from antecede.llm.tokens import span_hashes

MAX_TRAINING = 4000
MAX_TRAINING_LINES = 2000
STEPS = 150
THRESHOLD = 0.3
_DOCS, _CHARS = 256, 1 << 20

_SHARES = np.array([0.0, 0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9], np.float32)
_SIZES = np.array([0, 1, 3, 8, 20, 50, 100, 200, 400, 1000], np.float32)
_LENGTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 14], np.float32)
BINS = len(_SHARES) + 1

#: Kinds of bytes whose share of a line is measured.
KINDS = {
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "digit": "0123456789",
    "stop": ".,;:",
    "bang": "!?",
    "symbol": "#$%&*+=@^_~\\",
    "bracket": "()[]{}<>/",
    "bar": "|",
    "quote": "\"'`-",
    "space": " \t\r\x0b\x0c",
    "vowel": "aeiouAEIOU",
}


def _table(chars: str) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[[ord(c) for c in chars]] = 1
    return table


_TABLES = {name: _table(chars) for name, chars in KINDS.items()} | {"wide": np.r_[np.zeros(128), np.ones(128)].astype(np.uint8)}
MEASURES = len(_TABLES) + 10


def line_measures(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binned measures of all lines (one row each), the lines' lengths in bytes, and the number of
    lines in each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 0x0A)
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = (ends - starts).astype(np.int64)
    text_ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    lines = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    least = np.maximum(size, 1).astype(np.float32)

    def within(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate((np.zeros(1, np.int32), np.cumsum(flags, dtype=np.int32)))
        return (sums[ends] - sums[starts]).astype(np.float32)

    out = [np.searchsorted(_SHARES, within(table[data]) / least) for table in _TABLES.values()]
    space = _TABLES["space"][data].astype(bool) | (data == 0x0A)
    edge = np.flatnonzero(np.diff(space, prepend=True))
    first, last = edge[0::2], edge[1::2]  # words
    words = np.diff(np.searchsorted(first, ends), prepend=0)
    some = np.maximum(words, 1).astype(np.float32)
    line_of = np.repeat(np.arange(len(starts)), words)
    before_end = data[np.maximum(last - 1, 0)] if len(last) else np.zeros(0, np.uint8)
    lettered = _TABLES["upper"] + _TABLES["lower"] + _TABLES["digit"] + _TABLES["wide"]
    odd_end = np.bincount(line_of, (lettered + _TABLES["stop"])[before_end] == 0, len(starts))
    capital = np.bincount(line_of, _TABLES["upper"][data[first]], len(starts))
    # Words and lines that came before in the same text.
    doc_of = np.repeat(np.arange(len(texts)), lines)
    hashes = span_hashes(data, first, last)
    again = _seen_before(hashes, doc_of[line_of])
    repeated = np.bincount(line_of, again, len(starts))
    echo = np.zeros(len(hashes), bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (doc_of[line_of][1:] == doc_of[line_of][:-1])
    echoed = np.bincount(line_of, echo, len(starts))
    twin = _seen_before(span_hashes(data, starts, ends), doc_of) & (size > 0)
    final = np.where(size > 0, data[np.maximum(ends - 1, 0)], 0)
    out += [
        np.searchsorted(_SIZES, size),
        np.searchsorted(_SIZES, words),
        np.searchsorted(_LENGTHS, np.bincount(line_of, last - first, len(starts)) / some),
        np.searchsorted(_SHARES, odd_end / some),
        np.searchsorted(_SHARES, capital / some),
        np.searchsorted(_SHARES, repeated / some),
        np.searchsorted(_SHARES, echoed / some),
        twin.astype(np.int64),
        lettered[final] + 2 * _TABLES["stop"][final] + 4 * (size == 0),
        np.searchsorted(_SIZES, np.repeat(lines, lines)),
    ]
    return np.stack(out, 1).astype(np.uint8), size + 1, lines


def _seen_before(values: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """True where a value occurred earlier in its group."""
    order = np.lexsort((values, groups))
    same = (values[order][1:] == values[order][:-1]) & (groups[order][1:] == groups[order][:-1])
    out = np.zeros(len(values), bool)
    out[order[1:]] = same
    return out


@dataclass
class Model:
    """``own``, ``before``, ``after``: weights by measure and bin; ``edge``: of a first and a last
    line; ``pairs``: of neighbouring labels (bad, good)."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    edge: np.ndarray
    pairs: np.ndarray

    @classmethod
    def blank(cls) -> Model:
        return cls(*(np.zeros((MEASURES, BINS + 2)) for _ in range(3)), np.zeros(2), np.zeros((2, 2)))

    def parts(self) -> list[np.ndarray]:
        return [self.own, self.before, self.after, self.edge, self.pairs]


def _edges(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of first and last lines."""
    last = np.cumsum(lines) - 1
    return last - lines + 1, last


def evidence(model: Model, measures: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Log odds of good of each line by its own and its neighbours' measures."""
    at = np.arange(MEASURES)
    first, last = _edges(lines)
    own, before, after = ((w[at, measures]).sum(1) for w in (model.own, model.before, model.after))
    out = own
    out[1:] += before[:-1]
    out[first] += model.edge[0] - np.where(first > 0, before[first - 1], 0)
    out[:-1] += after[1:]
    out[last] += model.edge[1] - np.where(last + 1 < len(after), after[np.minimum(last + 1, len(after) - 1)], 0)
    return out


def marginals(odds: np.ndarray, lines: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of good of each line, expected pairs of neighbouring labels over all texts, and
    each text's log normaliser, by forward-backward over all texts at once."""
    first, _ = _edges(lines)
    order = np.argsort(-lines, kind="stable")
    start, length = first[order], lines[order]
    top = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(top), "left")  # texts longer than t
    step = np.exp(pairs)
    high = np.maximum(odds, 0)
    emit = np.stack([np.exp(-high), np.exp(odds - high)], 1)  # bad, good; the larger is 1
    forward, backward, scale = np.empty_like(emit), np.empty_like(emit), np.empty(len(odds))
    for t in range(top):
        n = active[t]
        rows = start[:n] + t
        a = emit[rows] * (forward[rows - 1] @ step) if t else emit[rows]
        s = a.sum(1)
        scale[rows] = s
        forward[rows] = a / s[:, None]
    expected = np.zeros((2, 2))
    for t in range(top - 1, -1, -1):
        rows = start[: active[t]] + t
        on = active[t + 1] if t + 1 < top else 0
        b = np.ones((len(rows), 2))
        if on:
            following = rows[:on] + 1
            right = emit[following] * backward[following] / scale[following][:, None]
            b[:on] = right @ step.T
            expected += step * (forward[rows[:on]].T @ right)
        backward[rows] = b
    both = forward * backward
    log_z = np.add.reduceat(np.log(scale) + high, first) if len(first) else np.zeros(0)
    return both[:, 1] / both.sum(1), expected, log_z


def fit(measures: np.ndarray, lines: np.ndarray, labels: np.ndarray, steps: int = STEPS, ridge: float = 1e-3) -> Model:
    """Weights of greatest penalised likelihood, by Adam over all texts at once."""
    model = Model.blank()
    if not len(lines):
        return model
    good = np.repeat(labels.astype(np.float64), lines)
    first, last = _edges(lines)
    inner = np.ones(len(good), bool)
    inner[first] = False
    pair_counts = np.zeros((2, 2))
    for label in (0, 1):
        pair_counts[label, label] = (lines[labels == label] - 1).sum()
    flat = (np.arange(MEASURES) * (BINS + 2))[None, :] + measures
    cells = MEASURES * (BINS + 2)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in model.parts()]

    def by_cell(values: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.bincount(of.ravel(), np.repeat(values, MEASURES), cells).reshape(MEASURES, BINS + 2)

    rows = np.flatnonzero(inner)
    for k in range(1, steps + 1):
        p, expected, _ = marginals(evidence(model, measures, lines), lines, model.pairs)
        gap = (good - p) / len(lines)
        grads = [
            by_cell(gap, flat),
            by_cell(gap[rows], flat[rows - 1]),
            by_cell(gap[rows - 1], flat[rows]),
            np.array([gap[first].sum(), gap[last].sum()]),
            (pair_counts - expected) / len(lines),
        ]
        rate = 0.1 * (1 - 0.9 * k / steps)
        for weight, grad, (m, v) in zip(model.parts(), grads, moments, strict=True):
            grad -= ridge * weight
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            weight += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return model


def _lots(texts: list[str | None]) -> Iterator[slice]:
    """Neighbouring texts that are measured together: at most ``_DOCS``, and no more than ``_CHARS``
    characters but for a longer one alone."""
    begin, chars = 0, 0
    for k, text in enumerate(texts):
        size = len(text or "")
        if k > begin and (k - begin == _DOCS or chars + size > _CHARS):
            yield slice(begin, k)
            begin, chars = k, 0
        chars += size
    if begin < len(texts):
        yield slice(begin, len(texts))


def score_texts(model: Model, texts: list[str | None]) -> np.ndarray:
    """Mean probability of good over a text's lines, weighted by their length."""
    measures, size, lines = line_measures(texts)
    p, _, _ = marginals(evidence(model, measures, lines), lines, model.pairs)
    first, _ = _edges(lines)
    return np.add.reduceat(p * size, first) / np.add.reduceat(size, first)


def _held_out(id_: Column, folds: int) -> Column:
    return F.crc32(id_.cast("string").cast("binary")) % folds == 0


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    max_documents: int = MAX_TRAINING,
) -> Model:
    """A model of labelled documents whose id's CRC-32 is no multiple of ``folds``."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & ~_held_out(F.col("id"), folds)
    )
    taken = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_documents)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lot in _lots(batch["text"].tolist()):
                part = batch.iloc[lot]
                rows, _, lines = line_measures(part["text"].tolist())
                cut = np.concatenate(([0], np.cumsum(lines)))
                yield pd.DataFrame(
                    {
                        "id": part["id"].to_numpy(),
                        "label": part["label"].to_numpy(),
                        "lines": lines,
                        "measures": [rows[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)],
                    }
                )

    sample = (
        texts.join(F.broadcast(taken), "id")  # at most max_documents ids
        .mapInPandas(measured, "id long, label int, lines long, measures binary")
        .where(F.col("lines") <= MAX_TRAINING_LINES)
        .toPandas()
        .sort_values(["id", "measures"])
    )
    rows = np.frombuffer(b"".join(sample["measures"]), np.uint8).reshape(-1, MEASURES)
    return fit(rows, sample["lines"].to_numpy(np.int64), sample["label"].to_numpy())


def quality_score(text: Column, model: Model) -> Column:
    """The score, from 0 to 1, of a text column."""

    @pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        held = texts.tolist()
        parts = [score_texts(model, held[lot]) for lot in _lots(held)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return scored(text)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with ``__held_out``, ``__score`` and ``__predicted``."""
    model = train(docs, labels, id_col, text_col, label_col, folds)
    return (
        docs.withColumn("__held_out", F.coalesce(_held_out(F.col(id_col), folds), F.lit(False)))
        .withColumn("__score", quality_score(F.col(text_col), model))
        .withColumn("__predicted", (F.col("__score") >= threshold).cast("int"))
    )
