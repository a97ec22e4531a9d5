"""Byte-level BPE encoding and decoding.

Texts are cut into matches of the split pattern, and each task takes the distinct ones ("words")
of a block of documents. A fold of Spark's higher-order functions encodes every distinct word
once: its state is the array of token ids, at first one for each byte, and the ranks of all
neighbouring pairs; a step merges the leftmost pair of least rank and looks up the two pairs
that the merge makes. (The ids are kept as bytes of one width in a binary value, whose parts Spark
takes and joins much faster than those of arrays.) Ranks come from one binary literal, a hash table in
which a pair of ids has two possible seats, so that a look-up does not scan the vocabulary and a task
is sent one array of bytes rather than a map for each bucket. The ids of the words are then laid out
again in the order of the texts. No text is shuffled.

Words that are frequent in a sample of the texts (at most ``FREQUENT`` of them, from a quarter of the
text or ``SAMPLE_CHARS``, whichever is less) are folded beforehand, once, and sent to the tasks, so
that a block folds only what is not among them. What the sample holds changes no id.

What is a letter or a number is asked of the library whose pattern it is, for every code point, once
on the driver.

Decoding concatenates the bytes of the ids.

Words of more than ``LONG_WORD`` bytes are merged over a heap before the fold, which takes a number
of steps proportional to the square of the length; the fold then finds nothing left to merge.

Defined results: a null or empty text has no ids; every row is encoded on its own, whatever its
id; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from antecede.llm.tokens import span_hashes
from antecede.session import written

BLOCK_CHARS = 4 << 20
PIECE_CHARS = 1 << 19
LONG_WORD = 64
SAMPLE_CHARS = 200_000_000
FREQUENT = 600_000
_AT_ONCE = 1 << 15
_OTHER, _LETTER, _NUMBER, _SPACE, _END = range(5)
_END_POINT = 0x110000
#: The contractions the split pattern names.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a line has a token in base64 and its rank. The path is one the
    driver can open."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of each code point, as the split pattern tells them apart."""
    import tiktoken

    table = np.full(_END_POINT + 1, _OTHER, np.uint8)
    one_byte = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        # What matches comes back byte by byte, what does not is left out.
        probe = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=one_byte, special_tokens={})
        for first in range(0, _END_POINT, 1 << 14):
            some = "".join(chr(c) for c in range(first, first + (1 << 14)) if not 0xD800 <= c < 0xE000)
            table[[ord(c) for c in bytes(probe.encode_ordinary(some)).decode()]] = kind
    table[_END_POINT] = _END
    return table


def split_points(points: np.ndarray, classes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pattern's matches in an array of code points, in which texts are
    separated by ``0x110000``."""
    kind = (_classes() if classes is None else classes)[points]
    n = len(points)
    edge = np.ones(n + 1, bool)
    edge[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == _END)
    run = np.flatnonzero(edge)  # run starts, and n
    start, end, of = run[:-1], run[1:], kind[run[:-1]]
    # White space before something else: its last character stands alone, or joins if it is a blank.
    follows = np.append(of[1:], _END)
    gap = (of == _SPACE) & (follows != _END)
    last = end[gap] - 1
    edge[last] = True
    edge[end[gap][points[last] == 0x20]] = False
    # A lone apostrophe at the start of a match takes a contraction's letters.
    quote = np.flatnonzero((of == _OTHER) & (follows == _LETTER) & (end - start == 1))
    quote = quote[(points[start[quote]] == 0x27) & edge[start[quote]]]
    if len(quote):
        at, limit = start[quote] + 1, end[quote + 1]
        one = points[at]
        two = np.where(at + 1 < limit, points[np.minimum(at + 1, n - 1)], 0)
        length = np.zeros(len(quote), np.int64)
        for letters in CONTRACTIONS:
            hit = one == ord(letters[0])
            length[hit & (two == ord(letters[1])) if len(letters) == 2 else hit] = len(letters)
        at, limit, length = (x[length > 0] for x in (at, limit, length))
        edge[at] = False
        rest = at + length
        edge[rest[rest < limit]] = True
    cut = np.flatnonzero(edge)
    start, end = cut[:-1], cut[1:]
    real = kind[start] != _END
    return start[real], end[real]


def _pieces(text: str) -> Iterator[str]:
    """A long text in pieces no match spans: a match begins at a single blank between others."""
    while len(text) > PIECE_CHARS:
        at = PIECE_CHARS
        while (at := text.find(" ", at)) > 0 and (text[at - 1].isspace() or text[at + 1 : at + 2].isspace() or at + 1 == len(text)):
            at += 1
        if at < 0:
            break
        yield text[:at]
        text = text[at:]
    yield text


def _points(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """Texts one after the other, each with one character more; their code points, ``_END_POINT`` after
    each; where each ends."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    points[ends] = _END_POINT
    return joined, points, ends


def _distinct(texts: list[str], classes: np.ndarray) -> Iterator[str]:
    """The words of texts, told apart by hash: of two with one hash only one is given."""
    joined, points, _ = _points(texts)
    start, end = split_points(points, classes)
    _, first = np.unique(span_hashes(points, start, end), return_index=True)
    return (joined[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True))


def _merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word over a heap of pairs: always the leftmost pair of least rank."""
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[word[i : i + 2]], i, i + 1, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, a, b, stop = heapq.heappop(heap)
        if not alive[a] or after[a] != b or b >= n or not alive[b] or end[b] != stop:
            continue
        end[a], after[a], alive[b] = stop, after[b], False
        if after[a] < n:
            before[after[a]] = a
        for x, y in ((before[a], a), (a, after[a])):
            if x >= 0 and y < n and (rank := ranks.get(word[x : end[y]])) is not None:
                heapq.heappush(heap, (rank, x, y, end[y]))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def _width(ranks: dict[bytes, int]) -> int:
    """Hex digits of an id; the greatest value stays free for the padding."""
    return 4 if max(ranks.values()) < (1 << 16) - 1 else 8


def _pair_ranks(ranks: dict[bytes, int]) -> dict[bytes, bytes]:
    """The id that two ids make together, by the pair."""
    size = _width(ranks) // 2
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                pairs[a.to_bytes(size) + b.to_bytes(size)] = rank.to_bytes(size)
    return pairs


def _pair_table(pairs: dict[bytes, bytes], size: int) -> bytes:
    """A hash table of a power of two of seats: a pair, its id and as many bytes again. A pair sits where
    its hash says or where the upper half of its hash says, but there only if the first seat is taken by
    another; empty seats hold paddings."""
    hashes = {pair: xxhash.xxh64_intdigest(pair, 42) for pair in pairs}
    entry, seats = 4 * size, 1 << (4 * len(pairs)).bit_length()
    while (seated := _seated(hashes, entry, seats)) is None:
        seats *= 2
    table = bytearray(b"\xff" * (entry * seats))
    for at, pair in seated.items():
        table[at : at + 3 * size] = pair + pairs[pair]
    return bytes(table)


def _seated(hashes: dict[bytes, int], entry: int, seats: int) -> dict[int, bytes] | None:
    """Which pair sits at which byte; none if there is no room for one."""
    mask, taken = entry * (seats - 1), {}
    for pair in hashes:
        at = hashes[pair] & mask
        for _ in range(500):
            pair, taken[at] = taken.get(at), pair
            if pair is None:
                break
            one, two = hashes[pair] & mask, hashes[pair] >> 32 & mask
            at = two if at == one else one
        else:
            return None
    return taken


def merge_fold(word: Column, table: Column, size: int) -> Column:
    """The ids of a word. ``word`` is its bytes' ids, each as ``size`` bytes, between two paddings
    of ``ff``; so is the result. ``table`` is the literal of ``_pair_table``."""
    entry, empty = 4 * size, F.lit(b"\xff" * 2 * size)

    def part(of: Column, at: Column, length: int) -> Column:
        return F.substr(of, at, F.lit(length))

    def rank(pair: Column) -> Column:  # null: no such token
        def seat(place: Column) -> Column:
            return part(table, place.bitwiseAND(F.length(table) - entry).cast("int") + 1, entry)

        key = F.xxhash64(pair)
        one, two = seat(key), seat(F.shiftrightunsigned(key, 32))
        first, value = F.lit(1), F.lit(2 * size + 1)
        # Most pairs are no token, and most of those have an empty first seat.
        elsewhere = (part(one, first, 2 * size) != empty) & (part(two, first, 2 * size) == pair)
        return F.when(part(one, first, 2 * size) == pair, part(one, value, size)).when(elsewhere, part(two, value, size))

    def state(ids: Column, ranks: Column) -> Column:
        return F.struct(ids.alias("ids"), ranks.alias("ranks"))

    def bound(value: Column, use) -> Column:  # computed once, however often it is used
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def step(now: Column, _: Column) -> Column:
        ids, ranks = now["ids"], now["ranks"]

        def merge(least: Column, at: Column) -> Column:
            # ranks[at] is of the pair of the ids at - 1 and at, counting from 0 with the padding.
            left, right = part(ids, (at - 2) * size + 1, size), part(ids, (at + 1) * size + 1, size)
            around = F.transform(F.array(F.concat(left, least), F.concat(least, right)), rank)
            before, after = F.substr(ids, F.lit(1), (at - 1) * size), F.substr(ids, (at + 1) * size + 1, F.length(ids))
            new_ranks = F.concat(F.slice(ranks, F.lit(1), at - 2), around, F.slice(ranks, at + 2, F.size(ranks)))
            return state(F.concat(before, least, after), new_ranks)

        def merged(least: Column) -> Column:
            place = F.array_position(ranks, least).cast("int")
            return F.when(least.isNull(), now).otherwise(bound(place, lambda at: merge(least, at)))

        return bound(F.array_min(ranks), merged)

    def fold(first: Column) -> Column:
        steps = F.when(
            F.array_min(first["ranks"]).isNotNull(), F.sequence(F.lit(3), F.size(first["ranks"]))
        ).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, first, step, lambda done: done["ids"])

    # The first and the last pair have a padding.
    starts = F.sequence(F.lit(size + 1), F.length(word) - 3 * size + 1, F.lit(size))
    none = F.array(F.lit(None).cast("binary"))
    pairs = F.concat(none, F.transform(F.transform(starts, lambda at: part(word, at, 2 * size)), rank), none)
    return F.when(F.length(word) < 4 * size, word).otherwise(bound(state(word, pairs), fold))


@dataclass(frozen=True)
class Known:
    """Words whose ids are known: their hashes, rising, and the code points and ids of each. Every worker
    holds a copy, so numbers are kept in as few bytes as they need."""

    hashes: np.ndarray
    points: np.ndarray
    point_ends: np.ndarray
    ids: np.ndarray
    id_ends: np.ndarray

    @classmethod
    def of(cls, words: pa.Array, spelled: pa.Array, width: int) -> Known:
        """``spelled``: ids as hex digits of this width, between two paddings."""
        data = b"".join(_data(words))
        points = np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(length)
        hashes = np.zeros(len(length), np.uint64)
        for a in range(0, len(length), _AT_ONCE):
            some = slice(a, a + _AT_ONCE)
            base = ends[a] - length[a]
            hashes[some] = span_hashes(points[base : ends[some][-1]], (ends - length)[some] - base, ends[some] - base)
        by = np.argsort(hashes)
        flat = np.frombuffer(bytes.fromhex(b"".join(_data(spelled)).decode()), f">u{width // 2}").astype(np.int32)
        sizes = pc.binary_length(spelled).to_numpy(zero_copy_only=False).astype(np.int64) // width
        first = np.cumsum(sizes) - sizes + 1  # after the padding
        texts, spellings = _gathered(points, (ends - length)[by], length[by]), _gathered(flat, first[by], (sizes - 2)[by])
        return cls(hashes[by], *map(_narrow, texts + spellings))

    @classmethod
    def none(cls, width: int) -> Known:
        return cls.of(pa.array([], pa.string()), pa.array([], pa.string()), width)

    def spelling(self) -> Known:
        """The ids alone, for those who look up no word."""
        return Known(self.hashes[:0], self.points[:0], self.point_ends[:0], self.ids, self.id_ends)

    def places(self, hashes: np.ndarray, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which known word each of some is, -1 for others; compared in full, not by hash alone."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        mine, length = at[hit], (end - start)[hit]
        before = np.concatenate(([0], self.point_ends))[mine]
        if (self.point_ends[mine] - before != length).any():
            raise ValueError("two words have one hash")  # one chance in 2**64 a pair
        run = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        if (self.points[np.repeat(before, length) + run] != points[np.repeat(start[hit], length) + run]).any():
            raise ValueError("two words have one hash")
        out = np.full(len(hashes), -1)
        out[hit] = mine
        return out


def _data(strings: pa.Array) -> list[bytes]:
    """The bytes of a string array, one after the other."""
    bounds = np.frombuffer(strings.buffers()[1] or bytes(4), np.int32)[strings.offset : strings.offset + len(strings) + 1]
    return [memoryview(strings.buffers()[2])[bounds[0] : bounds[-1]]] if len(strings) and strings.buffers()[2] else []


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers, none of them negative, in two or four bytes each if that is enough."""
    most = int(values.max(initial=0))
    return values.astype(np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def _gathered(values: np.ndarray, starts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of ``values`` one after the other, and their ends."""
    out = [values[:0]]
    for a in range(0, len(length), _AT_ONCE):
        begin, n = starts[a : a + _AT_ONCE], length[a : a + _AT_ONCE]
        ends = np.cumsum(n)
        out.append(values[np.repeat(begin - (ends - n), n) + np.arange(n.sum())])
    return np.concatenate(out), np.cumsum(length)


class _Block:
    """Documents of one block: the distinct words, and each text as positions among them. Those that
    are known already are positions -1, -2, ... of the known ones."""

    def __init__(self, ranks: dict[bytes, int], width: int, known: Known | None = None, classes: np.ndarray | None = None):
        self.ranks, self.width, self.known, self.classes = ranks, width, known or Known.none(width), classes
        self.pad = "f" * width
        self.byte = [f"{ranks[bytes([b])]:0{width}x}" for b in range(256)]
        self.clear()

    def clear(self) -> None:
        self.ids, self.counts, self.index, self.words, self.chars = [], [], [], [], 0
        self.place: dict[int, int] = {}

    def _spelled(self, word: str) -> str:
        data, width = word.encode("utf-8", "surrogatepass"), self.width
        if (whole := self.ranks.get(data)) is not None:
            ids = f"{whole:0{width}x}"
        elif len(data) > LONG_WORD:
            ids = "".join(f"{x:0{width}x}" for x in _merged(data, self.ranks))
        else:
            ids = "".join([self.byte[b] for b in data])
        return self.pad + ids + self.pad

    def add(self, ids: list, texts: list[str | None]) -> None:
        """Take in texts of some megabytes together."""
        pieces = [(k, p) for k, t in enumerate(texts) for p in _pieces(t or "")]
        counts = np.zeros(len(texts), np.int64)
        at = 0
        while at < len(pieces):
            stop, size = at, 0
            while stop < len(pieces) and (stop == at or size + len(pieces[stop][1]) <= PIECE_CHARS):
                size += len(pieces[stop][1])
                stop += 1
            some = pieces[at:stop]
            counts += np.bincount([k for k, _ in some], self._tokens([p for _, p in some]), len(texts)).astype(np.int64)
            at = stop
        self.ids += ids
        self.counts += counts.tolist()
        self.chars += sum(len(p) for _, p in pieces)

    def _tokens(self, texts: list[str]) -> np.ndarray:
        """Appends the positions of the texts' words; how many there are in each text."""
        joined, points, ends = _points(texts)
        start, end = split_points(points, self.classes)
        hashes, first, inverse = np.unique(
            span_hashes(points, start, end), return_index=True, return_inverse=True
        )
        length = end - start
        # Equal hashes must be equal words: compare every word with the first of its hash.
        shift = np.repeat(start[first][inverse] - start, length)
        here = np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
        if (length[first][inverse] != length).any() or (points[here + shift] != points[here]).any():
            raise ValueError("two words have one hash")  # one chance in 2**64 a pair
        places = np.empty(len(hashes), np.int32)
        known = self.known.places(hashes, points, start[first], end[first])
        places[:] = -1 - known
        seen, words = self.place, self.words
        new = np.flatnonzero(known < 0)
        for k, h, f in zip(new.tolist(), hashes[new].tolist(), first[new].tolist(), strict=True):
            if (place := seen.get(h)) is None:
                place = seen[h] = len(words)
                words.append(self._spelled(joined[start[f] : end[f]]))
            places[k] = place
        self.index.append(places[inverse])
        return np.diff(np.searchsorted(start, ends), prepend=0)

    def row(self, kind: pa.DataType) -> pa.RecordBatch:
        index = np.concatenate(self.index) if self.index else np.zeros(0, np.int32)
        values = {
            "ids": pa.array([self.ids], pa.list_(kind)),
            "counts": pa.array([self.counts], pa.list_(pa.int64())),
            "index": _one_list(index),
            "words": pa.ListArray.from_arrays(pa.array([0, len(self.words)], pa.int32()), _bytes_of(self.words)),
        }
        self.clear()
        return pa.RecordBatch.from_pydict(values)


def _bytes_of(words: list[str]) -> pa.Array:
    """Hex digits as binary values."""
    ends = np.cumsum([0] + [len(w) // 2 for w in words], dtype=np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(bytes.fromhex("".join(words)))]
    )


def _one_list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _laid_out(batch: pa.RecordBatch, width: int, known: Known) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """Documents of the blocks in a batch, some at a time, and their ids."""
    known_ends = known.id_ends.astype(np.int64)
    known_sizes = np.diff(known_ends, prepend=0)
    for k in range(batch.num_rows):
        row = {name: batch.column(name)[k] for name in batch.schema.names}
        words = row["words"].values
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) // (width // 2)
        flat = np.frombuffer(b"".join(_data(words)), f">u{width // 2}").astype(np.int32)
        begin = np.cumsum(sizes) - sizes + 1  # after the padding
        begin, sizes = np.append(begin, len(flat) + known_ends - known_sizes), np.append(sizes - 2, known_sizes)
        flat = np.append(flat, known.ids.astype(np.int32))
        index = row["index"].values.to_numpy(zero_copy_only=False)
        index = np.where(index < 0, len(words) - 1 - index, index)
        counts = row["counts"].values.to_numpy(zero_copy_only=False)
        ids = row["ids"].values
        for at, stop, i, j in _some_documents(counts):
            some = index[i:j]
            n = sizes[some]
            each = np.cumsum(n)
            total = int(each[-1]) if len(each) else 0
            out = flat[np.repeat(begin[some] - (each - n), n) + np.arange(total)]
            bounds = np.concatenate(([0], each))[np.concatenate(([0], np.cumsum(counts[at:stop])))]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(out, pa.int32()))
            yield ids[at:stop], lists


def _some_documents(counts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of documents and of their words, some hundred thousand words each."""
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + (1 << 18), "right")))
        yield at, stop, before, int(ends[stop - 1])
        at = stop


def _rank_maps(ranks: dict[bytes, int]) -> Column:
    """The literal of ``_pair_table``."""
    return F.lit(_pair_table(_pair_ranks(ranks), _width(ranks) // 2))


def frequent_words(source: DataFrame, ranks: dict[bytes, int], maps: Column, sample_chars: int, most: int) -> Known:
    """Words met in most blocks of a sample of ``source.text``, at most ``most``, and their ids. A
    text too small for that gives none."""
    spark, width = source.sparkSession, _width(ranks)
    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    if chars < 8 * BLOCK_CHARS:
        return Known.none(width)
    sent = spark.sparkContext.broadcast((ranks, _classes()))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, classes, size = set(), sent.value[1], 0
        held, waiting = [], 0

        def out() -> pa.RecordBatch:
            block = _Block(sent.value[0], width)
            kept = [w for w in words if w.encode("utf-8", "surrogatepass") not in block.ranks and len(w) <= LONG_WORD // 4]
            return pa.RecordBatch.from_pydict({"word": pa.array(kept, pa.string()), "spelled": pa.array([block._spelled(w) for w in kept], pa.string())})

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for piece in _pieces(text or ""):
                    held.append(piece)
                    waiting += len(piece)
                    size += len(piece)
                    if waiting >= PIECE_CHARS or size >= BLOCK_CHARS:
                        words.update(_distinct(held, classes))
                        held, waiting = [], 0
                    if size >= BLOCK_CHARS:
                        yield out()
                        words, size = set(), 0
        if held:
            words.update(_distinct(held, classes))
        if words:
            yield out()

    parts = max(4, -(-chars // sample_chars))
    sample = source.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == 0).select("text")
    met = sample.mapInArrow(blocks, "word string, spelled string").groupBy("word", "spelled").agg(F.count(F.lit(1)).alias("n"))
    met = written(met.where("n > 1"), "frequent-words")
    least, total = 2, 0
    for r in met.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).collect():  # a row per number of blocks
        total += r["words"]
        if total > most:
            least = r["n"] + 1
            break
    folded = F.get(F.transform(F.array(maps), lambda m: merge_fold(F.unhex("spelled"), m, width // 2)), F.lit(0))
    table = written(met.where(F.col("n") >= least).select("word", F.hex(folded).alias("ids")), "frequent-ids").toArrow()  # ``most`` rows
    return Known.of(*(table[c].combine_chunks().cast(pa.string()) for c in ("word", "ids")), width)


def _coded(docs: DataFrame, ranks: dict[bytes, int], id_col: str, text_col: str) -> tuple[DataFrame, str, int, Broadcast]:
    """A row per block of documents with its distinct words encoded; the ids' type; an id's width;
    the ids of the words known beforehand."""
    spark = docs.sparkSession
    width = _width(ranks)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    maps = _rank_maps(ranks)
    known = frequent_words(source, ranks, maps, SAMPLE_CHARS, FREQUENT)
    sent = spark.sparkContext.broadcast((ranks, _classes()))  # the vocabulary, and a table of code points
    spelling = spark.sparkContext.broadcast(known.spelling())
    known = spark.sparkContext.broadcast(known)  # ``FREQUENT`` words

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, kind = _Block(sent.value[0], width, known.value, sent.value[1]), None
        for batch in batches:
            kind = batch.schema.field("id").type
            ids, texts = batch.column("id").to_pylist(), batch.column("text")
            for k in range(0, len(ids), 1000):
                block.add(ids[k : k + 1000], texts[k : k + 1000].to_pylist())
                if block.chars >= BLOCK_CHARS:
                    yield block.row(kind)
        if block.ids:
            yield block.row(kind)

    folded = F.transform(F.array(maps), lambda m: F.transform("words", lambda w: merge_fold(w, m, width // 2)))
    fields = f"ids array<{id_type}>, counts array<long>, index array<int>, words array<binary>"
    taken = source.mapInArrow(blocks, fields)
    return taken.select("ids", "counts", "index", F.get(folded, F.lit(0)).alias("words")), id_type, width, spelling


def encode(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``ids``, the array of its token ids."""
    coded, id_type, width, known = _coded(docs, ranks, id_col, text_col)

    def laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, lists in _laid_out(batch, width, known.value):
                yield pa.RecordBatch.from_arrays([ids, lists], ["id", "ids"])

    return coded.mapInArrow(laid_out, f"id {id_type}, ids array<int>").select(F.col("id").alias(id_col), "ids")


def joined_pieces(ids: np.ndarray, pieces: dict[int, bytes]) -> bytes:
    return b"".join(map(pieces.__getitem__, ids.tolist()))


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids."""
    pieces = {rank: token for token, rank in ranks.items()}

    @pandas_udf("binary")
    def decoded(arrays: pd.Series) -> pd.Series:
        return arrays.map(lambda x: joined_pieces(x, pieces))

    return decoded(ids)


def digests(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes: number of ids per document, and SHA-256 (hex) of the ids as little-endian
    unsigned 32-bit integers and of the decoded bytes."""
    coded, id_type, width, known = _coded(docs, ranks, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, sha = sent.value, hashlib.sha256
        for batch in batches:
            for ids, lists in _laid_out(batch, width, known.value):
                cut, flat = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
                parts = [flat[a:b] for a, b in zip(cut, cut[1:], strict=False)]
                columns = [
                    ids,
                    pa.array(np.diff(cut).astype(np.int64)),
                    pa.array([sha(x.tobytes()).hexdigest() for x in parts], pa.string()),
                    pa.array([sha(joined_pieces(x, pieces)).hexdigest() for x in parts], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = coded.mapInArrow(digested, f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> dict[bytes, int]:
    """Ranks of one of the installed public vocabularies."""
    import public_tokenizers

    return load_ranks(public_tokenizers.path(name))
