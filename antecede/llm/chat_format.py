"""Conversations as template text with a loss mask, assembled column by column.

Rows are dealt out by ranges of (conversation, turn), so a conversation of any size is spread over
as many tasks as its rows need. In a task the texts of a slice of rows are one byte array: lengths
of all segments give the offsets of all turns, control strings found in the texts give one inserted
byte each, and headers, contents and endings are scattered into one buffer, allocated once, which
becomes the Arrow column. A conversation leaves as one piece, unless a task's range or a slice of
``SLICE_BYTES`` cuts it; its pieces are in order by (``part``, ``seq``).

A turn is ``open content close``, by role. Inside contents (and names of roles without a template)
a control string gets a backslash after its first character, and one that has some already gets one
more; so none occurs in an escaped text, and taking one away gives the text back.

``read_back`` parses formatted pieces again. Conversations of one piece are finished where they
lie; those that were cut are put together in order, one after the other, as a stream: a digest
is a chain over all bytes, so this part of a single conversation is one task's, in bounded memory.

Defined results: null texts and roles are empty; turns of one conversation are ordered by turn
(null first), then role and the text's hash; repeated rows are turns of their own; rows with a
null conversation are one conversation; an empty table gives an empty result; other columns do not
take part. No turn is left out for its length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20
_ESCAPE = b"\\"
_ROLES = {"system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>\n")}


@dataclass(frozen=True)
class Template:
    """``roles``: opening and closing of each known role; ``other``: what comes before and after
    the name of any other role, and its closing; ``controls``: strings with a meaning; ``loss``:
    roles whose contents are under the loss mask."""

    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: dict(_ROLES))
    other: tuple[str, str, str] = ("<|name|>", "<|/name|>", "<|end|>\n")
    controls: tuple[str, ...] = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<|name|>", "<|/name|>", "<|end|>")
    loss: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        marks = [m for pair in self.roles.values() for m in pair] + list(self.other)
        for mark in marks:
            if not any(c in mark for c in self.controls):
                raise ValueError(f"{mark!r} has no control string")
            for c in self.controls:
                # A control string must not come about where a text and a mark meet.
                for k in range(1, len(c)):
                    if mark.startswith(c[k:]) or mark.endswith(c[:k]) or (k + len(mark) < len(c) and mark in c[1:-1]):
                        raise ValueError(f"{mark!r} can complete {c!r}")
        if any(len(c) < 2 or "\\" in c for c in self.controls):
            raise ValueError("a control string has two characters at least and no backslash")
        for c in self.controls:
            for other in self.controls:
                if any(k + (c != other) and (c[k:].startswith(other) or other.startswith(c[k:])) for k in range(len(c))):
                    raise ValueError(f"{other!r} can begin in {c!r}")
        opened = [a for a, _ in self.roles.values()] + [self.other[0]]
        if any(a != b and a.startswith(b) for a in opened for b in opened) or len(set(opened)) < len(opened):
            raise ValueError("two roles open alike")

    @cached_property
    def found(self) -> re.Pattern[bytes]:
        """A control string, escaped or not, at every place (also inside of others)."""
        rest = b"|".join(re.escape(c[:1].encode()) + rb"\\*" + re.escape(c[1:].encode()) for c in self.controls)
        return re.compile(b"(?=(" + rest + b"))")

    @cached_property
    def _escaped(self) -> re.Pattern[str]:
        rest = "|".join(rf"(?<={re.escape(c[0])})\\(?=\\*{re.escape(c[1:])})" for c in self.controls)
        return re.compile(rest)

    @cached_property
    def _turn(self) -> re.Pattern[str]:
        known = [f"{re.escape(a)}(.*?){re.escape(b)}" for a, b in self.roles.values()]
        start, middle, close = map(re.escape, self.other)
        return re.compile("|".join([*known, f"{start}(.*?){middle}(.*?){close}"]), re.DOTALL)

    def escape(self, text: str) -> str:
        raw = text.encode("utf-8", "surrogatepass")
        at = [m.start() + 1 for m in self.found.finditer(raw)]
        return _ESCAPE.join(raw[a:b] for a, b in zip([0, *at], [*at, len(raw)], strict=True)).decode("utf-8", "surrogatepass")

    def unescape(self, text: str) -> str:
        return self._escaped.sub("", text)

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Roles and contents, as they were."""
        names, at = list(self.roles), 0
        for m in self._turn.finditer(formatted):
            if m.start() != at:
                raise ValueError(f"no turn begins at {at}")
            at, k = m.end(), m.lastindex
            if k <= len(names):
                yield names[k - 1], self.unescape(m.group(k))
            else:
                yield self.unescape(m.group(k - 1)), self.unescape(m.group(k))
        if at != len(formatted):
            raise ValueError(f"no turn begins at {at}")

    def marks(self, role: str) -> tuple[bytes, bytes]:
        a, b = self.roles.get(role) or (self.other[0] + self.escape(role) + self.other[1], self.other[2])
        return a.encode("utf-8", "surrogatepass"), b.encode("utf-8", "surrogatepass")


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its values."""
    column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def assemble(template: Template, roles: list[str], texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray]:
    """One buffer with all turns one after the other; where each begins (one more at the end); and
    begin and end of each content in it, all in bytes."""
    data, offsets = _bytes_of(texts)
    lengths = np.diff(offsets)
    # Bytes to insert: one in every control string that lies in one text.
    hits = np.array([(m.start(), m.end(1)) for m in template.found.finditer(data.tobytes())], np.int64).reshape(-1, 2)
    row = np.searchsorted(offsets, hits[:, 0], "right") - 1
    inside = hits[:, 1] <= offsets[row + 1]
    after, row = hits[inside, 0] + 1, row[inside]
    inserted = np.bincount(row, minlength=len(lengths))
    names = sorted(set(roles))
    marks = [template.marks(r) for r in names]
    of = np.searchsorted(np.array(names, object), np.array(roles, object)) if roles else np.zeros(0, np.int64)
    head, tail = (np.array([len(m[k]) for m in marks], np.int64)[of] for k in (0, 1))
    body = lengths + inserted
    ends = np.cumsum(head + body + tail)
    starts = ends - head - body - tail
    begin = starts + head
    buffer = pa.allocate_buffer(int(ends[-1]) if len(ends) else 0)
    out = np.frombuffer(buffer, np.uint8)
    # Where every byte of the texts goes: its row's place, and the bytes inserted before it.
    shift = np.repeat(begin - offsets[:-1] - np.cumsum(inserted) + inserted, lengths)
    bump = np.zeros(len(data) + 1, np.int64)
    np.add.at(bump, after, 1)
    target = np.arange(len(data)) + shift + np.cumsum(bump)[: len(data)]
    out[target] = data
    out[after + (begin - offsets[:-1])[row] + (np.arange(len(after)) - (np.cumsum(inserted) - inserted)[row])] = _ESCAPE[0]
    for k, (a, b) in enumerate(marks):
        rows = np.flatnonzero(of == k)
        out[starts[rows][:, None] + np.arange(len(a))] = np.frombuffer(a, np.uint8)
        out[(begin + body)[rows][:, None] + np.arange(len(b))] = np.frombuffer(b, np.uint8)
    return buffer, np.append(starts, ends[-1:] if len(ends) else 0), np.stack([begin, begin + body])


def _pieces(template: Template, rows: pa.Table) -> tuple[pa.Array, ...]:
    """Number of turns, text and loss spans of each conversation in some rows, and the row at which
    each begins."""
    ids = rows["conv"].combine_chunks()
    same = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.append(True, same[1:] != same[:-1]))
    roles = rows["role"].fill_null("").to_pylist()
    buffer, at, spans = assemble(template, roles, rows["text"].combine_chunks())
    out = np.frombuffer(buffer, np.uint8)
    chars = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))
    edges = np.append(first, len(roles))
    texts = pa.StringArray.from_buffers(len(first), pa.py_buffer(at[edges].astype(np.int32)), buffer)
    scored = np.isin(np.array(roles, object), np.array(template.loss, object))
    base = np.repeat(chars[at[first]], np.diff(edges))[scored]
    begin, end = (chars[s[scored]] - base for s in spans)
    counts = np.concatenate(([0], np.cumsum(scored)))[edges]
    span = pa.StructArray.from_arrays([pa.array(begin, pa.int64()), pa.array(end, pa.int64())], ["start", "end"])
    loss = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), span)
    return first, pa.array(np.diff(edges)), texts, loss


def format_conversations(
    rows: DataFrame,
    template: Template | None = None,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per piece of a conversation: its id, ``part`` and ``seq`` (pieces of a conversation
    in order), ``whole`` (true if this is surely all of it), ``n_turns``, ``formatted`` and
    ``loss``, spans of code points of ``formatted``."""
    template = template or Template()
    id_type = rows.schema[id_col].dataType.simpleString()
    chosen = rows.select(
        F.col(id_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"),
        F.xxhash64(text_col).alias("mark"),
        F.col(text_col).alias("text"),
    )
    keys = ["conv", "turn", "role", "mark"]
    dealt = chosen.repartitionByRange(*keys).sortWithinPartitions(*keys, "text").select("conv", "role", "text")

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, begun, opened = TaskContext.get().partitionId(), 0, None, False, False

        def emit(table: pa.Table, last_goes_on: bool) -> pa.RecordBatch:
            """``opened``: the first conversation has a piece already; ``begun``: some have left."""
            nonlocal seq, begun, opened
            first, turns, texts, loss = _pieces(template, table)
            n = len(first)
            whole = np.ones(n, bool)
            whole[0] = begun and not opened
            whole[-1] &= not last_goes_on
            batch = pa.RecordBatch.from_arrays(
                [table["conv"].combine_chunks().take(pa.array(first)), pa.array(np.full(n, part), pa.int64()), pa.array(np.arange(seq, seq + n)), pa.array(whole), turns, texts, loss],
                ["conv", "part", "seq", "whole", "n_turns", "formatted", "loss"],
            )
            seq, begun, opened = seq + n, True, last_goes_on
            return batch

        for table in _slices(batches, slice_bytes):
            table = pa.concat_tables([held, table]) if held is not None else table
            # The last conversation may go on: it waits, unless it is large already.
            conv = table["conv"].combine_chunks()
            codes = conv.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            last = int(np.flatnonzero(codes != codes[-1])[-1]) + 1 if (codes != codes[-1]).any() else 0
            if table.slice(last).nbytes > slice_bytes:
                yield emit(table, True)
                held = None
            else:
                if last:
                    yield emit(table.slice(0, last), False)
                held = table.slice(last)
        if held is not None:
            # The range may end within the last conversation.
            yield emit(held, True)

    schema = f"conv {id_type}, part long, seq long, whole boolean, n_turns long, formatted string, loss array<struct<start: long, end: long>>"
    return dealt.mapInArrow(formatted, schema).withColumnRenamed("conv", id_col)


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Rows of about ``most`` bytes of text, one at least."""
    for batch in batches:
        if batch.num_rows:
            sizes = np.diff(_bytes_of(batch["text"])[1]) + 64
            lot = (np.cumsum(sizes) - sizes) // most
            cut = np.append(np.flatnonzero(np.diff(lot, prepend=-1)), batch.num_rows)
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                yield pa.Table.from_batches([batch.slice(a, b - a)])


@dataclass
class _Digest:
    """What is read back of a conversation so far."""

    n_turns: int = 0
    loss_chars: int = 0
    formatted_chars: int = 0

    def __post_init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, n_turns: int, loss_chars: int, formatted_chars: int, turns: bytes, loss: bytes) -> None:
        self.n_turns += n_turns
        self.loss_chars += loss_chars
        self.formatted_chars += formatted_chars
        self.turns.update(turns)
        self.loss.update(loss)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


_READ = {"n_turns": "long", "turns_sha256": "string", "loss_chars": "long", "loss_sha256": "string", "formatted_chars": "long"}


def _parsed(template: Template, formatted: str, loss: list[dict]) -> tuple[int, int, int, bytes, bytes]:
    turns = list(template.turns(formatted))
    scored = "".join(template.unescape(formatted[s["start"] : s["end"]]) for s in loss)
    listed = "".join(f"{role}\n{text}\n" for role, text in turns)
    return len(turns), len(scored), len(formatted), listed.encode("utf-8", "surrogatepass"), scored.encode("utf-8", "surrogatepass")


def read_back(pieces: DataFrame, template: Template | None = None, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation, read from ``formatted`` and ``loss``: ``n_turns``, a digest of
    roles and texts as they were, number of code points and digest of what is under the mask, and
    ``formatted_chars``."""
    template = template or Template()
    id_type = pieces.schema[id_col].dataType.simpleString()
    names = ["conv", "part", "seq", *_READ, "turns", "loss"]

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for whole, text, loss in zip(*(batch[c].to_pylist() for c in ("whole", "formatted", "loss")), strict=True):
                found = _parsed(template, text, loss)
                digest = _Digest()
                if whole:
                    digest.add(*found)
                    out.append((*digest.row(), None, None))
                else:
                    out.append((found[0], None, found[1], None, found[2], found[3], found[4]))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)] if out else [pa.array([], t) for t in _TYPES]
            yield pa.RecordBatch.from_arrays([batch["conv"], batch["part"], batch["seq"], *columns], names)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None

        def rows(found: list[tuple]) -> pa.RecordBatch:
            ids, values = zip(*found, strict=True)
            columns = [pa.array(c, t) for c, t in zip(zip(*values, strict=True), _TYPES[:5], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(ids, id_arrow), *columns], ["conv", *_READ])

        id_arrow = None
        for batch in batches:
            id_arrow, done = batch["conv"].type, []
            for k, conv in enumerate(batch["conv"].to_pylist()):
                n, turns_hash, loss_chars, loss_hash, chars, turns, loss = (batch[c][k].as_py() for c in names[3:])
                if digest is not None and conv != current:
                    done.append((current, digest.row()))
                    digest = None
                if turns is None:
                    done.append((conv, (n, turns_hash, loss_chars, loss_hash, chars)))
                else:
                    current, digest = conv, digest or _Digest()
                    digest.add(n, loss_chars, chars, turns, loss)
            if done:
                yield rows(done)
        if digest is not None:
            yield rows([(current, digest.row())])

    fields = ", ".join(f"{n} {t}" for n, t in _READ.items())
    each = pieces.withColumnRenamed(id_col, "conv").mapInArrow(parsed, f"conv {id_type}, part long, seq long, {fields}, turns binary, loss binary")
    ordered = each.repartition("conv").sortWithinPartitions("conv", "part", "seq")
    return ordered.mapInArrow(merged, f"conv {id_type}, {fields}").withColumnRenamed("conv", id_col)


_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
