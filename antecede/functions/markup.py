"""Pieces of HTML as column expressions.

Tags are found by name and class: in either letter case, with either kind of quote,
and a class as one among several. Comments, scripts and styles are taken out first
(:func:`clean`). All of it runs inside Catalyst.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from html.entities import html5
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

_REFERENCE = r"&(?:#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]*);"
# Only the names are matched in either case: a search for a plain "<" is much faster.
_UNSEEN = r"(?s)<(?:!--.*?-->|(?i:(script|style))\b.*?</(?i:\1)\s*>)"
_MAY_HIDE = r"<(?:!--|(?i:script|style))"
_MARK = "\x01"
_BREAK = "\x02"
_SHELVES = 1024

ANY_TAG = r"<[^>]*>"


def clean(html: Column) -> Column:
    """A page without what a reader never sees."""
    return F.when(html.rlike(_MAY_HIDE), F.regexp_replace(html, _UNSEEN, "")).otherwise(html)


@lru_cache(1)
def _names() -> str:
    """All names with their characters, put on shelves by a hash of the name."""
    shelves = [_MARK] * _SHELVES
    for known, value in html5.items():
        if known.endswith(";"):
            shelves[crc32(known[:-1].encode()) % _SHELVES] += f"{known}{value}{_MARK}"
    return _BREAK.join(shelves)


def _named(name: Column) -> Column:
    """The character of a name; NULL for unknown ones. All names are one literal, which keeps the plan
    small; it is cut into shelves once, and a name is searched for on its own shelf alone."""
    shelf = F.get(F.split(F.lit(_names()), _BREAK), F.crc32(F.encode(name, "UTF-8")) % _SHELVES)
    spelled = F.concat(F.lit(_MARK), name, F.lit(";"))
    after = F.call_function("substring_index", shelf, spelled, F.lit(-1))
    found = F.when(F.contains(shelf, spelled), F.substring_index(after, _MARK, 1))
    return F.when(name == "amp", "&").when(name == "lt", "<").when(name == "gt", ">").otherwise(found)


def _numbered(point: Column) -> Column:
    """A character by number. As browsers do, 128 to 159 are read as Windows-1252
    and what is no character becomes the replacement character."""
    western = F.lit(bytes(range(128, 160)).decode("cp1252", "replace"))
    wrong = (point == 0) | point.between(0xD800, 0xDFFF) | (point > 0x10FFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(F.when(wrong, 0xFFFD).otherwise(point)), 8, "0")), "UTF-32")
    western = F.when(point.between(128, 159), F.substr(western, (point - 127).cast("int"), F.lit(1)))
    return F.when(point.between(1, 127), F.chr(point)).otherwise(F.coalesce(western, plain))


def _referred(reference: Column) -> Column:
    name = F.substr(reference, F.lit(2), F.length(reference) - 2)

    def character(name: Column) -> Column:
        hexed = F.conv(F.substr(name, F.lit(3)), 16, 10).cast("bigint")
        decimal = F.substr(name, F.lit(2)).try_cast("bigint")
        number = F.when(F.lower(F.left(name, F.lit(2))) == "#x", hexed).otherwise(decimal)
        return F.when(F.startswith(name, F.lit("#")), each(number, _numbered)).otherwise(_named(name))

    return F.coalesce(each(name, character), reference)


def each(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def unescape(c: Column) -> Column:
    """Character references -> characters, all of them in one pass; unknown ones stay."""

    def read(c: Column) -> Column:
        found = F.regexp_extract_all(c, F.lit(_REFERENCE), 0)
        between = F.split(c, _REFERENCE, -1)
        both = F.zip_with(between, found, lambda gap, ref: F.concat(gap, F.when(ref.isNull(), "").otherwise(_referred(ref))))
        return F.when(F.contains(c, F.lit("&")), F.array_join(both, "")).otherwise(c)

    return each(c, read)


def _value(wanted: str, token: bool) -> str:
    """A pattern for an attribute's value: the whole of it, or one among several words."""
    exact = rf"(?-i:{re.escape(wanted)})"
    if not token:
        return rf"""(?:"{exact}"|'{exact}')"""
    return (
        rf"""(?:"(?:[^"]*?\s)??{exact}(?:\s[^"]*)?"|'(?:[^']*?\s)??{exact}(?:\s[^']*)?'|{exact}(?=[\s>]))"""
    )


def opening(tag: str, **attributes: str) -> str:
    """A pattern for an opening tag with these attributes (``class_`` for ``class``).
    A single class may be one among several; two together must be the whole value."""
    ahead = "".join(
        rf"(?=[^>]*?\s{name.rstrip('_')}\s*=\s*{_value(value, name == 'class_' and ' ' not in value)})"
        for name, value in attributes.items()
    )
    return rf"<(?i:{tag}\b{ahead}[^>]*>)"


def _until_closed(tag: str) -> str:
    """A pattern for all up to the next closing tag, read from tag to tag and never tried again."""
    return rf"(?:[^<]++|<(?!/(?i:{tag})\s*>))*+"


def inside(tag: str, **attributes: str) -> str:
    """A pattern capturing what is between such a tag and the next closing one."""
    return rf"{opening(tag, **attributes)}({_until_closed(tag)})</(?i:{tag})\s*>"


def table() -> str:
    """A pattern capturing what is in a table; a cell may hold a table of its own."""
    rest = r"(?:[^<]++|<(?!/?table\b))*+"
    return rf"(?is)<table\b[^>]*>((?:[^<]++|<(?!/?table\b)|<table\b[^>]*+>{rest}</table\s*+>)*+)</table"


def whole(tag: str, **attributes: str) -> str:
    """As :func:`inside`, capturing the tags too."""
    return rf"({opening(tag, **attributes)}{_until_closed(tag)}</(?i:{tag})\s*>)"


def all_of(c: Column, pattern: str) -> Column:
    """First group of every match, as an array."""
    return F.regexp_extract_all(c, F.lit(pattern), 1)


def first_of(c: Column, pattern: str) -> Column:
    """First group of the first match; '' when there is none."""
    return F.regexp_extract(c, pattern, 1)


def attribute(c: Column, name: str) -> Column:
    """The value of an attribute in the first tag that has it; '' if none."""
    return unescape(F.regexp_extract(c, rf"""(?is)<[^>]*\s{name}\s*=\s*(["'])(.*?)\1""", 2))


def text(c: Column) -> Column:
    """Text with tags removed and the ends trimmed; inner white space stays."""
    return _strip(unescape(F.regexp_replace(c, ANY_TAG, "")))


def joined_text(c: Column) -> Column:
    """Text with every piece between tags trimmed and the pieces joined."""
    return _strip(unescape(F.regexp_replace(c, rf"\s*{ANY_TAG}\s*", "")))


def joined_texts(array: Column) -> Column:
    """:func:`joined_text` of every entry. In steps, so that each works on a
    value already computed."""
    bare = F.transform(array, lambda x: F.regexp_replace(x, rf"\s*{ANY_TAG}\s*", ""))
    return F.transform(F.transform(bare, unescape), _strip)


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\n\r\f"))


def lines(c: Column) -> Column:
    """The non-empty trimmed lines of an element's text, as an array."""
    return F.filter(F.transform(F.split(text(c), "\n"), _strip), lambda line: line != "")


def canonical_link(c: Column) -> Column:
    """``http://host/...`` -> ``http://www.host/...``; safe to repeat."""
    return F.regexp_replace(c, r"^http://(?!www\.)", "http://www.")
