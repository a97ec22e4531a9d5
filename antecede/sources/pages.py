"""Records from web pages.

Input is a table of pages (``url``, ``html``), one row per page. Each ``parse_*``
returns its records with a ``status``: ``ok``, ``skip`` (the page has nothing to
give) or ``quarantine`` with a ``reason`` (the page is not what it should be). A
bad page never stops the run; :func:`split_status` parts the two.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from antecede.functions import markup as m
from antecede.functions import split_full_name

# The site's markers and class names.
CHALLENGE_MARKER = "Checking your browser"
LISTING_TABLE = "b-statistics__table-events"
BLACK_LINK = "b-link b-link_style_black"
FLAG_TEXT = "b-flag__text"
LEFT_CELL = "b-fight-details__table-col l-page_align_left"
CELL_TEXT = "b-fight-details__table-text"
SUMMARY = "b-fight-details__text"
SUMMARY_FIRST = "b-fight-details__text-item_first"
SUMMARY_ITEM = "b-fight-details__text-item"
METHOD_STYLE = "font-style: normal"
PROFILE_ITEM = "b-list__box-list-item b-list__box-list-item_type_block"
PROFILE_NAME = "b-content__title-highlight"

# The cells of a box score in page order, as stable names.
BOX_SCORE_COLUMNS = tuple(
    f"fighter_{side}_{name}"
    for name in (
        "name",
        "knockdowns",
        "sig_strikes",
        "sig_strike_acc",
        "total_strikes",
        "takedowns",
        "takedown_acc",
        "sub_attempts",
        "reversals",
        "control_time",
    )
    for side in ("a", "b")
)

# Profile labels and the stable names they get.
PROFILE_LABELS = {
    "Height": "height",
    "Weight": "weight",
    "Reach": "reach",
    "STANCE": "stance",
    "DOB": "dob",
    "SLpM": "sig_strikes_landed_per_min",
    "Str. Acc.": "sig_strike_accuracy",
    "SApM": "sig_strikes_absorbed_per_min",
    "Str. Def": "sig_strike_defense",
    "TD Avg.": "takedown_average",
    "TD Acc.": "takedown_accuracy",
    "TD Def.": "takedown_defense",
    "Sub. Avg.": "submission_average",
}

OK, SKIP, QUARANTINE = "ok", "skip", "quarantine"


def drop_interstitials(pages: DataFrame, marker: str = CHALLENGE_MARKER) -> tuple[DataFrame, DataFrame]:
    """(real pages, interstitial pages)."""
    flagged = F.contains("html", F.lit(marker))
    return pages.filter(~flagged), pages.filter(flagged)


def skipped(parsed: DataFrame) -> DataFrame:
    """(url, reason, n): pages that had nothing to give, and how many rows of a page had not."""
    return parsed.filter(F.col("status") == SKIP).groupBy("url", "reason").agg(F.count(F.lit(1)).alias("n"))


def split_status(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine). Skipped pages are in neither."""
    records = parsed.filter(F.col("status") == OK).drop("status", "reason")
    return records, parsed.filter(F.col("status") == QUARANTINE).select("url", "reason")


def _once(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """``keep`` plus ``columns``, each computed once per row.

    Pattern matching over whole pages is the costly part here. In a plain select
    the optimizer may copy such an expression into a filter above it and into
    every column that uses it; what a generator produced it leaves alone.
    """
    made = F.struct(*(column.alias(name) for name, column in columns.items()))
    return df.select(*keep, F.inline(F.array(made)))


def _status(
    rules: Mapping[str, Column], skip: Column | None = None, nothing: Mapping[str, Column] | None = None
) -> dict[str, Column]:
    """status and reason from named failure conditions, first one wins. ``nothing`` names
    conditions under which there is nothing to give, and comes before them."""

    def first(named: Mapping[str, Column]) -> Column:
        reason = F.lit(None).cast("string")
        for name, condition in reversed(named.items()):
            reason = F.when(condition, name).otherwise(reason)
        return reason

    none, reason = first(nothing or {}), first(rules)
    status = F.when(none.isNotNull(), SKIP).when(reason.isNotNull(), QUARANTINE)
    if skip is not None:
        status = status.when(skip, SKIP)
    return {"reason": F.coalesce(none, reason), "status": status.otherwise(OK)}


def _table_rows(pages: DataFrame, table: Column, present: Column) -> DataFrame:
    """Rows with cells of each page's table, and their cells. A page without any keeps one row, that
    has neither ``position`` nor ``cells``; ``present`` says whether the table is there."""
    read = _once(_seen(pages), "url", rows=_rows(table), present=present)
    numbered = F.transform("rows", lambda row, n: F.struct(n.alias("position"), row.alias("row")))
    with_cells = F.filter(numbered, lambda r: r["row"].rlike(r"<(?i:td)\b"))
    each = read.select("url", "present", F.explode_outer(with_cells).alias("r"))
    return _once(each, "url", "present", position=F.col("r.position"), cells=m.all_of(F.col("r.row"), m.inside("td")))


def _no_record() -> dict[str, Column]:
    """Why a row of :func:`_table_rows` gives no record."""
    return {
        "no table": ~F.col("present"),
        "no rows": F.col("position").isNull(),
        "a row of one cell": F.size("cells") < 2,
    }


def _seen(pages: DataFrame) -> DataFrame:
    """The pages without comments, scripts and styles."""
    return _once(pages, "url", html=m.clean(F.col("html")))


def _first_table(html: Column) -> Column:
    return m.first_of(html, m.table())


def _rows(table: Column) -> Column:
    return m.all_of(table, m.whole("tr"))


def parse_listing(pages: DataFrame, table_class: str = LISTING_TABLE) -> DataFrame:
    """Listing page -> one row per table row with at least two cells: name and
    date (two lines of the first cell), location, link. Rows with one cell, and
    pages without the table or without rows, are skipped by name."""
    table = m.first_of(F.col("html"), m.inside("table", class_=table_class))
    cells = _table_rows(pages, table, F.col("html").rlike(m.opening("table", class_=table_class)))
    first = F.get("cells", F.lit(0))
    parsed = _once(
        cells,
        "url",
        "position",
        "present",
        "cells",
        name_and_date=m.lines(first),
        event_location=m.text(F.get("cells", F.lit(1))),
        event_url=m.attribute(first, "href"),
    ).select(
        "url",
        "position",
        F.get("name_and_date", F.lit(0)).alias("event_name"),
        F.get("name_and_date", F.lit(1)).alias("event_date"),
        "event_location",
        "event_url",
        "present",
        "cells",
    )
    rules = {"no date line": F.col("event_date").isNull(), "no link": F.col("event_url") == ""}
    return parsed.withColumns(_status(rules, nothing=_no_record())).drop("present", "cells")


def parse_card(pages: DataFrame) -> DataFrame:
    """Card page -> one row per bout: link, winner, weight class, result.

    Four lists are read down the rows and paired by position. They come from
    different cells, so lists of unequal length mean that pairing them would give
    a bout another bout's winner: the page goes to quarantine.
    """
    found = _once(_seen(pages), "url", rows=_rows(_first_table(F.col("html"))))

    def links(row: Column) -> Column:
        call = F.regexp_extract(row, r"""(?is)^<tr\b[^>]*\sonclick\s*=\s*(["'])(.*?)\1""", 2)
        return F.regexp_extract(m.unescape(call), r"""["']([^"']*)["']""", 1)

    def black(row: Column) -> Column:
        return m.all_of(row, m.inside("a", class_=BLACK_LINK))

    def flag(row: Column) -> Column:
        texts = m.all_of(row, m.inside("i", class_=FLAG_TEXT))
        return F.transform(texts, m.text)

    def winner(row: Column) -> Column:
        name = m.text(F.get(row["black"], F.lit(0)))

        def outcome(result: Column) -> Column:
            return F.struct(F.when(result == "win", name).otherwise(result).alias("winner"), result.alias("result"))

        return m.each(F.get(flag(row["row"]), F.lit(0)), outcome)

    def weight(row: Column) -> Column:
        def second(left: Column) -> Column:
            return F.when(F.size(left) > 1, m.text(m.first_of(F.get(left, F.lit(1)), m.inside("p", class_=CELL_TEXT))))

        return m.each(m.all_of(row, m.inside("td", class_=LEFT_CELL)), second)

    with_black = F.transform("rows", lambda r: F.struct(r.alias("row"), black(r).alias("black")))
    with_winner = F.filter(with_black, lambda r: (F.size(r["black"]) > 0) & ~r["row"].rlike(r"<(?i:th)\b"))
    lists = _once(
        found,
        "url",
        links=F.filter(F.transform("rows", links), lambda x: x != ""),
        outcomes=F.transform(with_winner, winner),
        classes=F.filter(F.transform("rows", weight), lambda x: x.isNotNull()),
    )
    unequal = (F.size("links") != F.size("outcomes")) | (F.size("links") != F.size("classes"))
    no_result = F.exists("outcomes", lambda o: F.coalesce(o["result"], F.lit("")) == "")
    rules = {"lists of unequal length": unequal, "a row without a result": no_result}
    checked = lists.withColumns(_status(rules, skip=F.size("links") == 0))
    zipped = F.when(F.col("status") == OK, F.arrays_zip("links", "outcomes", "classes"))
    return checked.select("url", "status", "reason", F.posexplode_outer(zipped).alias("position", "b")).select(
        "url",
        "position",
        F.col("b.links").alias("bout_url"),
        F.col("b.outcomes.winner").alias("winner_name"),
        F.col("b.classes").alias("weight_class"),
        F.col("b.outcomes.result").alias("result"),
        "status",
        "reason",
    )


def parse_box_score(pages: DataFrame, columns: tuple[str, ...] = BOX_SCORE_COLUMNS) -> DataFrame:
    """Box-score page -> one row: the named cells, both fighters' links, method,
    round and time. More cells than names, or fewer on a page that names two
    fighters: quarantine; no box score at all: skipped."""
    parts = _once(
        _seen(pages),
        "url",
        table=_first_table(F.col("html")),
        summary=m.first_of(F.col("html"), m.inside("p", class_=SUMMARY)),
        has_table=F.col("html").rlike(r"(?i)<table\b"),
    )
    first = m.first_of(F.col("summary"), rf"(?s){m.opening('i', class_=SUMMARY_FIRST)}(.*)")
    # An item is a label in its own tag and the value after it.
    item = rf"(?is){m.opening('i', class_=SUMMARY_ITEM)}\s*<i\b[^>]*>[^<]*</i\s*>([^<]*)</i\s*>"
    anchors = m.all_of(F.col("table"), m.whole("a", class_=BLACK_LINK))
    read = _once(
        parts,
        "url",
        "has_table",
        cells=m.joined_texts(m.all_of(F.col("table"), m.inside("p", class_=CELL_TEXT))),
        links=F.transform(anchors, lambda a: m.canonical_link(m.attribute(a, "href"))),
        method=m.joined_text(m.first_of(first, m.inside("i", style=METHOD_STYLE))),
        items=m.joined_texts(m.all_of(F.col("summary"), item)),
    )
    rules = {
        "no summary": F.col("has_table") & ((F.col("method") == "") | (F.size("items") < 2)),
        "more cells than columns": F.size("cells") > len(columns),
        "fewer cells than columns": (F.size("links") > 1) & (F.size("cells") < len(columns)),
    }
    named = [F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(columns)]
    return read.withColumns(_status(rules, skip=F.size("cells") < len(columns))).select(
        "url",
        *named,
        F.get("links", F.lit(0)).alias("fighter_a_url"),
        F.get("links", F.lit(1)).alias("fighter_b_url"),
        "method",
        F.get("items", F.lit(0)).alias("finish_round"),
        F.get("items", F.lit(1)).alias("finish_time"),
        "status",
        "reason",
    )


def parse_profile(pages: DataFrame, labels: Mapping[str, str] = PROFILE_LABELS) -> DataFrame:
    """Profile page -> one row: name, its two parts and one column per label. A
    blank label is dropped, a label the page lacks is NULL, of a repeated one the
    last counts."""

    def entry(item: Column) -> Column:
        title = F.rtrim(m.joined_text(m.first_of(item, m.inside("i"))), F.lit(":"))
        value = F.replace(m.joined_text(item), F.concat(title, F.lit(":")), F.lit(""))
        return F.struct(title.alias("label"), value.alias("value"))

    items = F.transform(m.all_of(F.col("html"), m.inside("li", class_=PROFILE_ITEM)), entry)
    name = m.joined_text(m.first_of(F.col("html"), m.inside("span", class_=PROFILE_NAME)))
    read = _once(_seen(pages), "url", fighter_name=name, items=F.filter(items, lambda e: e["label"] != ""))

    def labelled(label: str) -> Column:
        return F.try_element_at(F.filter("items", lambda e: e["label"] == label), F.lit(-1))["value"]

    parts = split_full_name("fighter_name")
    return read.select(
        "url",
        "fighter_name",
        parts["first"].alias("first_name"),
        parts["last"].alias("last_name"),
        *(labelled(label).alias(column) for label, column in labels.items()),
        F.to_json(F.map_from_arrays(F.array_distinct("items.label"), _last_values())).alias("profile_json"),
        F.size("items").alias("_labels"),
    ).withColumns(_status({"no label": F.col("_labels") == 0})).drop("_labels")


def _last_values() -> Column:
    """Values in the order of the distinct labels, the last one of each."""
    return F.transform(
        F.array_distinct("items.label"),
        lambda label: F.element_at(F.filter("items", lambda e: e["label"] == label), -1)["value"],
    )


def parse_index(pages: DataFrame) -> DataFrame:
    """Index page -> (first, last, link) per row of the first table with at
    least two cells; others are skipped as in :func:`parse_listing`."""
    cells = _table_rows(pages, _first_table(F.col("html")), F.col("html").rlike(r"<(?i:table)\b"))
    first, second = F.get("cells", F.lit(0)), F.get("cells", F.lit(1))
    parsed = _once(
        cells,
        "url",
        "position",
        "present",
        "cells",
        first_name=m.text(m.first_of(first, m.inside("a"))),
        last_name=m.text(m.first_of(second, m.inside("a"))),
        link=m.attribute(first, "href"),
    )
    return parsed.withColumns(_status({"no link": F.col("link") == ""}, nothing=_no_record())).drop("present", "cells")


def parse_links(pages: DataFrame, within: str = "li") -> DataFrame:
    """Every link that fills an element of this kind: (url, position, href, text)."""
    found = m.all_of(F.col("html"), rf"(?is)<{within}\b[^>]*>\s*(<a\s[^>]*>.*?</a\s*>)")
    links = _seen(pages).select("url", F.posexplode(found).alias("position", "a"))
    return links.select("url", "position", m.attribute(F.col("a"), "href").alias("href"), m.text(F.col("a")).alias("text"))


def parse_elements(pages: DataFrame, tag: str) -> DataFrame:
    """Text of every element of one kind: (url, position, text)."""
    found = m.all_of(F.col("html"), m.inside(tag))
    elements = _seen(pages).select("url", F.posexplode(found).alias("position", "e"))
    return elements.select("url", "position", m.joined_text(F.col("e")).alias("text"))


def extract_listing(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of :func:`parse_listing`."""
    return split_status(parse_listing(pages))


def extract_card(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of :func:`parse_card`."""
    return split_status(parse_card(pages))


def extract_box_score(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of :func:`parse_box_score`."""
    return split_status(parse_box_score(pages))


def extract_profile(pages: DataFrame, labels: Mapping[str, str] = PROFILE_LABELS) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of :func:`parse_profile`."""
    return split_status(parse_profile(pages, labels))


def extract_index(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of :func:`parse_index`."""
    return split_status(parse_index(pages))
