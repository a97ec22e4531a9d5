"""Web pages rendered from the bound raw layer, in the markup the extractors
read. Extracting them must give the raw layer back.

Pages that list several records hold at most ``PER_PAGE`` of them, by key range,
so no page grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from antecede import bindings
from antecede.sources import pages as p

PER_PAGE = 20


def _escaped(name: str) -> str:
    return f"replace(replace(coalesce({name}, ''), '&', '&amp;'), '<', '&lt;')"


def _paged(
    rows: DataFrame, number: str, row: str, head: str, tail: str, kind: str, per_page: int = PER_PAGE, gaps: bool = False
) -> DataFrame:
    """Pages of rendered rows in ``number`` order. With ``gaps`` pages lack their table or all rows, and
    rows with a number divisible by 7 have one cell."""
    cell = f"if({number} % 7 = 0, '<tr><td>alone</td></tr>', {row})" if gaps else row
    cut = rows.selectExpr(f"{number} div {per_page} AS page", f"struct({number} AS n, {cell} AS html) AS r")
    pages = cut.groupBy("page").agg(F.sort_array(F.collect_list("r")).alias("rows"))
    html = f"'{head}' || array_join(rows.html, '\n') || '{tail}'"
    if gaps:
        html = f"CASE page % 5 WHEN 0 THEN '<p>gone</p>' WHEN 1 THEN '{head}{tail}' ELSE {html} END"
    return pages.selectExpr(f"'{kind}/' || page AS url", f"{html} AS html")


def irregular(pages: DataFrame) -> DataFrame:
    """The same pages in markup that is written differently and means the same; which way depends
    on the address."""
    way = "crc32(url) % 5"
    quote = "chr(39)"
    return pages.selectExpr(
        "url",
        f"""CASE {way}
            WHEN 0 THEN regexp_replace(html, '="([^"\\']*)"', '=' || {quote} || '$1' || {quote})
            WHEN 1 THEN regexp_replace(regexp_replace(html, '<(/?)table', '<$1TABLE'), '<(/?)td', '<$1Td')
            WHEN 2 THEN '<!-- <table><tr><td>old</td><td>x</td></tr></table> -->' || html
            WHEN 3 THEN '<SCRIPT>var t = "<table><tr><td>no</td></tr></table>";</SCRIPT >' || html
            ELSE replace(html, 'class="', 'class = "') END AS html""",
    )


def listing_pages(spark: SparkSession, sf_dir: str, per_page: int = PER_PAGE, gaps: bool = False) -> DataFrame:
    """The raw events, listed."""
    row = f"""'<tr class="row"><td class="c">\n <i><a href="' || event_url || '" class="{p.BLACK_LINK}">'
        || {_escaped("event_name")} || '</a>\n <span>' || event_date || '</span></i></td><td class="c"> '
        || event_location || ' </td></tr>'"""
    head = f'<table class="b-statistics__table {p.LISTING_TABLE}"><thead><tr><th>Name</th><th>Place</th></tr></thead>'
    events = bindings.raw_events(spark, sf_dir).selectExpr("*", "unix_date(CAST(_ingested_at AS date)) AS n")
    return _paged(events, "n", row, head, "</table>", "list", per_page, gaps)


def _staged_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current raw bouts with their number."""
    raw = bindings.raw_bouts(spark, sf_dir).filter("_ingested_at = bout_at")
    return raw.selectExpr("*", "CAST(split_part(bout_url, '/', 2) AS bigint) AS n", "coalesce(result, 'win') AS flag")


def card_pages(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """The raw bouts as cards. With ``broken`` the bouts of class 3 lack their
    weight class, so their pages' lists do not pair up."""

    def link(key: str, name: str) -> str:
        return f"""'<p class="{p.CELL_TEXT}"><a class="{p.BLACK_LINK}" href="' || {key} || '">' || {name} || '</a></p>'"""

    first = "if(winner_name = fighter_b_name, fighter_b_{0}, fighter_a_{0})".format
    second = "if(winner_name = fighter_b_name, fighter_a_{0}, fighter_b_{0})".format
    weight = f"""'<p class="{p.CELL_TEXT}">' || weight_class || '</p>'"""
    cell = f"""'<td class="{p.LEFT_CELL}">' || {weight} || '</td>'"""
    if broken:
        cell = f"if(weight_class = 'Class 3', '', {cell})"
    row = f"""'<tr class="row" onclick="doNav(\\'' || bout_url || '\\')"><td class="c"><i class="{p.FLAG_TEXT}">'
        || flag || '</i></td><td class="{p.LEFT_CELL}">' || {link(first("url"), first("name"))}
        || {link(second("url"), second("name"))} || '</td>' || {cell} || '</tr>'"""
    head = "<table><tr><th>W/L</th><th>Fighter</th></tr>"
    return _paged(_staged_shape(spark, sf_dir), "n div 2", row, head, "</table>", "card")


def box_score_pages(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """The raw bouts as box scores, one page each. With ``broken`` some have a
    cell too many, some too few, some no summary and some no table."""
    text = f"""'<p class="{p.CELL_TEXT}">' || {{}} || '</p>'""".format
    anchor = f"""'<a class="{p.BLACK_LINK}" href="http://' || {{}} || '">' || {{}} || '</a>'""".format
    cells = [text(anchor("fighter_a_url", "fighter_a_name")), text(anchor("fighter_b_url", "fighter_b_name"))]
    cells += [text(c) for c in p.BOX_SCORE_COLUMNS[2:]]
    extra = f"""CASE WHEN n % 7 = 0 AND n % 5 <> 0 THEN '<p class="{p.CELL_TEXT}">0</p>' ELSE '' END""" if broken else "''"
    last = f"CASE WHEN n % 5 = 0 THEN '' ELSE {cells[-1]} END" if broken else cells[-1]
    body = " || ".join([*cells[:-1], last, extra])
    summary = f"""'<p class="{p.SUMMARY}"><i class="{p.SUMMARY_FIRST}"><i class="l">Method:</i>
        <i style="{p.METHOD_STYLE}">' || method || '</i></i> <i class="{p.SUMMARY_ITEM}"><i class="l">Round:</i>
        ' || finish_round || ' </i> <i class="{p.SUMMARY_ITEM}"><i class="l">Time:</i> ' || finish_time || '</i></p>'"""
    if broken:
        summary = f"CASE WHEN n % 11 = 0 THEN '' ELSE {summary} END"
    html = f"""'<html><body><table><tr><td>' || {body} || '</td></tr></table>' || {summary} || '</body></html>'"""
    if broken:
        html = f"CASE WHEN n % 13 = 0 THEN '<html><body><p>no box score</p></body></html>' ELSE {html} END"
    return _staged_shape(spark, sf_dir).selectExpr("bout_url AS url", f"{html} AS html")


def profile_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw profiles, one page each. A profile with no reach on file lacks the
    item; every page has a blank one."""
    item = f"""'<li class="{p.PROFILE_ITEM}"><i class="t">{{}}:</i> ' || {{}} || '</li>\n'""".format
    items = " || ".join(
        f"if(reach = '--', '', {item(label, column)})" if column == "reach" else item(label, column)
        for label, column in p.PROFILE_LABELS.items()
    )
    blank = f"""'<li class="{p.PROFILE_ITEM}"><i></i></li>'"""
    html = f"""'<h2><span class="{p.PROFILE_NAME}"> ' || fighter_name || ' </span></h2><ul>' || {items} || {blank}
        || '</ul>'"""
    return bindings.raw_fighters(spark, sf_dir).selectExpr("fighter_url AS url", f"{html} AS html")


def index_pages(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """The raw profiles as index pages."""
    fighters = bindings.raw_fighters(spark, sf_dir).selectExpr(
        "*", "CAST(split_part(fighter_url, '/', 2) AS bigint) AS n"
    )
    link = """'<td><a href="' || fighter_url || '">' || {} || '</a></td>'""".format
    row = f"""'<tr>' || {link("first_name")} || {link("last_name")} || '<td>-</td></tr>'"""
    return _paged(fighters, "n", row, "<table><tr><th>First</th><th>Last</th></tr>", "</table>", "index", gaps=gaps)


def reference_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts as paragraphs, with letters as character references: named, decimal, hexadecimal."""
    html = "p_name || ' & ' || p_type || ' <' || p_brand"
    for plain, reference in (("&", "&amp;"), ("<", "&lt;"), ("o", "&#x6F;"), ("i", "&#105;")):
        html = f"replace({html}, '{plain}', '{reference}')"
    # The file is far smaller than the pages rendered from it: its rows are spread before that.
    parts = bindings.table(spark, sf_dir, "part").repartition("p_partkey", "p_name")
    return parts.selectExpr(
        "'part/' || p_partkey AS url", f"'<p>' || {html} || ' &eacute;&hearts;&NewLine;&unknown; &#146;</p>' AS html"
    )
