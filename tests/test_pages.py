"""Records from pages in the site's markup, regular and not."""

import re
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from antecede.bindings_pages import reference_pages
from antecede.functions import markup
from antecede.plans.bronze import bronze_bouts, bronze_events, bronze_fighters
from antecede.sources import pages as p

BLANK = "<html><body><h1>Gone</h1></body></html>"


def pages(spark, *htmls):
    return spark.createDataFrame([(f"page-{i}", h) for i, h in enumerate(htmls)], "url string, html string")


def listing(*rows):
    body = "".join(
        f'<tr><td><a href="{link}">{name}</a> \n <span>{day}</span></td><td>\t{place} </td></tr>' for name, day, place, link in rows
    )
    return f'<table class="wide {p.LISTING_TABLE}"><tr><th>Event</th></tr>{body}</table>'


EVENTS = [
    ("Harbour Cup", "May 02, 2019", "Oslo, Norway", "http://h.test/ev/70"),
    ("Lake &amp; Hill II", "June 30, 2018", "Quito, Ecuador", "http://h.test/ev/71"),
]


def bout(result="win", one="Ida Berg", two="Noa Lind", weight="Strawweight", link="http://h.test/bt/5"):
    def name(who):
        return f'<p class="{p.CELL_TEXT}"><a class="{p.BLACK_LINK}" href="http://h.test/p">{who}</a></p>'

    left = f'<td class="{p.LEFT_CELL}">'
    weighed = f'{left}<p class="{p.CELL_TEXT}"> {weight} </p></td>' if weight else ""
    mark = f'<i class="{p.FLAG_TEXT}">{result}</i>' if result is not None else ""
    return f"<tr onclick=\"go('{link}')\"><td>{mark}</td>{left}{name(one)}{name(two)}</td>{weighed}</tr>"


def card(*bouts):
    return f"<table><tr><th>Result</th></tr>{''.join(bouts)}</table>"


VALUES = ["Ida Berg", "Noa Lind", *(str(100 + n) for n in range(len(p.BOX_SCORE_COLUMNS) - 2))]


def score(values=VALUES, summary=True, method="Verdict"):
    def cell(n, value):
        inner = f'<a class="{p.BLACK_LINK}" href="http://h.test/p/{n}">{value}</a>' if n < 2 else value
        return f'<td><p class="{p.CELL_TEXT}"> {inner} </p></td>'

    cells = "".join(cell(n, v) for n, v in enumerate(values))
    item = f'<i class="{p.SUMMARY_ITEM}"><i>{{}}</i> {{}} </i>'
    told = (
        f'<p class="{p.SUMMARY}"><i class="{p.SUMMARY_FIRST}"><i>Method:</i> <i style="{p.METHOD_STYLE}">{method}</i></i>'
        f"{item.format('Round:', 4)}{item.format('Time:', '0:58')}</p>"
    )
    return f"<table><tr>{cells}</tr></table>" + (told if summary else "")


def profile(name, **labels):
    items = "".join(f'<li class="{p.PROFILE_ITEM}"><i> {k}: </i> {v}</li>' for k, v in labels.items())
    return f'<span class="{p.PROFILE_NAME}">{name}</span><ul>{items}</ul>'


def read_box(spark, *htmls):
    found = p.parse_box_score(pages(spark, *htmls)).collect()
    return {r.url: r for r in found}


#: Ways in which a page may be written differently and mean the same.
IRREGULAR = {
    "single quotes": lambda html: re.sub(r"""="([^"']*)\"""", r"='\1'", html),
    "upper-case tags": lambda html: html.replace("<table", "<TABLE").replace("</table", "</TABLE").replace("<p ", "<P ").replace("</p>", "</P>"),
    "a table in a comment before": lambda html: "<!-- <table><tr><td>old</td></tr></table> -->" + html,
    "a script before": lambda html: "<script>var t = '<table><tr></tr></table>';</script>" + html,
    "spaces around =": lambda html: html.replace('class="', 'class = "'),
    "a further class": lambda html: html.replace(f'"{p.CELL_TEXT}"', f'"x {p.CELL_TEXT} y"').replace(f'"{p.FLAG_TEXT}"', f'"{p.FLAG_TEXT} z"'),
    "a line break in a tag": lambda html: html.replace('<p class="', '<p\n class="'),
}


@pytest.mark.parametrize("how", IRREGULAR)
def test_irregular_pages_give_the_same(spark, how):
    change = IRREGULAR[how]
    row = read_box(spark, change(score()))["page-0"]
    assert row.status == "ok" and [row[c] for c in p.BOX_SCORE_COLUMNS] == VALUES
    assert (row.method, row.finish_round, row.finish_time) == ("Verdict", "4", "0:58")
    records, quarantine = p.extract_card(pages(spark, change(card(bout(), bout("draw")))))
    assert [(r.winner_name, r.result, r.weight_class) for r in records.orderBy("position").collect()] == [
        ("Ida Berg", "win", "Strawweight"),
        ("draw", "draw", "Strawweight"),
    ]
    assert quarantine.isEmpty()
    records, _ = p.extract_listing(pages(spark, change(listing(*EVENTS))))
    assert records.count() == 2


def test_a_table_within_a_cell(spark):
    nested = score().replace("</tr></table>", "<td><table><tr><td>odds</td></tr></table></td></tr></table>", 1)
    row = read_box(spark, nested)["page-0"]
    assert row.status == "ok" and [row[c] for c in p.BOX_SCORE_COLUMNS] == VALUES


def test_listing(spark):
    records, quarantine = p.extract_listing(pages(spark, listing(*EVENTS), BLANK))
    found = [(r.event_name, r.event_date, r.event_location, r.event_url) for r in records.orderBy("position").collect()]
    assert found == [EVENTS[0], ("Lake & Hill II", *EVENTS[1][1:])]
    assert quarantine.isEmpty()


def test_a_class_that_only_begins_alike_is_another(spark):
    other = listing(*EVENTS).replace(p.LISTING_TABLE, p.LISTING_TABLE + "-old")
    parsed = p.parse_listing(pages(spark, other))
    assert p.split_status(parsed)[0].isEmpty() and [r.reason for r in p.skipped(parsed).collect()] == ["no table"]


def test_what_gives_nothing_is_told(spark):
    head = f'<table class="{p.LISTING_TABLE}"><tr><th>Event</th></tr>'
    htmls = [listing(*EVENTS), BLANK, head + "</table>", head + "<tr><td>one</td></tr><TR><TD>two</TD></TR></table>"]
    for parse in (p.parse_listing, p.parse_index):
        told = {(r.url, r.reason, r.n) for r in p.skipped(parse(pages(spark, *htmls))).collect()}
        assert told == {("page-1", "no table", 1), ("page-2", "no rows", 1), ("page-3", "a row of one cell", 2)}
    assert {r.url for r in p.extract_listing(pages(spark, *htmls))[0].collect()} == {"page-0"}


def test_listing_row_without_its_day(spark):
    html = listing(EVENTS[0], ("Nameless Day", "", "Lima, Peru", "http://h.test/ev/72"))
    records, quarantine = p.extract_listing(pages(spark, html))
    assert [r.event_name for r in records.collect()] == ["Harbour Cup"]
    assert [r.reason for r in quarantine.collect()] == ["no date line"]


def test_card_faults(spark):
    whole, short, silent = card(bout()), card(bout(), bout(weight=None)), card(bout(), bout(result=None))
    records, quarantine = p.extract_card(pages(spark, whole, short, silent, BLANK))
    assert {r.url for r in records.collect()} == {"page-0"}
    assert {(r.url, r.reason) for r in quarantine.collect()} == {
        ("page-1", "lists of unequal length"),
        ("page-2", "a row without a result"),
    }


def test_card_link_in_either_quotes(spark):
    html = card(bout(link="http://h.test/bt/9")).replace("\"go('http://h.test/bt/9')\"", "'go(\"http://h.test/bt/9\")'")
    assert p.extract_card(pages(spark, html))[0].first().bout_url == "http://h.test/bt/9"


def test_box_score_states(spark):
    found = read_box(spark, score(), BLANK, score(VALUES[:-1]), score([*VALUES, "9"]), score(summary=False))
    assert {u: (r.status, r.reason) for u, r in found.items()} == {
        "page-0": ("ok", None),
        "page-1": ("skip", None),
        "page-2": ("quarantine", "fewer cells than columns"),
        "page-3": ("quarantine", "more cells than columns"),
        "page-4": ("quarantine", "no summary"),
    }
    assert (found["page-0"].fighter_a_url, found["page-0"].fighter_b_url) == ("http://www.h.test/p/0", "http://www.h.test/p/1")
    assert [r.url for r in p.skipped(p.parse_box_score(pages(spark, score(), BLANK))).collect()] == ["page-1"]


def test_profile(spark):
    long = profile("Kim de Vries", Height="170 cm", Weight="61 kg", STANCE="Left")
    alone = profile("Pelle", Reach="--", Extra="yes")
    records, quarantine = p.extract_profile(pages(spark, long, alone, BLANK))
    rows = {r.url: r for r in records.collect()}
    assert (rows["page-0"].first_name, rows["page-0"].height, rows["page-0"].weight) == ("Kim", "170 cm", "61 kg")
    assert rows["page-0"].stance == "Left" and rows["page-0"].reach is None
    assert rows["page-1"].fighter_name == "Pelle" and rows["page-1"].profile_json == '{"Reach":"--","Extra":"yes"}'
    assert [(r.url, r.reason) for r in quarantine.collect()] == [("page-2", "no label")]


def test_index(spark):
    def cell(text):
        return f'<td><a href="http://h.test/p/{text}">{text}</a></td>'

    html = f"<table><tr><th>A</th></tr><tr>{cell('Uma')}{cell('Roos')}</tr><tr><td>alone</td></tr></table>"
    records, _ = p.extract_index(pages(spark, html))
    assert [(r.first_name, r.last_name, r.link) for r in records.collect()] == [("Uma", "Roos", "http://h.test/p/Uma")]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Jos&eacute; &#233; &#8217; &#x2019;", "José é ’ ’"),
        ("&amp;lt; &lt;b&gt; &hearts;&nbsp;.", "&lt; <b> ♥\xa0."),
        ("&#0; &#xD800; &#146; &#128512; &#99999999;", "� � ’ \U0001f600 �"),
        ("a & b &unknown; &; &#; 100&", "a & b &unknown; &; &#; 100&"),
        ("no reference", "no reference"),
        ("&Aacute;&Ccedil;&szlig;&copy;&hellip;", "ÁÇß©…"),
    ],
)
def test_character_references(spark, text, want):
    row = spark.createDataFrame([(text,)], "t string").select(markup.unescape(F.col("t")).alias("t")).first()
    assert row.t == want


def test_every_named_reference_is_found_on_its_own_small_shelf(spark):
    names = [n for n in html5 if n.endswith(";") and len(n) > 1]
    df = spark.createDataFrame([(n, f"&{n}") for n in names], "name string, t string")
    found = {r.name: r.t for r in df.select("name", markup.unescape(F.col("t")).alias("t")).collect()}
    assert found == {n: html5[n] for n in names}
    # A name costs a search of its shelf, not of all names.
    assert max(map(len, markup._names().split("\x02"))) < 200


def test_reference_pages_are_spread_before_they_are_rendered(spark, tmp_path):
    rows = [(i, f"olive tin {i}", "small", "brand") for i in range(2000)]
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_type string, p_brand string").coalesce(1).write.parquet(
        str(tmp_path / "part.parquet")
    )
    df = reference_pages(spark, str(tmp_path))
    assert "RepartitionByExpression" in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 2000


def test_a_card_row_is_searched_once_for_its_flag(spark):
    parsed = p.parse_card(pages(spark, "<table></table>"))
    pattern = markup.inside("i", class_=p.FLAG_TEXT)
    assert parsed._jdf.queryExecution().analyzed().toString().count("flag__text") == pattern.count("flag__text")


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<P class="x cell y">a<b>c</b>\n</p ><p class="cells">no</p>', ["a<b>c</b>\n"]),
        ("<p id=1 class='cell'>a</pre>b</P><p class=cell>c</p>", ["a</pre>b", "c"]),
        ('<p class="cell">a<p class="cell">b</p>', ['a<p class="cell">b']),
        ('<p class="cell">never closed <', []),
        ('<p class="CELL">a</p><p title="cell">b</p><p class="">c</p>', []),
    ],
)
def test_inside(spark, html, want):
    row = pages(spark, html).select(markup.all_of(F.col("html"), markup.inside("p", class_="cell")).alias("a")).first()
    assert row.a == want


def test_interstitials(spark):
    waiting = f"<html><p>{p.CHALLENGE_MARKER} first</p></html>"
    real, others = p.drop_interstitials(pages(spark, BLANK, waiting))
    assert [r.url for r in real.collect()] == ["page-0"] and [r.url for r in others.collect()] == ["page-1"]


def test_patterns_run_once_a_page(spark):
    plan = p.extract_box_score(pages(spark, score()))[0]._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" +-:").startswith("Filter")]
    assert filters and not any("regexp" in line for line in filters)


def test_elements_and_links(spark):
    html = '<H1>North &amp; <b>South</b></H1><p>up<!-- <p>not</p> --></p><ul><LI> <a href=\'/go\'>Go </a></LI></ul>'
    assert [r.text for r in p.parse_elements(pages(spark, html), "h1").collect()] == ["North &South"]
    assert [r.text for r in p.parse_elements(pages(spark, html), "p").collect()] == ["up"]
    assert [(r.href, r.text) for r in p.parse_links(pages(spark, html)).collect()] == [("/go", "Go")]


def test_bronze_records(spark):
    cards = pages(spark, card(bout(link="bt-1"), bout("nc", link="bt-2")))
    scores = spark.createDataFrame(
        [("bt-1", score()), ("bt-2", p.CHALLENGE_MARKER), ("bt-3", score(VALUES[:5])), ("bt-4", score())], "url string, html string"
    )
    records, quarantine = bronze_bouts(cards, scores, "run-8")
    row = records.first()
    assert records.count() == 1 and (row.bout_url, row.event_url, row.method) == ("bt-1", "page-0", "Verdict")
    assert row["_batch_id"] == "run-8" and '"117"' in row["_raw_payload"]
    assert {(r.url, r.reason) for r in quarantine.collect()} == {("bt-2", "interstitial"), ("bt-3", "fewer cells than columns")}
    events, _ = bronze_events(pages(spark, listing(*EVENTS)), "run-8")
    assert events.count() == 2 and "_ingested_at" in events.columns
    people, _ = bronze_fighters(pages(spark, profile("Kim de Vries", Height="170 cm")), "run-8")
    assert people.first()["_raw_payload"] == '{"Height":"170 cm"}'
