"""Column functions against fixed values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from antecede import functions as fn
from antecede.functions import markup


def evaluate(spark, function, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["out"] for r in rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


CASES = {
    "nullify_sentinels": [("--", None), ("---", None), ("", None), ("0", "0"), (None, None), ("-", "-")],
    "parse_landed": [("14 of 31", 14), ("0 of 0", 0), ("---", None), ("", None), (None, None), ("x of 3", None)],
    "parse_attempted": [("14 of 31", 31), ("0 of 0", 0), ("---", None), ("14", None), ("14 of", None)],
    "parse_percentage": [("45%", 0.45), ("---", None), ("100%", 1.0), ("0%", 0.0), ("abc%", None), ("12345%", None)],
    "parse_mmss_seconds": [("5:08", 308), ("0:02", 2), ("75:00", 4500), ("--", None), ("5", None), (":", None)],
    "parse_height": [("5' 11\"", 71), ("6' 0\"", 72), ("6'", None), ("--", None), ("", None)],
    "parse_unit_number": [("155 lbs.", 155), ("--", None), ("155", 155), ("lbs.", None)],
    "parse_inches": [('75"', 75), ("--", None), ("75", 75)],
    "parse_count": [("3", 3), ("", None), ("4x", None)],
    "parse_decimal": [("3.14", Decimal("3.14")), ("0", Decimal("0.00")), ("--", None)],
}


@pytest.mark.parametrize("name", CASES)
def test_parser(spark, name):
    given, expected = zip(*CASES[name])
    assert evaluate(spark, getattr(fn, name), given) == list(expected)


def test_site_dates(spark):
    long = ["September 05, 2026", "September 5, 2026", "Sep 5, 2026", "--", "February 30, 2026", None]
    want = [dt.date(2026, 9, 5), dt.date(2026, 9, 5), None, None, None, None]
    assert evaluate(spark, lambda c: fn.parse_site_date(c, "long"), long) == want
    short = ["Feb 13, 1990", "Feb 3, 1990", "Feb 30, 1990", "--"]
    want = [dt.date(1990, 2, 13), dt.date(1990, 2, 3), None, None]
    assert evaluate(spark, lambda c: fn.parse_site_date(c, "short"), short) == want


def test_split_location(spark):
    given = ["Las Vegas, Nevada, USA", "Shanghai, China", "Singapore", "a, b, c, d"]
    got = [tuple(r) for r in evaluate(spark, fn.split_location, given)]
    assert got == [
        ("Las Vegas", "Nevada", "USA"),
        ("Shanghai", None, "China"),
        ("Singapore", None, "Singapore"),
        ("a", None, "d"),
    ]


def test_split_full_name(spark):
    got = [tuple(r) for r in evaluate(spark, fn.split_full_name, ["Ann Bee Cee", "Solo"])]
    assert got == [("Ann", "Bee Cee"), ("Solo", "")]


def test_is_finish_is_three_valued(spark):
    given = ["KO/TKO", "Submission", "TKO - Doctor's Stoppage", "Decision - Split", "DQ", "Overturned", None]
    assert evaluate(spark, fn.is_finish, given) == [True, True, True, False, None, None, None]


def test_surrogate_keys_tell_null_from_missing(spark):
    row = spark.sql("SELECT CAST(NULL AS string) AS n, 'x' AS x, 7 AS i").select(
        fn.surrogate_key("n", "x").alias("a"),
        fn.surrogate_key("x").alias("b"),
        fn.surrogate_key_or_null("n").alias("c"),
        fn.surrogate_key_or_null("i").alias("d"),
        fn.surrogate_key(F.lit("7")).alias("e"),
    ).first()
    assert row.a != row.b and row.a is not None and row.c is None and row.d == row.e and len(row.d) == 32


def test_numbers(spark):
    row = spark.sql("SELECT 3 AS x, 0 AS z, DATE '2020-01-01' AS d, DATE '1990-01-01' AS b, '1:30' AS t").select(
        fn.safe_ratio(F.col("x"), F.col("z")).alias("by_zero"),
        fn.safe_ratio(F.col("x"), F.lit(2)).alias("half"),
        fn.age_years(F.col("d"), F.col("b")).alias("age"),
        fn.bout_seconds(F.col("x"), F.lit(10)).alias("seconds"),
        fn.control_share(F.col("t"), F.lit(3.0)).alias("share"),
        fn.indicator(F.lit(None).cast("boolean")).alias("none"),
    ).first()
    assert row.by_zero is None and row.half == 1.5 and row.age == 10957 / 365.25
    assert row.seconds == 610 and row.share == 0.5 and row.none == 0


def test_outcomes(spark):
    rows = spark.createDataFrame(
        [
            (1, "win", "A"),
            (2, None, "B"),
            (3, "draw", "draw"),
            (4, None, "nc"),
            (5, "nc", "nc"),
        ],
        "i int, result string, winner string",
    )
    winner = fn.winner_key(F.col("winner"), F.lit("A"), F.lit("ka"), F.lit("B"), F.lit("kb"))
    out = fn.outcome_of(F.col("result"), F.col("winner"))
    me, them = F.lit("ka"), F.lit("kb")
    got = rows.select(
        "i",
        out.alias("outcome"),
        fn.perspective_won(winner, me, them, out == "draw").alias("won"),
        fn.perspective_result(winner, me, them, out == "draw", out == "nc").alias("result"),
    )
    assert [tuple(r)[1:] for r in got.orderBy("i").collect()] == [
        ("win", True, "win"),
        ("win", False, "loss"),
        ("draw", False, "draw"),
        ("nc", None, "no_contest"),
        ("nc", None, "no_contest"),
    ]


def test_markup(spark):
    given = ["<td> <b>A &amp; B</b>\n  <i>c&#39;s</i> </td>", "&amp;lt;", "x &quot;y&quot;"]
    assert evaluate(spark, markup.joined_text, given) == ["A & Bc's", "&lt;", 'x "y"']
    assert evaluate(spark, markup.lines, ["<a>one</a>\n\n <b> two </b> "]) == [["one", "two"]]
    links = ["http://site.com/x", "http://www.site.com/x", "https://site.com/x"]
    want = ["http://www.site.com/x", "http://www.site.com/x", "https://site.com/x"]
    assert evaluate(spark, markup.canonical_link, links) == want
    assert evaluate(spark, lambda c: markup.canonical_link(markup.canonical_link(c)), links) == want


def test_sql_functions_agree_with_the_column_functions(spark):
    from antecede.functions.sql import register_sql_functions

    assert "parse_landed" in register_sql_functions(spark)
    for name in ("nullify_sentinels", "parse_landed", "parse_attempted", "parse_percentage", "parse_mmss_seconds"):
        values = [v for v, _ in CASES[name]]
        by_column = evaluate(spark, getattr(fn, name), values)
        assert evaluate(spark, lambda c: F.expr(f"{name}(v)"), values) == by_column
    dates = ["September 5, 2026", "--", "x"]
    assert evaluate(spark, lambda c: F.expr("parse_long_date(v)"), dates) == [dt.date(2026, 9, 5), None, None]
    assert evaluate(spark, lambda c: F.expr("parse_short_date(v)"), ["Feb 13, 1990"]) == [dt.date(1990, 2, 13)]
