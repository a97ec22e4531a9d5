"""The library for pipelines written in SQL: the text parsers as functions, and
latest-per-key and unpivot as table functions over a table or view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from antecede.functions.text import SENTINELS

_PRESENT = "nullify_sentinels(c)"

# name -> (result type, body over the argument ``c``); the first is used by the others.
SQL_FUNCTIONS = {
    "nullify_sentinels": ("STRING", f"if(c IN ({', '.join(repr(s) for s in SENTINELS)}), NULL, c)"),
    "parse_landed": ("INT", "try_cast(split_part(c, ' of ', 1) AS INT)"),
    "parse_attempted": ("INT", "try_cast(split_part(c, ' of ', 2) AS INT)"),
    "parse_percentage": ("DOUBLE", f"CAST(try_cast(rtrim('%', {_PRESENT}) AS DECIMAL(5, 2)) AS DOUBLE) / 100D"),
    "parse_mmss_seconds": (
        "INT",
        "try_cast(split_part(c, ':', 1) AS INT) * 60 + try_cast(split_part(c, ':', 2) AS INT)",
    ),
    "parse_long_date": ("DATE", f"try_to_date({_PRESENT}, 'MMMM d, yyyy')"),
    "parse_short_date": ("DATE", f"try_to_date({_PRESENT}, 'MMM d, yyyy')"),
}


def register_sql_functions(spark: SparkSession, database: str | None = None) -> list[str]:
    """Make the parsers callable in ``spark.sql``: for this session, or for good in a
    ``database``, where lasting views can use them. They are plain SQL bodies that the
    analyzer inlines; nothing runs in Python."""
    names = {}
    for name, (returns, body) in SQL_FUNCTIONS.items():
        names[name] = f"`{database}`.{name}" if database else name
        for known, full in names.items():
            body = body.replace(f"{known}(", f"{full}(")
        kind = "FUNCTION" if database else "TEMPORARY FUNCTION"
        spark.sql(f"CREATE OR REPLACE {kind} {names[name]}(c STRING) RETURNS {returns} RETURN {body}")
    return list(names.values())


def _columns(spark: SparkSession, source: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in spark.table(source).schema]


def _listed(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def _table_function(spark: SparkSession, name: str, arguments: str, columns: list[tuple[str, str]], query: str) -> None:
    shape = ", ".join(f"`{c}` {kind}" for c, kind in columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE({shape}) RETURN {query}")


def register_latest(
    spark: SparkSession, name: str, source: str, keys: Sequence[str], order_desc: str, tie_break: Sequence[str] = ()
) -> None:
    """A table function ``name(as_of)``: of each key of ``source`` (a table or view) its latest
    version, not later than ``as_of`` (NULL: whatever there is). Versions of one instant are told
    apart by ``tie_break``, greatest first. A row without a time is the oldest version, and none as
    of a given time."""
    columns = _columns(spark, source)
    kind = dict(columns)[order_desc]
    order = ", ".join(f"`{c}` DESC NULLS LAST" for c in (order_desc, *tie_break))
    kept = _listed([c for c, _ in columns])
    query = f"""SELECT {kept} FROM (
        SELECT {kept}, row_number() OVER (PARTITION BY {_listed(keys)} ORDER BY {order}) AS _nth
        FROM {source} WHERE as_of IS NULL OR `{order_desc}` <= as_of) WHERE _nth = 1"""
    _table_function(spark, name, f"as_of {kind} DEFAULT NULL", columns, query)


def register_unpivot(
    spark: SparkSession,
    name: str,
    source: str,
    common: Sequence[str],
    side_cols: Mapping[str, str],
    cross_cols: Mapping[str, str] | None = None,
    sides: tuple[str, str] = ("a", "b"),
    side_name: str = "corner",
) -> None:
    """A table function ``name()``: two rows per row of ``source``, as
    :func:`antecede.operators.unpivot_pairs` gives them; the source is read once."""
    types = dict(_columns(spark, source))
    first, second = sides

    def view(me: str, other: str) -> str:
        fields = [f"'{me}' AS `{side_name}`"]
        fields += [f"`{p.format(side=me)}` AS `{n}`" for n, p in side_cols.items()]
        fields += [f"`{p.format(side=other)}` AS `{n}`" for n, p in (cross_cols or {}).items()]
        return f"struct({', '.join(fields)})"

    made = {n: types[p.format(side=first)] for n, p in {**side_cols, **(cross_cols or {})}.items()}
    columns = [(c, types[c]) for c in common] + [(side_name, "string"), *made.items()]
    query = f"""SELECT {_listed([c for c, _ in columns])} FROM {source}
        LATERAL VIEW inline(array({view(first, second)}, {view(second, first)})) both_sides"""
    _table_function(spark, name, "", columns, query)
