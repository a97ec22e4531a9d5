"""Every query of the library, over the given tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. ``oracles.py`` has the
same results as SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from antecede import bindings as b
from antecede import bindings_pages as bp
from antecede import functions as fn
from antecede.functions import markup
from antecede.functions import sql as fn_sql
from antecede.operators import (
    attach_columns,
    distinct_participants,
    latest_per_key,
    page_of,
    point_lookup,
    prior_avg,
    prior_count,
    prior_last,
    prior_max,
    prior_measures,
    prior_sum,
    select_window,
    since_watermark,
    todo,
)
from antecede.operators import quality as q
from antecede.operators.prior import MAX_ROWS_PER_TASK
from antecede.plans import bronze, career, checks, features, marts, serving
from antecede.session import scratch_path, written
from antecede.sources import catalog, landing, load, seeds
from antecede.sources import pages as pg
from antecede.sources.freshness import freshness
from antecede.streaming import load_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


# --- column functions ---------------------------------------------------------


def _per_value(df: DataFrame, rendered: str, **parsed) -> DataFrame:
    """Rendered values, what they parse to and how often they occur."""
    values = df.selectExpr(f"{rendered} AS rendered").groupBy("rendered").agg(F.count(F.lit(1)).alias("n"))
    return values.select("rendered", "n", *(column.alias(name) for name, column in parsed.items()))


@query
def parse_of_pairs(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    rendered = "if(l_linenumber = 7, '---', CAST(l_quantity AS int) || ' of ' || (CAST(l_quantity AS int) + l_linenumber))"
    return _per_value(lines, rendered, landed=fn.parse_landed("rendered"), attempted=fn.parse_attempted("rendered"))


@query
def parse_percentage(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    rendered = "if(l_tax = 0, '---', CAST(round(l_discount * 100) * 10 + l_linenumber AS int) || '%')"
    return _per_value(lines, rendered, share=fn.parse_percentage("rendered"))


@query
def parse_mmss(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    rendered = "if(l_linenumber = 7, '--', (l_partkey % 90) || ':' || lpad(CAST(l_suppkey % 60 AS string), 2, '0'))"
    return _per_value(lines, rendered, seconds=fn.parse_mmss_seconds("rendered"))


@query
def parse_site_date_long(spark, sf_dir):
    rendered = "if(o_orderstatus = 'P', '--', date_format(o_orderdate, 'MMMM dd, yyyy'))"
    return _per_value(b.table(spark, sf_dir, "orders"), rendered, parsed=fn.parse_site_date("rendered", "long"))


@query
def parse_site_date_short(spark, sf_dir):
    rendered = "if(o_orderstatus = 'P', '--', date_format(o_orderdate, 'MMM dd, yyyy'))"
    return _per_value(b.table(spark, sf_dir, "orders"), rendered, parsed=fn.parse_site_date("rendered", "short"))


@query
def parse_height(spark, sf_dir):
    feet = "(4 + p_size % 4) || chr(39)"
    rendered = f"CASE WHEN p_size % 9 = 0 THEN '--' WHEN p_size % 9 = 1 THEN {feet} ELSE {feet} || ' ' || (p_partkey % 12) || chr(34) END"
    return _per_value(b.table(spark, sf_dir, "part"), rendered, inches=fn.parse_height("rendered"))


@query
def parse_unit_number(spark, sf_dir):
    rendered = "if(c_nationkey = 0, '--', CAST(floor(abs(c_acctbal)) AS int) || ' lbs.')"
    return _per_value(b.table(spark, sf_dir, "customer"), rendered, number=fn.parse_unit_number("rendered"))


@query
def parse_inches(spark, sf_dir):
    rendered = "if(p_size % 9 = 0, '--', p_size || chr(34))"
    return _per_value(b.table(spark, sf_dir, "part"), rendered, inches=fn.parse_inches("rendered"))


@query
def nullify_sentinels(spark, sf_dir):
    rendered = "CASE o_orderstatus WHEN 'P' THEN '--' WHEN 'F' THEN if(o_custkey % 2 = 0, '---', '') ELSE o_orderpriority END"
    return _per_value(b.table(spark, sf_dir, "orders"), rendered, kept=fn.nullify_sentinels("rendered"))


@query
def split_location(spark, sf_dir):
    customers = b.table(spark, sf_dir, "customer")
    nations = b.table(spark, sf_dir, "nation").join(
        b.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    placed = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    rendered = """CASE c_custkey % 4 WHEN 0 THEN c_mktsegment || ', ' || n_name || ', ' || r_name
        WHEN 1 THEN n_name || ', ' || r_name WHEN 2 THEN r_name
        ELSE c_mktsegment || ', ' || n_name || ', ' || n_name || ', ' || r_name END"""
    place = fn.split_location("rendered")
    return _per_value(placed, rendered, city=place["city"], state=place["state"], country=place["country"])


@query
def split_full_name(spark, sf_dir):
    name = fn.split_full_name("rendered")
    rendered = "CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_name ELSE p_name || ' ' || p_type END"
    return _per_value(b.table(spark, sf_dir, "part"), rendered, first=name["first"], last=name["last"])


@query
def canonical_link(spark, sf_dir):
    links = b.table(spark, sf_dir, "pages")
    once = markup.canonical_link(F.col("url"))
    return links.select("page_id", once.alias("link"), markup.canonical_link(once).alias("link_again"))


@query
def surrogate_keys(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "if(o_orderstatus = 'P', NULL, o_orderpriority) AS optional"
    )
    return orders.select(
        "o_orderkey",
        fn.surrogate_key("o_orderkey").alias("order_sk"),
        fn.surrogate_key("o_orderkey", "optional", "o_custkey").alias("composite_sk"),
        fn.surrogate_key_or_null("optional").alias("optional_sk"),
    )


# --- generic operators ---------------------------------------------------------


@query
def latest_version(spark, sf_dir):
    events = b.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return latest_per_key(events, ["user_id"], "ts", ["event_id"]).drop("ts")


@query
def prior_averages(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "CAST(round(o_totalprice * 100) AS bigint) AS cents"
    )
    cents = F.col("cents")
    measures = {
        "prior_orders": prior_count(),
        "prior_open": prior_count(F.col("o_orderstatus") == "O"),
        "prior_cents": prior_sum(cents),
        "prior_avg_cents": prior_avg(cents),
        "prior_max_cents": prior_max(cents),
        "previous_cents": prior_last(cents, default=0),
    }
    return prior_measures(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], measures).drop(
        "o_orderdate", "o_orderstatus", "cents"
    )


@query
def select_window_topk(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CAST(o_orderdate AS date) AS ordered_on", "o_totalprice"
    )
    return select_window(orders, "ordered_on", dt.date(1995, 1, 1), dt.date(1997, 6, 30), 100, ["o_orderkey"])


@query
def select_events(spark, sf_dir):
    events = b.stg_events(spark, sf_dir).select("event_url", "event_name", "event_date")
    return serving.select_events(events, dt.date(2024, 1, 5), dt.date(2024, 1, 20))


@query
def paged_list(spark, sf_dir):
    customers = b.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return page_of(customers, ["c_custkey"], page=3)


@query
def point_lookup_customer(spark, sf_dir):
    return point_lookup(b.table(spark, sf_dir, "customer"), "c_custkey", 77)


@query
def high_watermark_increment(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    stored = events.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    new = since_watermark(events, stored, "ts")
    return new.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query
def resume_keys(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    landed = b.table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"))
    return todo(orders, landed, "o_orderkey")


@query
def freshness_of_events(spark, sf_dir):
    now = F.lit("2024-02-10 00:00:00").cast("timestamp_ntz")
    events = b.table(spark, sf_dir, "events")
    return freshness(events, "ts", now).select("age_days", "status")


# --- the pipeline -----------------------------------------------------------------


@query
def stage_bouts(spark, sf_dir):
    return b.stg_bouts(spark, sf_dir).drop("_ingested_at", "bout_at")


@query
def stage_events(spark, sf_dir):
    return b.stg_events(spark, sf_dir).drop("_ingested_at")


@query
def stage_fighters(spark, sf_dir):
    return b.stg_fighters(spark, sf_dir).drop("_ingested_at")


@query
def unpivot_pairs(spark, sf_dir):
    return b.profiled_bouts(spark, sf_dir).drop("bout_at")


@query
def distinct_fighters(spark, sf_dir):
    raw = b.raw_bouts(spark, sf_dir).withColumn("n", F.split_part("bout_url", F.lit("/"), F.lit(2)).cast("bigint"))
    return distinct_participants(raw, ["fighter_a_url", "fighter_b_url"], "fighter_url", "n")


@query
def career_to_date(spark, sf_dir):
    heavy = b.heavy_fighters(spark, sf_dir)
    return career.career_to_date(b.fighter_bouts(spark, sf_dir), b.ORDER, heavy=heavy)


@query
def career_to_date_sliced(spark, sf_dir):
    """The same features by the way a fighter with too many bouts for one task
    goes. Here it is taken by every fighter with more than one in 2,000 of all
    rows, which is at most 2,000 fighters, in slices of at most a 32nd."""
    return career.career_to_date(b.fighter_bouts(spark, sf_dir), b.ORDER, **_cut(spark, sf_dir))


def _cut(spark, sf_dir) -> dict:
    total = b.table(spark, sf_dir, "events").count()
    return {"heavy": b.heavy_fighters(spark, sf_dir, total // 2_000), "max_rows": min(MAX_ROWS_PER_TASK, total // 32)}


def _streak(spark, sf_dir, measure):
    rows = b.fighter_bouts(spark, sf_dir).select("bout_url", "fighter_url", "bout_at", "result")
    heavy = b.heavy_fighters(spark, sf_dir)
    return prior_measures(rows, career.ENTITY, b.ORDER, {"streak": measure}, heavy=heavy, costly=True).drop("bout_at")


@query
def win_streak(spark, sf_dir):
    return _streak(spark, sf_dir, career.win_streak())


@query
def win_streak_legacy(spark, sf_dir):
    return _streak(spark, sf_dir, career.win_streak_legacy())


def _features(spark, sf_dir, *names, legacy=False, cut=None):
    rows = b.fighter_bouts(spark, sf_dir)
    cut = cut or {"heavy": b.heavy_fighters(spark, sf_dir)}
    return features.fighter_features(rows, b.ORDER, legacy, **cut).select("bout_url", "fighter_url", *names)


@query
def prior_ratio(spark, sf_dir):
    return _features(spark, sf_dir, "strike_ratio", "takedown_ratio")


@query
def attached_features(spark, sf_dir):
    """Features computed apart, each over its own window, and joined together."""
    rows = written(b.fighter_bouts(spark, sf_dir), "fighter-bouts")
    heavy = b.heavy_fighters(spark, sf_dir)

    def alone(**measure):
        return prior_measures(rows, career.ENTITY, b.ORDER, measure, heavy=heavy)

    frames = {
        "num_bouts": alone(num_bouts=prior_count()),
        "win_streak": alone(win_streak=career.win_streak()),
        "strikes": alone(strikes=prior_sum(F.col("sig_strikes_landed"))),
    }
    base = rows.select("bout_url", "fighter_url")
    return attach_columns(base, ["bout_url", "fighter_url"], frames)


def _prior_rates(spark, sf_dir, cut=None):
    names = ("num_bouts", "win_percentage", "avg_fight_minutes", "finish_rate")
    return _rounded(_features(spark, sf_dir, *names, legacy=True, cut=cut), "avg_fight_minutes")


@query
def prior_rates(spark, sf_dir):
    return _prior_rates(spark, sf_dir)


@query
def prior_rates_sliced(spark, sf_dir):
    """The same as ``prior_rates`` by slices, cut as in ``career_to_date_sliced``."""
    return _prior_rates(spark, sf_dir, _cut(spark, sf_dir))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Ours are exact sums; those of the SQL they are held against depend on the order
    of addition in the last digits."""
    return df.withColumns({name: F.round(name, 9) for name in names})


@query
def control_share(spark, sf_dir):
    return _rounded(_features(spark, sf_dir, "control_share", "avg_control_share"), "control_share", "avg_control_share")


def _matrix(spark, sf_dir, cut=None, **options):
    cut = cut or {"heavy": b.heavy_fighters(spark, sf_dir)}
    matrix = features.feature_matrix(b.profiled_bouts(spark, sf_dir), b.ORDER, **cut, **options)
    means = ("avg_control_share", "avg_fight_minutes")
    return _rounded(matrix, *(f"{m}_{side}" for m in means for side in "ab"))


@query
def feature_matrix(spark, sf_dir):
    return _matrix(spark, sf_dir)


@query
def feature_matrix_sliced(spark, sf_dir):
    """The same as ``feature_matrix`` by slices, cut as in ``career_to_date_sliced``."""
    return _matrix(spark, sf_dir, _cut(spark, sf_dir))


@query
def feature_matrix_legacy(spark, sf_dir):
    matrix = _matrix(spark, sf_dir, legacy=True, include_current=True)
    return _rounded(matrix, "control_share_a", "control_share_b")


@query
def dim_event(spark, sf_dir):
    return marts.dim_event(b.stg_events(spark, sf_dir))


@query
def dim_fighter(spark, sf_dir):
    return marts.dim_fighter(b.stg_fighters(spark, sf_dir))


@query
def fct_bout(spark, sf_dir):
    return marts.fct_bout(b.stg_bouts(spark, sf_dir), b.stg_events(spark, sf_dir))


@query
def fct_fighter_bout(spark, sf_dir):
    """Some control times are missing in the bound data, so the not-null part of
    the contract is left to ``dq_not_null`` here."""
    return marts.fct_fighter_bout(b.profiled_bouts(spark, sf_dir), check_nulls=False)


@query
def fighter_list(spark, sf_dir):
    return serving.fighter_list(b.stg_fighters(spark, sf_dir), page=2)


@query
def fighter_lookup(spark, sf_dir):
    return serving.fighter_lookup(b.stg_fighters(spark, sf_dir), "fighter/7").drop("_ingested_at")


# --- data tests ----------------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    return checks.contract_nulls(marts.fct_fighter_bout(b.profiled_bouts(spark, sf_dir), check_nulls=False))


@query
def dq_unique(spark, sf_dir):
    return q.unique(b.table(spark, sf_dir, "orders"), "o_custkey")


@query
def dq_relationships(spark, sf_dir):
    return q.relationships(b.table(spark, sf_dir, "documents"), "doc_id", b.table(spark, sf_dir, "labels"), "doc_id")


@query
def dq_accepted_values(spark, sf_dir):
    return q.accepted_values(b.table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query
def dq_unique_combination(spark, sf_dir):
    return q.unique_combination(b.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_accepted_range(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return q.accepted_range(lines, "l_quantity", 2, 49)


@query
def dq_expression(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    return q.expression_is_true(lines, "l_tax > 0.01 OR l_discount < 0.09")


@query
def dq_sources(spark, sf_dir):
    rules = checks.source_rules(
        b.raw_events(spark, sf_dir), written(b.raw_bouts(spark, sf_dir), "raw-bouts"), b.raw_fighters(spark, sf_dir)
    )
    return q.rule_counts(rules)


@query
def dq_staging(spark, sf_dir):
    bouts = written(b.stg_bouts(spark, sf_dir), "stg-bouts")
    return q.rule_counts(checks.staging_rules(b.stg_events(spark, sf_dir), bouts, b.stg_fighters(spark, sf_dir)))


def _marts(spark, sf_dir):
    """The four marts, written, as they are when their tests run."""
    events = written(b.stg_events(spark, sf_dir), "stg-events")
    fighters = written(b.stg_fighters(spark, sf_dir), "stg-fighters")
    bouts = written(b.stg_bouts(spark, sf_dir), "stg-bouts")
    rows = b.participants.with_profile(b.participants.fighter_bouts(bouts, events), fighters)
    return (
        marts.dim_event(events),
        marts.dim_fighter(fighters),
        written(marts.fct_bout(bouts, events), "fct-bout"),
        written(marts.fct_fighter_bout(rows, check_nulls=False), "fct-fighter-bout"),
    )


@query
def dq_marts(spark, sf_dir):
    return q.rule_counts(checks.mart_rules(*_marts(spark, sf_dir)))


@query
def dq_pins(spark, sf_dir):
    """Ten bouts pinned as draws; those that are not, or are missing, come back."""
    expected = spark.createDataFrame([(f"bout/{2 * n}", True) for n in range(10)], "bout_url string, want boolean")
    bouts = b.stg_bouts(spark, sf_dir)
    facts = marts.fct_bout(bouts, b.stg_events(spark, sf_dir))
    return q.pinned_values(expected, ["bout_url"], facts, "is_draw", "want")


def _career_tables(spark, sf_dir):
    """Fighter bouts and career rows (with the order columns), written."""
    rows = written(b.fighter_bouts(spark, sf_dir), "fighter-bouts")
    heavy = b.heavy_fighters(spark, sf_dir)
    return rows, written(career.career_to_date(rows, b.ORDER, heavy=heavy, keep=["bout_at"]), "career")


@query
def dq_career(spark, sf_dir):
    _, model = _career_tables(spark, sf_dir)
    return q.rule_counts(checks.career_rules(model, b.ORDER))


def _checked(rows: DataFrame, rule: str, violations: DataFrame) -> DataFrame:
    """(rule, rows_checked, violations)."""
    seen = rows.agg(F.count(F.lit(1)).alias("rows_checked"), F.lit(0).cast("bigint").alias("violations"))
    bad = violations.agg(F.lit(0).cast("bigint").alias("rows_checked"), F.count(F.lit(1)).alias("violations"))
    both = seen.unionByName(bad)
    return both.agg(F.lit(rule).alias("rule"), *(F.sum(c).alias(c) for c in ("rows_checked", "violations")))


@query
def dq_leakage(spark, sf_dir):
    rows, model = _career_tables(spark, sf_dir)
    return _checked(model, "no_leakage", checks.leakage(model, rows, b.ORDER))


@query
def dq_leakage_found(spark, sf_dir):
    """What the leakage test says of totals that include the bout itself."""
    rows = written(b.fighter_bouts(spark, sf_dir), "fighter-bouts")
    won, seconds = (F.col("result") == "win").cast("int"), F.col("bout_duration_seconds")
    measures = {"n": prior_count(), "wins": prior_sum(won, default=0), "seconds": prior_sum(seconds, default=0)}
    right = prior_measures(rows, career.ENTITY, b.ORDER, measures, heavy=b.heavy_fighters(spark, sf_dir))
    leaky = right.withColumns(
        {"wins": F.col("wins") + F.coalesce(won, F.lit(0)), "seconds": F.col("seconds") + seconds}
    )
    totals = {"wins": won, "seconds": seconds}
    return q.no_leakage(leaky, rows, career.ENTITY, b.ORDER, "n", totals).drop("bout_at")


@query
def dq_streak_pins(spark, sf_dir):
    """Every fighter's first bout pinned: a streak of 0, wrongly 1 for corner b.
    The wrong pins come back."""
    rows, model = _career_tables(spark, sf_dir)
    first = latest_per_key(
        rows.withColumn("age", -F.unix_micros(F.col("bout_at").cast("timestamp"))), ["fighter_url"], "age", ["bout_url"]
    )
    want = F.when(F.col("corner") == "b", 1).otherwise(0)
    expected = first.select("bout_url", "fighter_url", want.alias("expected_streak"))
    return q.pinned_values(expected, ["bout_url", "fighter_url"], model, "prior_win_streak", "expected_streak")


@query
def dq_debut(spark, sf_dir):
    _, model = _career_tables(spark, sf_dir)
    return _checked(model, "debut_is_empty", checks.debuts(model))


@query
def dq_rise_by_one(spark, sf_dir):
    _, model = _career_tables(spark, sf_dir)
    heavy = b.heavy_fighters(spark, sf_dir)
    return _checked(model, "rises_by_one", checks.ordinals(model, b.ORDER, heavy))


# --- landing and loading ----------------------------------------------------------------


def _land_events(spark, sf_dir, root: str) -> None:
    """The events table as dated landing files, all text."""
    events = b.table(spark, sf_dir, "events")
    text = events.select(*(F.col(c).cast("string").alias(c) for c in events.columns))
    landing.write_landing(text, root, "events", on=F.col("ts").cast("date"))


def _loaded_events(spark, store: str) -> DataFrame:
    return load.read_raw(spark, store, "events").select("event_id", "user_id", "event_type", "value", "dt")


@query
def ingest_batch(spark, sf_dir):
    """Land, load, load again: every row once."""
    root, store = scratch_path(spark, "landing"), scratch_path(spark, "store")
    _land_events(spark, sf_dir, root)
    load.load_entity(spark, root, "events", store)
    load.load_entity(spark, root, "events", store)
    return _loaded_events(spark, store)


@query
def ingest_stream(spark, sf_dir):
    """The same with the streaming load."""
    root, store = scratch_path(spark, "landing"), scratch_path(spark, "store")
    checkpoint = scratch_path(spark, "progress")
    _land_events(spark, sf_dir, root)
    load_stream(spark, root, "events", store, checkpoint)
    load_stream(spark, root, "events", store, checkpoint)
    return _loaded_events(spark, store)


def _land_halves(spark, sf_dir, root: str, *parts: str) -> Iterator[None]:
    """The events table as text, landed by halves: after each the caller goes on."""
    events = b.table(spark, sf_dir, "events")
    text = events.select(*(F.col(c).cast("string").alias(c) for c in events.columns))
    for k, part in enumerate(parts):
        mine = text.filter(F.col("event_id").cast("bigint") % 2 == k)
        landing.write_landing(mine, root, "events", on=F.col("ts").cast("date"), part=part)
        yield


@query
def ingest_mixed(spark, sf_dir):
    """Half loaded in a batch, then all that lies there as a stream into the same
    store, then a batch again: every row once."""
    root, store = scratch_path(spark, "landing"), scratch_path(spark, "store")
    ways = (
        lambda: load.load_entity(spark, root, "events", store),
        lambda: load_stream(spark, root, "events", store, scratch_path(spark, "progress")),
    )
    for way, _ in zip(ways, _land_halves(spark, sf_dir, root, "even", "odd"), strict=False):
        way()
    ways[0]()
    return _loaded_events(spark, store)


@query
def ingest_new_checkpoint(spark, sf_dir):
    """Two streams with a checkpoint each take their part: nothing lost or doubled."""
    root, store = scratch_path(spark, "landing"), scratch_path(spark, "store")
    for _ in _land_halves(spark, sf_dir, root, "even", "odd"):
        load_stream(spark, root, "events", store, scratch_path(spark, "progress"))
    return _loaded_events(spark, store)


@query
def ingest_mixed_precision(spark, sf_dir):
    """Half of the files hold their time as plain microseconds, half as nanoseconds'
    whole number: both load together."""
    root, store = scratch_path(spark, "landing"), scratch_path(spark, "store")
    events = b.table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    text = events.select(F.col("event_id").cast("string").alias("event_id"), F.col("ts").alias("_day"), micros.alias("_us"))
    even = text.filter("CAST(event_id AS bigint) % 2 = 0").withColumn("_ingested_at", F.timestamp_micros("_us"))
    odd = text.filter("CAST(event_id AS bigint) % 2 = 1").withColumn("_ingested_at", F.col("_us") * 1000)
    for part, mine in (("us", even), ("ns", odd)):
        landing.write_landing(mine.drop("_us"), root, "events", on=F.col("_day").cast("date"), part=part)
    load.load_entity(spark, root, "events", store)
    rows = load.read_raw(spark, store, "events")
    return rows.select("event_id", F.unix_micros("_ingested_at").alias("us"), "dt")


def _land_awkward(spark, sf_dir, root: str) -> None:
    """A third of the events with their time in microseconds, a third in nanoseconds and numbers for
    ids, a third with a column the others lack; and all errors once more with a time that is none."""
    events = b.table(spark, sf_dir, "events")
    rows = events.selectExpr("event_id AS id", "event_type", "ts", "unix_micros(CAST(ts AS timestamp)) AS us")
    text = rows.withColumn("event_id", F.col("id").cast("string"))
    parts = {
        "micro": text.filter("id % 3 = 0").withColumn("_ingested_at", F.timestamp_micros("us")),
        "nano": rows.filter("id % 3 = 1").withColumns({"event_id": F.col("id"), "_ingested_at": F.col("us") * 1000}),
        "late": text.filter("id % 3 = 2").withColumns({"_ingested_at": F.timestamp_micros("us"), "note": F.col("event_type")}),
        "other": text.filter("event_type = 'error'").selectExpr("*", "'soon' AS _ingested_at", "'x' AS ghost"),
    }
    for part, mine in parts.items():
        kept = [c for c in ("event_id", "_ingested_at", "note", "ghost", "ts") if c in mine.columns]
        landing.write_landing(mine.select(*kept), root, "events", on=F.col("ts").cast("date"), part=part)


def _loaded_awkward(spark, store: str, failed: int) -> DataFrame:
    """All columns of the table, and whether the files without a time were set aside."""
    rows = load.read_raw(spark, store, "events").drop("ts")
    set_aside = load.read_failures(spark, store, "events").select("file_path").distinct().agg((F.count("*") == failed).alias("set_aside"))
    return rows.withColumn("us", F.unix_micros("_ingested_at")).drop("_ingested_at").join(F.broadcast(set_aside))


@query
def ingest_bad_file(spark, sf_dir):
    """Files the table cannot take do not hold up the others, and leave no column behind."""
    root, store = scratch_path(spark, "landing"), scratch_path(spark, "store")
    _land_awkward(spark, sf_dir, root)
    return _loaded_awkward(spark, store, load.load_entity(spark, root, "events", store).files_failed)


@query
def ingest_stream_mixed(spark, sf_dir):
    """The same in one run of a stream."""
    root, store = scratch_path(spark, "landing"), scratch_path(spark, "store")
    _land_awkward(spark, sf_dir, root)
    return _loaded_awkward(spark, store, load_stream(spark, root, "events", store, scratch_path(spark, "progress")).files_failed)


@query
def load_report(spark, sf_dir):
    """What three loads did: all files, none, and a late part of each day."""
    root, store = scratch_path(spark, "landing"), scratch_path(spark, "store")
    _land_events(spark, sf_dir, root)
    results = [load.load_entity(spark, root, "events", store) for _ in range(2)]
    late = b.table(spark, sf_dir, "events").filter("event_type = 'error'").selectExpr("CAST(event_id AS string) AS event_id", "ts")
    landing.write_landing(late.select("event_id", "ts"), root, "events", on=F.col("ts").cast("date"), part="late")
    results += load.load_all(spark, root, store, ("events",))
    files = results[0].files_loaded
    rows = [(n + 1, r.rows_loaded, r.files_loaded > 0, r.files_skipped == (files if n else 0)) for n, r in enumerate(results)]
    return spark.createDataFrame(rows, "run bigint, rows_loaded bigint, loaded_any boolean, skipped_the_rest boolean")


@query
def load_ledger(spark, sf_dir):
    """Rows logged per day."""
    root, store = scratch_path(spark, "landing"), scratch_path(spark, "store")
    _land_events(spark, sf_dir, root)
    load.load_entity(spark, root, "events", store)
    return load.read_ledger(spark, store, "events").groupBy("dt").agg(F.sum("row_count").alias("row_count"))


@query
def resume_landing(spark, sf_dir):
    """An interrupted run: what is left once a first part has landed."""
    root, day = scratch_path(spark, "landing"), dt.date(2024, 1, 1)
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    landing.write_landing(orders.filter("o_orderstatus <> 'O'"), root, "orders", on=day, part="00000")
    return todo(orders, landing.landed_keys(spark, root, "orders", "o_orderkey", day), "o_orderkey")


@query
def schema_evolution(spark, sf_dir):
    """A column that only later files have is NULL in older rows."""
    root, store = scratch_path(spark, "landing"), scratch_path(spark, "store")
    orders = b.table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS string) AS o_orderkey", "o_orderstatus", "o_orderpriority"
    )
    old, new = orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'")
    landing.write_landing(old.drop("o_orderpriority"), root, "orders", on=dt.date(2024, 1, 1))
    load.load_entity(spark, root, "orders", store)
    landing.write_landing(new, root, "orders", on=dt.date(2024, 1, 2))
    load.load_entity(spark, root, "orders", store)
    return load.read_raw(spark, store, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "dt")


@query
def stamp_lineage(spark, sf_dir):
    events = b.table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS string) AS event_id", "event_type", "if(event_type = 'error', NULL, props) AS props"
    )
    stamped = landing.stamp_lineage(events, F.concat(F.lit("event/"), "event_id"), landing.new_batch_id())
    return stamped.select(
        "event_id",
        "_source_url",
        "_raw_payload",
        (F.length("_batch_id") == 32).alias("has_batch"),
        F.col("_ingested_at").isNotNull().alias("has_time"),
    )


# --- layers, seeds, SQL ------------------------------------------------------------------


@query
def published_marts(spark, sf_dir):
    """Bouts and events published as tables bucketed by the event; the fact is built from the two
    without a shuffle, published and read back by name."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frames = {"stg_bouts": b.stg_bouts(spark, sf_dir), "stg_events": b.stg_events(spark, sf_dir)}
    for name, frame in frames.items():
        place = catalog.own_place(spark, "staging", name)
        catalog.publish(frame, "staging", name, bucket_by=("event_url",), buckets=buckets, at=place)
    facts = marts.fct_bout(spark.table("staging.stg_bouts"), spark.table("staging.stg_events"))
    catalog.publish(facts, "marts", "fct_bout", at=catalog.own_place(spark, "marts", "fct_bout"))
    return written(spark.table("marts.fct_bout"), "read-back")


@query
def empty_from_sample(spark, sf_dir):
    """A table made from a sample's columns: empty at first, and not emptied when asked for again."""
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    spark.sql("DROP TABLE IF EXISTS raw.sampled_orders")
    place = catalog.own_place(spark, "raw", "sampled_orders")
    before = catalog.ensure_table(orders, "raw", "sampled_orders", at=place).count()
    orders.filter("o_orderstatus = 'P'").write.insertInto("raw.sampled_orders")
    return written(catalog.ensure_table(orders, "raw", "sampled_orders").withColumn("rows_before", F.lit(before)), "read-back")


@query
def layers_by_name(spark, sf_dir):
    """Raw table, staging view and mart, each in its database and read by name in SQL only."""
    raw = b.raw_events(spark, sf_dir).withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp"))
    again = raw.withColumns({"event_name": F.lit("older"), "_ingested_at": F.col("_ingested_at") - F.expr("INTERVAL 1 HOUR")})
    catalog.publish(raw.unionByName(again), "raw", "events", at=catalog.own_place(spark, "raw", "events"))
    catalog.create_layers(spark)
    fn_sql.register_sql_functions(spark, "staging")
    catalog.publish_view(
        spark,
        "staging",
        "events",
        """SELECT event_url, event_name, staging.parse_long_date(event_date) AS event_date, event_location FROM (
            SELECT *, row_number() OVER (PARTITION BY event_url ORDER BY _ingested_at DESC) AS nth FROM raw.events) WHERE nth = 1""",
    )
    spark.sql("DROP TABLE IF EXISTS marts.dim_day")
    spark.sql(
        f"""CREATE TABLE marts.dim_day USING parquet LOCATION '{catalog.own_place(spark, "marts", "dim_day")}' AS
        SELECT md5(event_url) AS event_sk, event_url, event_name, event_date FROM staging.events"""
    )
    return written(spark.sql("SELECT event_sk, event_url, event_name, event_date FROM marts.dim_day"), "read-back")


@query
def seed_typed(spark, sf_dir):
    """Orders as a text seed, those of one status with a price that is no number and those of one priority
    with a day that is none: what is read with the declared types, and the lines set aside."""
    at = scratch_path(spark, "seed")
    text = b.table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS string) AS o_orderkey",
        "if(o_orderstatus = 'P', 'n/a', CAST(CAST(o_totalprice AS decimal(20,2)) AS string)) AS price",
        "if(o_orderkey % 2 = 0, 'say \"so\", then', NULL) AS note",
        "if(o_orderpriority = '1-URGENT', 'soon', CAST(CAST(o_orderdate AS date) AS string)) AS ordered_on",
    )
    text.write.option("header", "true").option("escape", '"').csv(at)
    rows, aside = seeds.read_seed_checked(spark, at, "o_orderkey BIGINT, price DECIMAL(20,2), note STRING, ordered_on DATE")
    good = rows.groupBy("note").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"), F.max("ordered_on").alias("newest"))
    lost = aside.agg(F.lit("set aside").alias("note"), F.count(F.lit(1)).alias("n"))
    return good.unionByName(lost, allowMissingColumns=True)


@query
def sql_parsers(spark, sf_dir):
    """The parsers, called in SQL."""
    fn_sql.register_sql_functions(spark)
    b.table(spark, sf_dir, "lineitem").createOrReplaceTempView("sql_lines")
    return spark.sql(
        """SELECT rendered, n, parse_landed(rendered) AS landed, parse_attempted(rendered) AS attempted,
            parse_mmss_seconds(replace(rendered, ' of ', ':')) AS seconds, parse_percentage(share) AS share
        FROM (SELECT if(l_linenumber = 7, '---', CAST(l_quantity AS int) || ' of ' || l_linenumber) AS rendered,
                if(l_tax = 0, '--', CAST(round(l_discount * 100) AS int) || '%') AS share, count(*) AS n
              FROM sql_lines GROUP BY ALL)"""
    )


@query
def sql_latest(spark, sf_dir):
    """Each user's latest event, and that as of some day, by a table function."""
    b.table(spark, sf_dir, "events").createOrReplaceTempView("sql_events")
    fn_sql.register_latest(spark, "latest_events", "sql_events", ["user_id"], "ts", ["event_id"])
    return spark.sql(
        """SELECT 'now' AS as_of, user_id, event_id, event_type FROM latest_events()
        UNION ALL
        SELECT 'then', user_id, event_id, event_type FROM latest_events(TIMESTAMP_NTZ '2024-01-10 12:00:00')"""
    )


@query
def sql_unpivot(spark, sf_dir):
    """Both sides of each bout, by a table function."""
    b.stg_bouts(spark, sf_dir).select(
        "bout_url", "fighter_a_url", "fighter_b_url", "fighter_a_knockdowns", "fighter_b_knockdowns"
    ).createOrReplaceTempView("sql_bouts")
    sides = {"fighter_url": "fighter_{side}_url", "knockdowns": "fighter_{side}_knockdowns"}
    fn_sql.register_unpivot(spark, "sides", "sql_bouts", ["bout_url"], sides, {"opponent_url": "fighter_{side}_url"})
    return spark.sql("SELECT bout_url, corner, fighter_url, opponent_url, knockdowns FROM sides()")


# --- web pages ----------------------------------------------------------------------------


@query
def pages_triage(spark, sf_dir):
    pages = b.table(spark, sf_dir, "pages")
    real, interstitial = pg.drop_interstitials(pages, marker='<html lang="de">')
    none_left, challenges = pg.drop_interstitials(real)
    return (
        none_left.select("page_id", F.lit("real").alias("kind"))
        .unionByName(interstitial.select("page_id", F.lit("interstitial").alias("kind")))
        .unionByName(challenges.select("page_id", F.lit("challenge").alias("kind")))
    )


@query
def pages_links(spark, sf_dir):
    return pg.parse_links(b.table(spark, sf_dir, "pages"))


@query
def pages_headings(spark, sf_dir):
    return pg.parse_elements(b.table(spark, sf_dir, "pages"), "h1")


@query
def pages_paragraphs(spark, sf_dir):
    return pg.parse_elements(b.table(spark, sf_dir, "pages"), "p")


@query
def pages_listing(spark, sf_dir):
    records, _ = pg.extract_listing(bp.listing_pages(spark, sf_dir))
    return records.drop("url", "position")


@query
def pages_card(spark, sf_dir):
    records, _ = pg.extract_card(bp.card_pages(spark, sf_dir))
    return records.drop("url", "position")


@query
def pages_card_quarantine(spark, sf_dir):
    _, quarantine = pg.extract_card(bp.card_pages(spark, sf_dir, broken=True))
    return quarantine


@query
def pages_box(spark, sf_dir):
    records, _ = pg.extract_box_score(bp.box_score_pages(spark, sf_dir))
    return records


@query
def pages_quarantine(spark, sf_dir):
    parsed = pg.parse_box_score(bp.box_score_pages(spark, sf_dir, broken=True))
    return parsed.select("url", "status", "reason")


@query
def pages_profile(spark, sf_dir):
    records, _ = pg.extract_profile(bp.profile_pages(spark, sf_dir))
    return records.drop("profile_json")


@query
def pages_index(spark, sf_dir):
    records, _ = pg.extract_index(bp.index_pages(spark, sf_dir))
    return records.drop("url", "position")


@query
def pages_skipped(spark, sf_dir):
    """Listing and index pages, and rows of them, that gave nothing, with the reason."""
    listing = pg.skipped(pg.parse_listing(bp.listing_pages(spark, sf_dir, per_page=1, gaps=True)))
    return listing.unionByName(pg.skipped(pg.parse_index(bp.index_pages(spark, sf_dir, gaps=True))))


@query
def pages_irregular(spark, sf_dir):
    """Box scores in irregular markup give what regular ones do."""
    records, _ = pg.extract_box_score(bp.irregular(bp.box_score_pages(spark, sf_dir)))
    return records


@query
def pages_irregular_index(spark, sf_dir):
    records, _ = pg.extract_index(bp.irregular(bp.index_pages(spark, sf_dir)))
    return records.drop("url", "position")


@query
def pages_references(spark, sf_dir):
    """Character references by name and number are read back."""
    return pg.parse_elements(bp.reference_pages(spark, sf_dir), "p").drop("position")


@query
def bronze_events(spark, sf_dir):
    records, _ = bronze.bronze_events(bp.listing_pages(spark, sf_dir), landing.new_batch_id())
    return records.drop("_batch_id", "_ingested_at", "_raw_payload")


@query
def bronze_bouts(spark, sf_dir):
    """Cards and box scores together, as the raw layer has them. The pages are
    written first, as a crawl would have left them."""
    cards = written(bp.card_pages(spark, sf_dir), "cards")
    boxes = written(bp.box_score_pages(spark, sf_dir, broken=True), "boxes")
    records, _ = bronze.bronze_bouts(cards, boxes, landing.new_batch_id())
    return records.drop("_batch_id", "_ingested_at", "_raw_payload")


@query
def bronze_fighters(spark, sf_dir):
    records, _ = bronze.bronze_fighters(bp.profile_pages(spark, sf_dir), landing.new_batch_id())
    return records.drop("_batch_id", "_ingested_at", "_raw_payload")
