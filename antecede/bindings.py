"""The given tables, bound to the raw layer's shape.

``events`` rows are paired by position (ids 2k and 2k+1; pairs of one user drop
out) into two-sided bouts, rendered as text the way a site would print them.
Days of ``ts`` become event cards and users become fighters. Every row of
``events`` takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from antecede.operators.prior import MAX_ROWS_PER_TASK, Heavy, heavy_keys
from antecede.operators.sides import pivot_sides
from antecede.plans import participants, staging

# The window order of the binding: a user has several bouts a day.
ORDER = ["bout_at", "bout_url"]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once: a query that uses
    the table several times needs no job each time to find it again."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring events side by side: one scan, one shuffle on the pair."""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id div 2 AS pair",
        "if(event_id % 2 = 0, 'a', 'b') AS side",
        "user_id AS user",
        "event_type AS kind",
        "value",
        "ts",
    )
    both = pivot_sides(events, ["pair"], "side", ["user", "kind", "value", "ts"])
    return both.filter("user_a <> user_b")


def raw_bouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bouts, all text. Every twentieth id has an older version too."""
    base = pairs(spark, sf_dir).selectExpr(
        "pair * 2 AS id",
        "ts_a AS ts",
        "user_a AS ua",
        "user_b AS ub",
        "CAST(floor(value_a) AS int) AS aa",
        "CAST(floor(value_b) AS int) AS ab",
        "CAST(1 + (pair * 14) % 299 AS int) AS t",
        """CASE WHEN kind_a = 'error' AND kind_b = 'error' THEN 'nc'
                WHEN kind_a = kind_b THEN 'draw' ELSE 'win' END AS outcome""",
        "value_a >= value_b AS a_better",
        "if(value_a >= value_b, kind_a, kind_b) AS winning_kind",
    )
    counted = base.selectExpr(
        "*",
        "CAST(floor(aa * (id % 4) / 4) AS int) AS la",
        "CAST(floor(ab * (id % 3) / 3) AS int) AS lb",
        "ua % 4 AS td_a",
        "ub % 4 AS td_b",
        "if(id % 3 = 0, ua % 4, 0) AS got_a",
        "if(id % 7 = 0, ub % 4, 0) AS got_b",
        "explode(if(id % 20 = 0, array(0, 1), array(0))) AS version",
    )
    return counted.selectExpr(
        "'Name ' || ua AS fighter_a_name",
        "'Name ' || ub AS fighter_b_name",
        "CAST(id % 3 AS string) AS fighter_a_knockdowns",
        "CAST(ub % 2 AS string) AS fighter_b_knockdowns",
        "la || ' of ' || aa AS fighter_a_sig_strikes",
        "lb || ' of ' || ab AS fighter_b_sig_strikes",
        "CASE WHEN aa = 0 THEN '---' ELSE (la * 100 div aa) || '%' END AS fighter_a_sig_strike_acc",
        "CASE WHEN ab = 0 THEN '---' ELSE (lb * 100 div ab) || '%' END AS fighter_b_sig_strike_acc",
        "(la + id % 5) || ' of ' || (aa + id % 5) AS fighter_a_total_strikes",
        "(lb + id % 6) || ' of ' || (ab + id % 6) AS fighter_b_total_strikes",
        "got_a || ' of ' || td_a AS fighter_a_takedowns",
        "got_b || ' of ' || td_b AS fighter_b_takedowns",
        "CASE WHEN td_a = 0 THEN '---' ELSE (got_a * 100 div td_a) || '%' END AS fighter_a_takedown_acc",
        "CASE WHEN td_b = 0 THEN '---' ELSE (got_b * 100 div td_b) || '%' END AS fighter_b_takedown_acc",
        "CAST(id % 4 AS string) AS fighter_a_sub_attempts",
        "CAST(ub % 3 AS string) AS fighter_b_sub_attempts",
        "CAST(ua % 2 AS string) AS fighter_a_reversals",
        "CAST(ub % 2 AS string) AS fighter_b_reversals",
        "'0:' || lpad(CAST(t % 30 AS string), 2, '0') AS fighter_a_control_time",
        "CASE WHEN id % 11 = 0 THEN '--' ELSE '0:00' END AS fighter_b_control_time",
        "'bout/' || id AS bout_url",
        "'event/' || CAST(ts AS date) AS event_url",
        "'fighter/' || ua AS fighter_a_url",
        "'fighter/' || ub AS fighter_b_url",
        """CASE WHEN outcome <> 'win' THEN outcome WHEN a_better THEN 'Name ' || ua
                ELSE 'Name ' || ub END AS winner_name""",
        "CASE WHEN id % 10 <> 0 OR outcome = 'draw' THEN outcome END AS result",
        "'Class ' || ua % 5 AS weight_class",
        """CASE WHEN outcome = 'nc' OR version = 1 THEN 'Overturned'
                WHEN outcome = 'draw' THEN 'Decision - Split'
                WHEN winning_kind = 'purchase' THEN 'KO/TKO'
                WHEN winning_kind = 'click' THEN 'Submission'
                WHEN winning_kind = 'view' THEN 'Decision - Unanimous'
                WHEN winning_kind = 'signup' THEN 'TKO - Doctor\\'s Stoppage'
                ELSE 'DQ' END AS method""",
        "CAST(1 + id % 5 AS string) AS finish_round",
        "(t div 60) || ':' || lpad(CAST(t % 60 AS string), 2, '0') AS finish_time",
        "ts AS bout_at",
        "ts - make_dt_interval(version) AS _ingested_at",
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One card per day."""
    day = table(spark, sf_dir, "events").selectExpr("CAST(ts AS date) AS d").distinct()
    return day.selectExpr(
        "'event/' || d AS event_url",
        "'Card ' || d AS event_name",
        "date_format(d, 'MMMM dd, yyyy') AS event_date",
        """CASE day(d) % 3 WHEN 0 THEN 'Las Vegas, Nevada, USA' WHEN 1 THEN 'Shanghai, China'
                ELSE 'Singapore' END AS event_location""",
        "CAST(d AS timestamp_ntz) AS _ingested_at",
    )


def raw_fighters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile per user, with the gaps a site has."""
    user = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("u")).agg(F.max("ts").alias("_ingested_at"))
    return user.selectExpr(
        "'fighter/' || u AS fighter_url",
        "'Name ' || u AS fighter_name",
        "'Name' AS first_name",
        "if(u % 13 = 0, '', CAST(u AS string)) AS last_name",
        "if(u % 9 = 0, '--', (5 + u % 2) || chr(39) || ' ' || (u % 12) || chr(34)) AS height",
        "if(u % 8 = 0, '--', (115 + u % 100) || ' lbs.') AS weight",
        "if(u % 7 = 0, '--', (60 + u % 20) || chr(34)) AS reach",
        "CASE u % 4 WHEN 0 THEN 'Orthodox' WHEN 1 THEN 'Southpaw' WHEN 2 THEN 'Switch' ELSE '' END AS stance",
        "if(u % 10 = 0, '--', date_format(date_add(DATE '1970-01-01', CAST(u * 37 AS int)), 'MMM dd, yyyy')) AS dob",
        "(u % 7) || '.' || lpad(CAST(u % 100 AS string), 2, '0') AS sig_strikes_landed_per_min",
        "(u % 101) || '%' AS sig_strike_accuracy",
        "(u % 5) || '.' || lpad(CAST(u % 100 AS string), 2, '0') AS sig_strikes_absorbed_per_min",
        "(u % 97) || '%' AS sig_strike_defense",
        "(u % 4) || '.' || lpad(CAST(u % 100 AS string), 2, '0') AS takedown_average",
        "(u % 89) || '%' AS takedown_accuracy",
        "(u % 83) || '%' AS takedown_defense",
        "(u % 3) || '.' || lpad(CAST(u % 100 AS string), 2, '0') AS submission_average",
        "_ingested_at",
    )


def stg_bouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_bouts(raw_bouts(spark, sf_dir), keep=["bout_at"])


def stg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_events(raw_events(spark, sf_dir))


def stg_fighters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_fighters(raw_fighters(spark, sf_dir))


def fighter_bouts(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("bout_at",)) -> DataFrame:
    return participants.fighter_bouts(stg_bouts(spark, sf_dir), stg_events(spark, sf_dir), keep=keep)


def profiled_bouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fighter_bouts(spark, sf_dir, keep=("bout_at", "weight_class"))
    return participants.with_profile(rows, stg_fighters(spark, sf_dir))


def heavy_fighters(spark: SparkSession, sf_dir: str, max_rows: int = MAX_ROWS_PER_TASK) -> Heavy:
    """Fighters with too many bouts for one task, counted on the one column of
    ``events`` that decides it. A user has at most as many bouts as events, so
    the count is an upper bound."""
    users = table(spark, sf_dir, "events").selectExpr("'fighter/' || user_id AS fighter_url")
    return heavy_keys(users, ["fighter_url"], max_rows)
