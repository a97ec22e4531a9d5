"""Typed text seeds: CSV with every column declared, nothing inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The columns of the raw layer.

_LINEAGE = "_source_url STRING, _batch_id STRING, _ingested_at TIMESTAMP"

_SIDED = ", ".join(
    f"fighter_{side}_{name} STRING"
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

SEED_DDL = {
    "events": f"event_url STRING, event_name STRING, event_date STRING, event_location STRING, {_LINEAGE}",
    "bouts": f"""{_SIDED}, bout_url STRING, event_url STRING, fighter_a_url STRING, fighter_b_url STRING,
        winner_name STRING, result STRING, weight_class STRING, method STRING, finish_round STRING,
        finish_time STRING, {_LINEAGE}""",
    "fighters": f"""fighter_url STRING, fighter_name STRING, first_name STRING, last_name STRING, height STRING,
        weight STRING, reach STRING, stance STRING, dob STRING, sig_strikes_landed_per_min STRING,
        sig_strike_accuracy STRING, sig_strikes_absorbed_per_min STRING, sig_strike_defense STRING,
        takedown_average STRING, takedown_accuracy STRING, takedown_defense STRING,
        submission_average STRING, {_LINEAGE}""",
}


_CORRUPT = "_corrupt_line"


def read_seed(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A CSV with a header, read with the declared types. Quotes inside quoted
    values are doubled, as in RFC 4180. Rows that do not fit are left out, see
    :func:`read_seed_checked`."""
    return read_seed_checked(spark, path, ddl)[0]


def read_seed_checked(spark: SparkSession, path: str, ddl: str) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine): a line with a value its column cannot take, or with too many or too
    few values, goes to quarantine as it is (``line``, ``file_path``) instead of losing values."""
    declared = StructType.fromDDL(ddl)
    lines = (
        spark.read.schema(StructType([*declared, StructField(_CORRUPT, StringType())]))
        .option("header", "true")
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnPruning", "false")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
    )
    bad = F.col(_CORRUPT).isNotNull()
    # Values are only looked at where their columns are asked for; this asks for all and lets all pass.
    parsed = F.concat_ws("", *(F.col(f"`{f.name}`").cast("string") for f in declared)) >= ""
    quarantine = lines.filter(bad & parsed).select(F.col(_CORRUPT).alias("line"), F.col("_metadata.file_path").alias("file_path"))
    return lines.filter(~bad & parsed).drop(_CORRUPT), quarantine
