"""Strictly-prior measures against a loop over sorted rows, both ways."""

import random

import pytest
from pyspark.sql import functions as F

from antecede.operators import (
    heavy_keys,
    prior_avg,
    prior_count,
    prior_last,
    prior_max,
    prior_measures,
    prior_streak,
    prior_sum,
)

SCHEMA = "k string, t int, id int, x int, kind string"


def measures():
    return {
        "n": prior_count(),
        "wins": prior_count(F.col("kind") == "win"),
        "total": prior_sum(F.col("x")),
        "total0": prior_sum(F.col("x"), default=0),
        "mean": prior_avg(F.col("x")),
        "top": prior_max(F.col("x")),
        "last": prior_last(F.col("x")),
        "streak": prior_streak(F.col("kind") == "win", F.col("kind").isin("loss", "draw")),
        "strict_streak": prior_streak(F.col("kind") == "win", F.col("kind") != "win"),
    }


def expected(rows):
    """The same by brute force: every earlier row of every row."""
    out = {}
    for k, t, i, _, _ in rows:
        before = sorted((r for r in rows if r[0] == k and (r[1], r[2]) < (t, i)), key=lambda r: (r[1], r[2]))
        xs = [r[3] for r in before if r[3] is not None]
        streak = strict = 0
        for r in before:
            if r[4] == "win":
                streak, strict = streak + 1, strict + 1
            else:
                strict = 0
                streak = 0 if r[4] in ("loss", "draw") else streak
        out[i] = (
            len(before),
            sum(r[4] == "win" for r in before),
            sum(xs) if xs else None,
            sum(xs),
            sum(xs) / len(xs) if xs else None,
            max(xs) if xs else None,
            before[-1][3] if before else None,
            streak,
            strict,
        )
    return out


def fixture(seed, n=400, hot_share=1 / 3):
    """Rows with one key holding a third of them, ties in time, NULL values and
    one NULL key."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot_share else rng.choice(["a", "b", "c", "d", None])
        rows.append(
            (
                key,
                rng.randrange(40),
                i,
                rng.choice([None, *range(-5, 20)]),
                rng.choice(["win", "win", "win", "loss", "draw", "nc"]),
            )
        )
    return rows


def got(df):
    names = list(measures())
    return {r["id"]: tuple(r[name] for name in names) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("max_rows", [10**6, 90, 11])
def test_against_brute_force(spark, seed, max_rows):
    rows = fixture(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    result = prior_measures(df, ["k"], ["t", "id"], measures(), max_rows=max_rows)
    assert result.columns == df.columns + list(measures())
    assert got(result) == expected(rows)


def test_one_key_holds_everything_at_one_moment(spark):
    rows = [("hot", 5, i, i % 7, "win" if i % 5 else "loss") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(prior_measures(df, ["k"], ["t", "id"], measures(), max_rows=20)) == expected(rows)


def test_heavy_list_may_be_given_and_generous(spark):
    rows = fixture(3)
    df = spark.createDataFrame(rows, SCHEMA)
    heavy = heavy_keys(df.unionByName(df), ["k"], 100)
    assert {r["k"] for r in heavy.table.collect()} >= {"hot"}
    assert got(prior_measures(df, ["k"], ["t", "id"], measures(), heavy=heavy, max_rows=30)) == expected(rows)
    assert got(prior_measures(df, ["k"], ["t", "id"], measures(), heavy=[])) == expected(rows)


def test_composite_entity(spark):
    rows = fixture(4, n=150)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("half", F.col("id") % 2)
    plain = prior_measures(df, ["k", "half"], ["t", "id"], measures(), heavy=[])
    sliced = prior_measures(df, ["k", "half"], ["t", "id"], measures(), max_rows=8)
    assert got(plain) == got(sliced)


def test_heavy_tasks_are_bounded(spark):
    """The hot key's rows are spread over slices of about max_rows."""
    rows = [("hot", i, i, 1, "win") for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    cut = df.repartitionByRange(10, "k", "t", "id").groupBy(F.spark_partition_id().alias("p")).count()
    sizes = [r["count"] for r in cut.collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * 400


def test_plain_plan_has_one_exchange_and_one_sort(spark):
    df = spark.range(100).selectExpr("CAST(id % 5 AS string) AS k", "CAST(id AS int) AS t", "CAST(id AS int) AS id",
                                     "1 AS x", "'win' AS kind")
    result = prior_measures(df, ["k"], ["t", "id"], measures(), heavy=[])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_sums_and_means_of_doubles_do_not_depend_on_the_cut(spark):
    rng = random.Random(12)
    rows = [(k % 3, k, rng.choice([0.1, 1 / 3, 1e-7, 123.456]) * rng.random()) for k in range(3000)]
    df = spark.createDataFrame(rows, "who int, at int, x double")
    measures = {"mean": prior_avg(F.col("x")), "total": prior_sum(F.col("x"))}
    plain = prior_measures(df, ["who"], ["at"], measures, heavy=[])
    sliced = prior_measures(df, ["who"], ["at"], measures, max_rows=150)
    assert dict(plain.dtypes)["total"] == "double"
    assert {tuple(r) for r in plain.collect()} == {tuple(r) for r in sliced.collect()}
