"""Data tests find what they should, and nothing else."""

import random

import pytest
from pyspark.sql import functions as F

from antecede.operators import prior_count, prior_measures, prior_streak, prior_sum
from antecede.operators import quality as q


@pytest.fixture(scope="module")
def things(spark):
    rows = [(1, "a", 5, 10), (2, "b", 7, 6), (2, "x", None, 3), (None, None, 1, 2), (None, "a", 0, 0)]
    return spark.createDataFrame(rows, "id int, kind string, got int, tried int")


def test_generic_tests(things, spark):
    assert q.not_null(things, "id", "kind").count() == 2
    assert {r["column"]: r["n"] for r in q.null_counts(things, ["id", "kind", "tried"]).collect()} == {
        "id": 2,
        "kind": 1,
        "tried": 0,
    }
    assert [tuple(r) for r in q.unique(things, "id").collect()] == [(2, 2)]
    assert {(r.id, r.n) for r in q.unique_combination(things, ["id"]).collect()} == {(2, 2), (None, 2)}
    assert [tuple(r) for r in q.accepted_values(things, "kind", ["a", "b"]).collect()] == [("x", 1)]
    assert q.accepted_range(things, "got", 1, 5).count() == 2
    assert q.expression_is_true(things, "got <= tried").count() == 1
    assert q.at_most(things, [("got", "tried")]).count() == 1
    parents = spark.createDataFrame([(1,), (9,), (None,)], "pid int")
    assert [tuple(r) for r in q.relationships(things, "id", parents, "pid").collect()] == [(2, 2)]


def test_row_rules_count_in_one_pass(things):
    rules = {
        "rows": q.RowRules(things, {"missing": q.is_missing("id"), "odd": q.is_outside("kind", ["a", "b"])}),
        "dup": q.unique(things, "id"),
        "over": q.at_most(things, [("got", "tried")]),
    }
    counts = {r.rule: r.violations for r in q.rule_counts(rules).collect()}
    assert counts == {"missing": 2, "odd": 1, "dup": 2, "over": 1}


def test_parents_and_children(spark):
    parents = spark.createDataFrame([("p", 10), ("q", 10), ("r", 10)], "k string, most int")
    children = spark.createDataFrame([("p", 5), ("p", 50), ("q", 1)], "k string, v int")
    assert {(r.k, r.children) for r in q.children_per_parent(parents, "k", children, "k", 2).collect()} == {("q", 1), ("r", 0)}
    assert [r.v for r in q.within_parent(children, "k", parents, "v", "most").collect()] == [50]


def test_pins_fail_on_missing_rows_too(spark):
    model = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    expected = spark.createDataFrame([("a", 1), ("b", 3), ("c", 4)], "k string, want int")
    assert {r.k for r in q.pinned_values(expected, ["k"], model, "v", "want").collect()} == {"b", "c"}


def test_member_or_null(spark):
    df = spark.createDataFrame([("a", "a", "b"), ("c", "a", "b"), (None, "a", "b")], "w string, x string, y string")
    assert [r.w for r in q.member_or_null(df, "w", ["x", "y"]).collect()] == ["c"]


# --- leakage: every kind of wrong frame is found ---------------------------------


def facts(spark, seed=0):
    rng = random.Random(seed)
    rows = [
        (rng.choice("hhhhabc"), t, rng.choice(["win", "win", "loss", "draw", "nc"]), rng.randrange(1, 300))
        for t in range(240)
    ]
    return spark.createDataFrame(rows, "k string, t int, result string, seconds int"), rows


def win():
    return F.col("result") == "win"


def model_of(df):
    measures = {
        "n": prior_count(),
        "wins": prior_count(win()),
        "seconds_before": prior_sum(F.col("seconds"), default=0),
        "streak": prior_streak(win(), F.col("result").isin("loss", "draw")),
    }
    return prior_measures(df, ["k"], ["t"], measures).select("k", "t", *measures)


def leaks(model, df, **options):
    return q.no_leakage(
        model,
        df,
        ["k"],
        ["t"],
        "n",
        totals={"wins": win().cast("int"), "seconds_before": F.col("seconds")},
        streaks={"streak": (win(), F.col("result").isin("loss", "draw"))},
        **options,
    )


def wrong_by_brute_force(model, rows):
    """Does any row disagree with a recomputation from all earlier rows?"""
    for r in model.collect():
        before = sorted((x for x in rows if x[0] == r.k and x[1] < r.t), key=lambda x: x[1])
        streak = 0
        for x in before:
            streak = streak + 1 if x[2] == "win" else 0 if x[2] in ("loss", "draw") else streak
        if (r.n, r.wins, r.seconds_before, r.streak) != (
            len(before),
            sum(x[2] == "win" for x in before),
            sum(x[3] for x in before),
            streak,
        ):
            return True
    return False


def test_a_right_model_passes(spark):
    df, rows = facts(spark)
    model = model_of(df)
    assert not wrong_by_brute_force(model, rows)
    assert leaks(model, df).count() == 0
    for n in (1, 2, 7):  # neighbours in different blocks
        assert leaks(model, df, block_rows=n).count() == 0


BREAKS = {
    "current row included": lambda m: m.withColumn("n", F.col("n") + 1),
    "one total off": lambda m: m.withColumn("wins", F.when(F.col("t") == 100, F.col("wins") + 1).otherwise(F.col("wins"))),
    "sum off by one second": lambda m: m.withColumn(
        "seconds_before", F.when(F.col("t") > 100, F.col("seconds_before") + 1).otherwise(F.col("seconds_before"))
    ),
    "constant": lambda m: m.withColumn("wins", F.lit(0).cast("bigint")),
    "streak never ends": lambda m: m.withColumn("streak", F.col("wins")),
    "row repeated": lambda m: m.unionByName(m.filter("t = 100")),
    "ordinals out of order": lambda m: m.withColumn("n", F.count(F.lit(1)).over(_window()) - F.col("n") - 1),
    "null total": lambda m: m.withColumn("streak", F.when(F.col("t") != 100, F.col("streak"))),
}


def _window():
    from pyspark.sql import Window

    return Window.partitionBy("k")


@pytest.mark.parametrize("name", BREAKS)
def test_a_wrong_model_fails(spark, name):
    df, rows = facts(spark)
    broken = BREAKS[name](model_of(df))
    if name != "row repeated":
        assert wrong_by_brute_force(broken, rows)
    assert leaks(broken, df).count() > 0
    assert leaks(broken, df, block_rows=3).count() > 0


def test_rows_without_fact_or_ordinal_fail(spark):
    df, _ = facts(spark)
    model = model_of(df)
    gone = df.filter(F.col("t") != 100)
    lost = model.join(gone, ["k", "t"], "left_anti").count()
    assert lost > 0 and leaks(model, gone).count() >= lost
    nothing = model.withColumn("n", F.when(F.col("t") != 100, F.col("n")))
    assert {r["t"] for r in leaks(nothing, df).where("n IS NULL").collect()} == {100}
    unnamed = df.withColumn("k", F.when(F.col("k") != df.first()["k"], F.col("k")))  # one entity has no key
    assert leaks(model_of(unnamed), unnamed).count() == 0


def test_leakage_plan_sorts_no_aggregate(spark):
    df, _ = facts(spark)
    plan = leaks(model_of(df), df)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_a_leaky_frame_fails(spark):
    """All totals computed over a frame that includes the row itself."""
    from pyspark.sql import Window

    df, rows = facts(spark)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    leaky = model_of(df).join(df, ["k", "t"]).select(
        "k",
        "t",
        F.col("n"),
        F.count(F.when(win(), 1)).over(w).alias("wins"),
        F.sum("seconds").over(w).alias("seconds_before"),
        "streak",
    )
    assert wrong_by_brute_force(leaky, rows)
    assert leaks(leaky, df).count() > 0


def test_ordinals_and_debuts(spark):
    df, _ = facts(spark, 5)
    model = model_of(df)
    assert q.rises_by_one(model, ["k"], ["t"], "n").count() == 0
    assert q.rises_by_one(model, ["k"], ["t"], "n", max_rows=20).count() == 0
    gap = model.withColumn("n", F.when(F.col("t") > 50, F.col("n") + 1).otherwise(F.col("n")))
    assert q.rises_by_one(gap, ["k"], ["t"], "n").count() > 0
    assert q.rises_by_one(gap, ["k"], ["t"], "n", max_rows=20).count() == q.rises_by_one(gap, ["k"], ["t"], "n").count()
    rates = model.withColumn("rate", F.when(F.col("n") > 0, F.col("wins") / F.col("n")))
    assert q.debut_is_empty(rates, "n", ["wins", "streak"], ["rate"], ["rate"]).count() == 0
    filled = rates.withColumn("rate", F.coalesce("rate", F.lit(0.0)))
    assert q.debut_is_empty(filled, "n", ["wins", "streak"], ["rate"], ["rate"]).count() == 4
    lost = rates.withColumn("rate", F.when(F.col("t") != 200, F.col("rate")))
    assert q.debut_is_empty(lost, "n", ["wins", "streak"], ["rate"], ["rate"]).count() == 1
