"""Latest version, two-sided rows, bounded reads, key sets, contracts."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from antecede.operators import (
    Contract,
    ContractError,
    attach_columns,
    distinct_participants,
    enforce_contract,
    high_watermark,
    latest_per_key,
    page_of,
    pivot_sides,
    point_lookup,
    select_window,
    since_watermark,
    todo,
    unpivot_pairs,
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key(spark):
    rows = [("a", 1, "old"), ("a", 2, "new"), ("b", 1, "x"), ("b", 1, "y"), ("c", None, "only")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    got = {(r.k, r.v) for r in latest_per_key(df, ["k"], "t", ["v"]).collect()}
    assert got == {("a", "new"), ("b", "y"), ("c", "only")}


def test_latest_per_key_limits_before_the_shuffle(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = plan_of(latest_per_key(events, ["user_id"], "ts", ["event_id"]))
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_unpivot_and_pivot_are_inverse(spark):
    df = spark.createDataFrame([(1, "p", 10, "q", 20), (2, "r", 30, "s", None)], "id int, ka string, va int, kb string, vb int")
    long = unpivot_pairs(
        df, ["id"], {"key": "k{side}", "value": "v{side}"}, {"other": "v{side}"}, {"pair": lambda m, o: F.concat(F.col(f"k{m}"), F.col(f"k{o}"))}
    )
    got = sorted(tuple(r) for r in long.select("id", "corner", "pair", "key", "value", "other").collect())
    assert got == [
        (1, "a", "pq", "p", 10, 20),
        (1, "b", "qp", "q", 20, 10),
        (2, "a", "rs", "r", 30, None),
        (2, "b", "sr", "s", None, 30),
    ]
    wide = pivot_sides(long, ["id"], "corner", ["key", "value"])
    assert sorted(tuple(r) for r in wide.collect()) == [(1, "p", "q", 10, 20), (2, "r", "s", 30, None)]


def test_pivot_of_odd_keys(spark):
    rows = [(1, "b", "late", 2, "x"), (2, "a", "only a", 3, None), (3, "c", "no side", 4, "z"), (None, "a", "no key", 5, "n"), (4, None, "none", 6, "w")]
    rows += [(5, "b", "right", 8, "q"), (5, "a", "left", 7, None), (6, "a", "twice", 9, "t"), (6, "a", "twice", 9, "t"), (6, "b", "twin", 1, "t")]
    df = spark.createDataFrame(rows, "id int, side string, v string, n int, same string")
    wide = pivot_sides(df, ["id"], "side", ["v", "n"], constant=["same"])
    plan = plan_of(wide)
    assert wide.columns == ["id", "same", "v_a", "v_b", "n_a", "n_b"]
    assert {r["id"]: tuple(r)[1:] for r in wide.collect()} == {
        1: ("x", None, "late", None, 2),
        2: (None, "only a", None, 3, None),
        3: ("z", None, None, None, None),
        None: ("n", "no key", None, 5, None),
        4: ("w", None, None, None, None),
        5: ("q", "left", "right", 7, 8),
        6: ("t", "twice", "twin", 9, 1),
    }
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_unpivot_reads_its_input_once(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", "o_custkey AS xa", "o_totalprice AS xb")
    plan = plan_of(unpivot_pairs(orders, ["o_orderkey"], {"x": "x{side}"}))
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan


def test_distinct_participants(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "b", None), (3, "", "c")], "n int, x string, y string")
    assert {r.who for r in distinct_participants(df, ["x", "y"], "who").collect()} == {"a", "b", "c"}
    seen = {r.who: r.first_seen for r in distinct_participants(df, ["x", "y"], "who", "n").collect()}
    assert seen == {"a": 1, "b": 1, "c": 3}


def test_select_window_is_inclusive_newest_first(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 11)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "d date, i int")
    picked = select_window(df, "d", dt.date(2024, 1, 3), dt.date(2024, 1, 7), 3, ["i"])
    assert [r.d.day for r in picked.collect()] == [7, 6, 5]
    assert "TakeOrderedAndProject" in plan_of(picked)
    everything = select_window(df, "d", dt.date(2024, 1, 3), dt.date(2024, 1, 7))
    assert [r.d.day for r in everything.collect()] == [7, 6, 5, 4, 3]


def test_pages(spark):
    df = spark.range(60).toDF("k")
    assert [r.k for r in page_of(df, ["k"], 1).collect()] == list(range(25))
    assert [r.k for r in page_of(df, ["k"], 3).collect()] == list(range(50, 60))
    assert page_of(df, ["k"], 4).count() == 0
    assert "TakeOrderedAndProject" in plan_of(page_of(df, ["k"], 2))


def test_point_lookup_reaches_the_scan(spark, sf_dir):
    found = point_lookup(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name"), "c_custkey", 7)
    plan = plan_of(found)
    assert "EqualTo(c_custkey,7)" in plan and "c_mktsegment" not in plan
    assert found.count() == 1


def test_todo_and_watermark(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "t int, k string")
    landed = spark.createDataFrame([("b",), (None,), ("b",)], "k string")
    assert {r.k for r in todo(df, landed, "k").collect()} == {"a", "c"}
    assert {r.t for r in since_watermark(df, df.filter("t < 3"), "t").collect()} == {3}
    assert since_watermark(df, df.filter("t > 9"), "t").count() == 3
    assert high_watermark(df, "t").first()[0] == 3


CONTRACT = Contract("things", "id INT NOT NULL, name STRING, price DECIMAL(6,2) NOT NULL")


def test_contract_accepts_exactly_its_columns(spark):
    good = spark.sql("SELECT 1 AS id, CAST(NULL AS string) AS name, CAST(2 AS decimal(6,2)) AS price")
    assert enforce_contract(good, CONTRACT).count() == 1
    for bad in (
        good.drop("name"),
        good.withColumn("extra", F.lit(1)),
        good.select("name", "id", "price"),
        good.withColumn("price", F.col("price").cast("double")),
    ):
        with pytest.raises(ContractError):
            enforce_contract(bad, CONTRACT)


def test_contract_nulls_stop_the_write(spark, tmp_path):
    holed = spark.sql("SELECT 1 AS id, 'x' AS name, CAST(NULL AS decimal(6,2)) AS price")
    enforce_contract(holed, CONTRACT, check_nulls=False).collect()
    with pytest.raises(PySparkException, match="things.price is NULL"):
        enforce_contract(holed, CONTRACT).write.parquet(str(tmp_path / "out"))


def test_attach_columns(spark):
    base = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "n int, k string")
    first = spark.createDataFrame([(1, "a", 10), (2, "a", 20)], "n int, k string, x int")
    second = spark.createDataFrame([(1, "b", 7)], "n int, k string, y int")
    got = attach_columns(base, ["n", "k"], {"x": first, "y": second})
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a", 10, None), (1, "b", None, 7), (2, "a", 20, None)]
