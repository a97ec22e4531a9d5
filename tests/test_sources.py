"""Seeds, freshness, where layers live."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from antecede.functions.sql import register_latest, register_sql_functions, register_unpivot
from antecede.operators import latest_per_key
from antecede.sources.catalog import database_for, ensure_table, publish, publish_view
from antecede.sources.freshness import freshness
from antecede.sources.seeds import SEED_DDL, read_seed, read_seed_checked


def test_seed_columns_are_declared_not_guessed(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(
        "event_url,event_name,event_date,event_location,_source_url,_batch_id,_ingested_at\n"
        'e/1,"Big ""One""","September 05, 2026","Las Vegas, Nevada, USA",s,b,2026-01-02 03:04:05\n'
        "e/2,007,0:02,45%,s,b,\n"
    )
    seed = read_seed(spark, str(path), SEED_DDL["events"])
    assert dict(seed.dtypes)["event_date"] == "string" and dict(seed.dtypes)["_ingested_at"] == "timestamp"
    got = [tuple(r)[:4] for r in seed.orderBy("event_url").collect()]
    assert got == [
        ("e/1", 'Big "One"', "September 05, 2026", "Las Vegas, Nevada, USA"),
        ("e/2", "007", "0:02", "45%"),
    ]


def test_lines_that_do_not_fit_are_set_aside(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('a,b,c\n1,x,2026-01-02\nz,x,2026-01-02\n2,y\n3,"q ""r"", s",\n4,x,never\n5,x,2026-01-02,more\n')
    ddl = "a INT, b STRING, c DATE"
    rows, aside = read_seed_checked(spark, str(path), ddl)
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "x", dt.date(2026, 1, 2)), (3, 'q "r", s', None)]
    assert sorted(r.line for r in aside.collect()) == ["2,y", "4,x,never", "5,x,2026-01-02,more", "z,x,2026-01-02"]
    assert {r.file_path.split("/")[-1] for r in aside.collect()} == {"s.csv"}
    assert [r.a for r in rows.select("a").orderBy("a").collect()] == [1, 3]  # whatever is asked for
    assert read_seed(spark, str(path), ddl).count() == 2 and rows.columns == ["a", "b", "c"]


def test_bucketed_tables_join_without_a_shuffle(spark):
    bouts = spark.range(1000).selectExpr("CAST(id AS string) AS bout_url", "CAST(id % 50 AS string) AS event_url")
    events = spark.range(50).selectExpr("CAST(id AS string) AS event_url", "date_add(DATE '2020-01-01', CAST(id AS int)) AS event_date")
    joined = {}
    for buckets in (8, 0):
        names = [f"{n}_{buckets}" for n in ("bouts", "events")]
        for name, frame in zip(names, (bouts, events), strict=True):
            publish(frame, "staging", name, bucket_by=("event_url",) if buckets else (), buckets=buckets)
        a, b = (spark.table(f"staging.{n}") for n in names)
        joined[buckets] = a.hint("merge").join(b, "event_url")
    assert "Exchange" not in joined[8]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in joined[0]._jdf.queryExecution().executedPlan().toString()
    assert sorted(joined[8].collect()) == sorted(joined[0].collect())
    with pytest.raises(ValueError, match="number of buckets"):
        publish(bouts, "staging", "x", bucket_by=("event_url",))
    spark.sql("DROP DATABASE staging CASCADE")


def test_views_of_a_layer_are_read_by_name(spark):
    publish(spark.range(5).toDF("n"), "raw", "numbers")
    register_sql_functions(spark, "raw")
    publish_view(spark, "staging", "small", "SELECT n, raw.parse_landed(n || ' of 9') AS landed FROM raw.numbers WHERE n < 3")
    assert [tuple(r) for r in spark.sql("SELECT * FROM staging.small ORDER BY n").collect()] == [(0, 0), (1, 1), (2, 2)]
    publish(spark.range(1, 2).toDF("n"), "raw", "numbers")
    assert spark.table("staging.small").count() == 1
    for layer in ("raw", "staging"):
        spark.sql(f"DROP DATABASE {layer} CASCADE")


def test_sql_table_functions(spark):
    rows = [("a", 1, "old", 9), ("a", 2, "new", 9), ("a", 2, "newer", 10), ("b", None, "timeless", 1), (None, 5, "no key", 1)]
    spark.createDataFrame(rows, "k string, t int, v string, tie int").createOrReplaceTempView("versions")
    register_latest(spark, "latest_versions", "versions", ["k"], "t", ["tie"])
    now = {(r.k, r.v) for r in spark.sql("SELECT * FROM latest_versions()").collect()}
    assert now == {("a", "newer"), ("b", "timeless"), (None, "no key")}
    assert [tuple(r) for r in spark.sql("SELECT k, v FROM latest_versions(1)").collect()] == [("a", "old")]
    df = latest_per_key(spark.table("versions"), ["k"], "t", ["tie"])
    assert {(r.k, r.v) for r in df.collect()} == now
    spark.createDataFrame([(1, "p", "q")], "id int, ka string, kb string").createOrReplaceTempView("pairs")
    register_unpivot(spark, "both", "pairs", ["id"], {"mine": "k{side}"}, {"other": "k{side}"})
    assert sorted(tuple(r) for r in spark.sql("SELECT * FROM both()").collect()) == [(1, "a", "p", "q"), (1, "b", "q", "p")]


def test_seed_ddl_covers_the_raw_layer(spark, tmp_path):
    assert spark.createDataFrame([], SEED_DDL["bouts"]).columns[:2] == ["fighter_a_name", "fighter_b_name"]
    assert len(spark.createDataFrame([], SEED_DDL["bouts"]).columns) == 33
    assert len(spark.createDataFrame([], SEED_DDL["fighters"]).columns) == 20


@pytest.mark.parametrize("days, want", [(8, "pass"), (9, "warn"), (30, "warn"), (31, "error")])
def test_freshness(spark, days, want):
    newest = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([(newest,), (dt.datetime(2020, 1, 1),)], "t timestamp")
    now = F.lit(newest + dt.timedelta(days=days))
    row = freshness(df, "t", now).first()
    assert (row.age_days, row.status) == (days, want)
    assert freshness(df.limit(0), "t", now).first().status == "error"


def test_layers_keep_their_names(spark):
    assert database_for("raw") == "raw" and database_for(" marts ") == "marts" and database_for(None) == "default"
    df = spark.range(3).withColumn("d", F.lit("x"))
    table = publish(df, "marts", "dim_thing", partition_by=("d",))
    assert table.count() == 3
    assert spark.catalog.tableExists("marts.dim_thing")
    publish(spark.range(2).withColumn("d", F.lit("y")), "marts", "dim_thing", partition_by=("d",))
    assert spark.table("marts.dim_thing").count() == 2
    assert publish(df, "staging", "v", how="view").count() == 3
    assert publish(df, "staging", "v", how="inline") is df
    with pytest.raises(ValueError):
        publish(df, "staging", "v", how="magic")
    spark.sql("DROP DATABASE marts CASCADE")


def test_an_empty_table_takes_its_columns_from_a_sample(spark):
    sample = spark.createDataFrame([("14 of 31",)], "x string")
    assert ensure_table(sample, "raw", "things").count() == 0
    sample.write.insertInto("raw.things")
    assert ensure_table(sample, "raw", "things").collect() == sample.collect()
    spark.sql("DROP DATABASE raw CASCADE")
