"""Landing files and the exactly-once load, in batches and as a stream."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from antecede.sources import landing, load
from antecede.streaming import load_stream

MAY, JUNE = dt.date(2031, 5, 9), dt.date(2031, 6, 30)


class Place:
    """A landing folder and a store; loads by either way."""

    def __init__(self, spark, folder, way="batch"):
        self.spark, self.folder, self.way = spark, folder, way
        self.root, self.store = str(folder / "land"), str(folder / "store")

    def land(self, entity, day, *rows, part=None, **names):
        columns = ", ".join(f"{n} string" for n in (names.get("columns") or ("name",)))
        frame = self.spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], columns).coalesce(1)
        landing.write_landing(frame, self.root, entity, on=day, part=part)

    def file(self, entity, day, name, frame):
        to = self.folder / "land" / entity / f"dt={day}"
        to.mkdir(parents=True, exist_ok=True)
        frame.to_parquet(to / name, index=False)

    def load(self, entity, way=None, checkpoint="progress"):
        if (way or self.way) == "batch":
            return load.load_entity(self.spark, self.root, entity, self.store)
        return load_stream(self.spark, self.root, entity, self.store, str(self.folder / f"{checkpoint}-{entity}"))

    def rows(self, entity, *columns):
        return sorted(tuple(r) for r in load.read_raw(self.spark, self.store, entity).select(*(columns or ("name",))).collect())

    def logged(self, entity):
        ledger = load.read_ledger(self.spark, self.store, entity).collect()
        assert len({r.file_path for r in ledger}) == len(ledger)
        return sorted(r.row_count for r in ledger)


def did(result):
    return result.files_loaded, result.files_skipped, result.rows_loaded


@pytest.fixture(params=["batch", "stream"])
def place(request, spark, tmp_path):
    return Place(spark, tmp_path, request.param)


@pytest.fixture
def batch(spark, tmp_path):
    return Place(spark, tmp_path)


def test_every_file_once_however_often_it_runs(place):
    place.land("fighters", MAY, "ash", "oak")
    place.land("fighters", JUNE, "fir", "elm", "yew")
    assert did(place.load("fighters")) == (2, 0, 5)
    assert did(place.load("fighters")) == (0, 2, 0)
    place.land("fighters", MAY, "box", part="late")
    assert did(place.load("fighters")) == (1, 2, 1)
    assert place.rows("fighters", "name", "dt") == [
        ("ash", MAY), ("box", MAY), ("elm", JUNE), ("fir", JUNE), ("oak", MAY), ("yew", JUNE)
    ]
    assert place.logged("fighters") == [1, 2, 3]


def test_values_stay_as_they_landed(place):
    place.land("events", MAY, ("007", "5 of 9", " x "), columns=("a", "b", "c"))
    place.load("events")
    raw = load.read_raw(place.spark, place.store, "events")
    assert raw.dtypes == [("a", "string"), ("b", "string"), ("c", "string"), ("dt", "date")]
    assert tuple(raw.first()) == ("007", "5 of 9", " x ", MAY)


def test_columns_may_come_and_go(place):
    place.land("events", MAY, ("harbour", "wet"), columns=("name", "ground"))
    place.load("events")
    place.land("events", JUNE, ("7", "hill"), columns=("gate", "name"))
    place.load("events")
    assert place.rows("events", "name", F.coalesce("ground", F.lit("-")), F.coalesce("gate", F.lit("-"))) == [
        ("harbour", "wet", "-"),
        ("hill", "-", "7"),
    ]


def test_nothing_landed(place):
    assert did(place.load("bouts")) == (0, 0, 0)
    declared = StructType([StructField("bout_url", StringType())])
    raw = load.read_raw(place.spark, place.store, "bouts", declared)
    assert raw.columns == ["bout_url", "dt"] and raw.isEmpty()


def test_files_without_rows_are_logged(place):
    place.file("bouts", MAY, "none.parquet", pd.DataFrame({"name": pd.Series([], dtype="string")}))
    place.land("bouts", JUNE, "larch")
    assert did(place.load("bouts")) == (2, 0, 1)
    assert place.logged("bouts") == [0, 1]
    assert did(place.load("bouts")) == (0, 2, 0)


def test_stray_files_are_no_ones(place):
    place.land("bouts", MAY, "larch")
    stray = place.folder / "land" / "bouts"
    pd.DataFrame({"name": ["lost"]}).to_parquet(stray / "notes.parquet")
    (stray / "dt=soon").mkdir()
    pd.DataFrame({"name": ["lost"]}).to_parquet(stray / "dt=soon" / "a.parquet")
    assert did(place.load("bouts")) == (1, 0, 1)
    assert place.rows("bouts") == [("larch",)]


def test_times_of_both_precisions_in_one_load(place):
    when = pd.Timestamp("2031-05-09 23:59:58.000123", tz="UTC")
    for kind in ("ns", "us"):
        stamped = pd.DataFrame({"name": [kind], "_ingested_at": pd.Series([when]).astype(f"datetime64[{kind}, UTC]")})
        place.file("bouts", MAY, f"{kind}.parquet", stamped)
    before = place.spark.conf.get(landing.NANOS_AS_LONG, None)
    assert did(place.load("bouts")) == (2, 0, 2)
    assert place.spark.conf.get(landing.NANOS_AS_LONG, None) == before
    shown = F.date_format("_ingested_at", "HH:mm:ss.SSSSSS")
    assert place.rows("bouts", "name", shown) == [("ns", "23:59:58.000123"), ("us", "23:59:58.000123")]


def test_both_ways_share_a_store(batch):
    batch.land("events", MAY, "one", "two")
    assert did(batch.load("events", "batch")) == (1, 0, 2)
    assert did(batch.load("events", "stream")) == (0, 1, 0)
    batch.land("events", JUNE, "three")
    assert did(batch.load("events", "stream")) == (1, 1, 1)
    assert did(batch.load("events", "batch")) == (0, 2, 0)
    assert batch.rows("events") == [("one",), ("three",), ("two",)]


def test_a_new_checkpoint_neither_loses_nor_doubles(batch):
    batch.land("events", MAY, "one", "two")
    batch.load("events", "stream", "first")
    batch.land("events", JUNE, "three")
    assert did(batch.load("events", "stream", "second")) == (1, 1, 1)
    batch.land("events", JUNE, "four", part="more")
    batch.load("events", "stream", "first")
    assert batch.rows("events") == [("four",), ("one",), ("three",), ("two",)]


def test_a_broken_file_does_not_hold_up_the_others(place):
    for n in range(4):
        place.land("events", MAY, f"row {n}", part=f"p{n}")
    folder = place.folder / "land" / "events" / f"dt={MAY}"
    broken = folder / "broken.parquet"
    broken.write_bytes(b"PAR1 but not really PAR1")
    # A file with a sound footer (and a column of its own) whose data is not.
    spoilt = folder / "spoilt.parquet"
    pd.DataFrame({"name": [str(n) * 50 for n in range(500)], "ghost": ["x"] * 500}).to_parquet(spoilt, index=False)
    content = bytearray(spoilt.read_bytes())
    content[4:900] = b"\xff" * 896
    spoilt.write_bytes(bytes(content))
    result = place.load("events")
    assert did(result) == (4, 0, 4) and result.files_failed == 2
    failures = load.read_failures(place.spark, place.store, "events").collect()
    assert sorted(r.file_path.split("/")[-1] for r in failures) == ["broken.parquet", "spoilt.parquet"]
    assert all(r.reason for r in failures)
    # One load committed, one folder, no column of a file that is not in.
    assert len(list((place.folder / "store" / "data" / "events").iterdir())) == 1
    assert load.read_raw(place.spark, place.store, "events").columns == ["name", "dt"]
    for path, name in ((broken, "mended"), (spoilt, "mended too")):
        pd.DataFrame({"name": [name]}).to_parquet(path, index=False)
    assert did(place.load("events")) == (2, 4, 2)
    assert place.rows("events")[:2] == [("mended",), ("mended too",)]


def test_other_types_are_cast_or_set_aside(place):
    when = pd.Timestamp("2031-05-09", tz="UTC")
    place.file("events", MAY, "first.parquet", pd.DataFrame({"name": ["word"], "_ingested_at": [when]}))
    place.load("events")
    place.file("events", JUNE, "numbers.parquet", pd.DataFrame({"name": [1, 2], "_ingested_at": [str(when), None]}))
    place.file("events", JUNE, "nonsense.parquet", pd.DataFrame({"name": ["lost"], "_ingested_at": ["soon"], "ghost": [1]}))
    place.land("events", JUNE, "other word")
    result = place.load("events")
    assert did(result) == (2, 1, 3) and result.files_failed == 1
    assert "soon" in load.read_failures(place.spark, place.store).first().reason
    assert place.rows("events") == [("1",), ("2",), ("other word",), ("word",)]
    raw = load.read_raw(place.spark, place.store, "events")
    assert raw.dtypes == [("name", "string"), ("_ingested_at", "timestamp"), ("dt", "date")]
    assert raw.filter("_ingested_at IS NOT NULL").count() == 2


def test_types_that_differ_within_one_load_become_text(place):
    for n in range(3):
        place.land("events", MAY, f"row {n}", part=f"p{n}")
    place.file("events", MAY, "a.parquet", pd.DataFrame({"name": [1.5]}))
    place.file("events", MAY, "z.parquet", pd.DataFrame({"name": [7], "more": ["m"]}))
    assert did(place.load("events")) == (5, 0, 5)
    assert place.rows("events") == [("1.5",), ("7",), ("row 0",), ("row 1",), ("row 2",)]


def test_other_errors_end_the_load(batch, monkeypatch):
    for n in range(4):
        batch.land("events", MAY, f"row {n}", part=f"p{n}")
    tried = []

    def full(*_):
        tried.append(1)
        raise OSError("No space left on device")

    monkeypatch.setattr(load, "append_rows", full)
    with pytest.raises(OSError, match="No space"):
        batch.load("events")
    assert tried == [1] and load.read_failures(batch.spark, batch.store).isEmpty()


def test_a_second_load_opens_new_files_only(batch):
    batch.land("events", MAY, ("x", "y"), columns=("name", "old"))
    batch.load("events")
    for path in (batch.folder / "land" / "events").rglob("*.parquet"):
        path.write_bytes(b"no longer readable")
    batch.land("events", JUNE, "new")
    assert did(batch.load("events")) == (1, 1, 1)
    assert batch.rows("events", "name", F.coalesce("old", F.lit("-"))) == [("new", "-"), ("x", "y")]


def test_many_files_in_several_commits(batch):
    for n in range(7):
        batch.land("events", MAY, str(n), part=f"p{n}")
    result = load.load_entity(batch.spark, batch.root, "events", batch.store, files_per_commit=3)
    assert did(result) == (7, 0, 7)
    assert load.read_ledger(batch.spark, batch.store).select("load_id").distinct().count() == 3


def test_entities_one_by_one_and_their_report(batch):
    batch.land("bouts", MAY, "b")
    batch.land("fighters", JUNE, "f", "g")
    results = load.load_all(batch.spark, batch.root, batch.store)
    rows = [tuple(r) for r in load.report(batch.spark, results).collect()]
    assert rows == [("events", 0, 0, 0), ("bouts", 1, 0, 1), ("fighters", 1, 0, 2)]


@pytest.mark.parametrize("way", ["batch", "stream"])
def test_a_run_that_dies_before_its_commit(batch, monkeypatch, way):
    batch.land("events", MAY, "kept", "safe")

    def gone(*_):
        raise RuntimeError("power cut")

    with monkeypatch.context() as patch:
        patch.setattr(load, "commit_ledger", gone)
        with pytest.raises(Exception, match="power cut"):
            batch.load("events", way)
    assert batch.rows("events", F.lit(1)) == [] and batch.logged("events") == []
    assert did(batch.load("events", way)) == (1, 0, 2)
    assert batch.rows("events") == [("kept",), ("safe",)]


def test_landing_a_part_again_replaces_it(batch):
    batch.land("events", MAY, "first try")
    batch.land("events", MAY, "second try")
    batch.land("events", MAY, "extra", part="b")
    batch.land("events", JUNE, "other day")
    found = landing.landed_keys(batch.spark, batch.root, "events", "name", MAY)
    assert {r.name for r in found.collect()} == {"second try", "extra"}
    assert landing.landed_keys(batch.spark, batch.root, "events", "name", dt.date(1999, 1, 1)).isEmpty()


def test_lineage(spark):
    frame = spark.createDataFrame([("Žofie", None, "7")], "who string, gap string, n string")
    row = landing.stamp_lineage(frame, F.concat(F.lit("http://h.test/"), "n"), "run-1").first()
    assert (row["_source_url"], row["_batch_id"]) == ("http://h.test/7", "run-1")
    assert row["_raw_payload"] == '{"who":"Žofie","gap":null,"n":"7"}' and row["_ingested_at"]
    assert landing.new_batch_id() != landing.new_batch_id()
