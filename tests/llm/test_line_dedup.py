import hashlib
import random

import numpy as np
import pytest

from antecede.llm import line_dedup, registry
from antecede.llm.cuckoo import CuckooFilter


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def expected(rows, least=10):
    seen = {}
    for _, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            seen[k] = seen.get(k, 0) + 1
    out = []
    for id_, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key(x) or seen[key(x)] < least]
        out.append((id_, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query_against_brute_force(spark, sf_dir, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = registry.op8_line_dedup(spark, sf_dir).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert sorted((tuple(r) for r in found), key=repr) == expected(rows)


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_awkward_rows(awkward, nothing, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", limit)
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    kept = line_dedup.drop_lines(awkward, min_docs=2)
    assert kept.columns == [*awkward.columns, "__lines", "__dropped"]
    found = [(r["doc_id"], r["__lines"], r["__dropped"], line_dedup.sha256_hex(r["text"])) for r in kept.collect()]
    assert sorted(found, key=repr) == expected(rows, 2)
    assert line_dedup.drop_lines(nothing).collect() == []


def test_removal_undoes_addition(spark):
    rng = random.Random(3)
    rows = [(k, "\n".join(f"line {rng.randint(0, 60)}" for _ in range(8))) for k in range(90)]
    parts = [spark.createDataFrame(rows[a : a + 30], "doc_id long, text string") for a in (0, 30, 60)]

    def state(store):
        return sorted((bytes(r["key"]), r["refs"]) for r in store.counts().collect())

    store = line_dedup.LineStore(spark, shards=3)
    store.add(parts[0])
    store.add(parts[1])
    before = state(store)
    store.add(parts[2])
    exact = {}
    for _, text in rows:
        for line in set(text.split("\n")):
            exact[line_dedup.line_key(line)] = exact.get(line_dedup.line_key(line), 0) + 1
    assert state(store) == sorted(exact.items())
    store.remove(parts[2])
    assert state(store) == before
    # The filters know every key present; what was never added is hardly ever let through.
    held = {r["shard"]: CuckooFilter.loads(r["filter"]) for r in store.filters().collect()}
    for r in store.counts().collect():
        assert held[r["shard"]].contains(line_dedup._hashes([bytes(r["key"])]))[0]
    store.remove(parts[1])
    store.remove(parts[0])
    assert state(store) == []


def test_filter_holds_what_was_put_in():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 63, 20_000, np.uint64) * np.uint64(2) + np.uint64(1))
    made = CuckooFilter.build(keys)
    assert made.contains(keys).all()
    assert made.contains(rng.integers(0, 1 << 63, 100_000, np.uint64) * np.uint64(2)).mean() < 0.001
    made.delete(keys[:9000])
    assert made.contains(keys[9000:]).all()
    assert made.contains(keys[:9000]).mean() < 0.001
    made.insert(keys[:9000])
    assert CuckooFilter.loads(made.dumps()).contains(keys).all()


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_large_id_next_to_a_null_id(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", limit)
    rows = [(None, "same\nnull"), ((1 << 53) + 1, "same\nlarge"), (1, "one\nsame")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    kept = {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(docs, min_docs=2).collect()}
    assert kept == {None: "null", (1 << 53) + 1: "large", 1: "one"}
