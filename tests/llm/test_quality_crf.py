import itertools
import zlib

import numpy as np
import pytest

from antecede.llm import quality_crf, registry


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(2)
    lines = np.array([4, 1, 6, 2])
    odds, pairs = rng.normal(size=lines.sum()) * 2, rng.normal(size=(2, 2))
    p, expected, log_z = quality_crf.marginals(odds, lines, pairs)
    at, counts = 0, np.zeros((2, 2))
    for k, n in enumerate(lines):
        own = odds[at : at + n]
        total, good, both = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            weight = np.exp(sum(o * y for o, y in zip(own, labels)) + sum(pairs[a, b] for a, b in zip(labels, labels[1:])))
            total += weight
            good += weight * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                both[a, b] += weight
        assert p[at : at + n] == pytest.approx(good / total)
        assert log_z[k] == pytest.approx(np.log(total))
        counts += both / total
        at += n
    assert expected == pytest.approx(counts)


def test_neighbours_count_within_a_text_only():
    model = quality_crf.Model.blank()
    rng = np.random.default_rng(3)
    for weight in model.parts():
        weight += rng.normal(size=weight.shape)
    texts = ["one\ntwo words\nTHREE!!", "", None, "a b c\n\nd", "x"]
    together = quality_crf.score_texts(model, texts)
    assert together == pytest.approx([quality_crf.score_texts(model, [t])[0] for t in texts])


def test_held_out_documents(spark):
    rows = registry.op2_quality_crf(spark, "/root/testdata/sf0.01").collect()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    scores = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(scores) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [(scores[r["doc_id"]]["score"], r["quality"]) for r in labels if scores[r["doc_id"]]["held_out"]]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([(s >= 0.3) == q for s, q in held]) > 0.95


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(4, 1, 0), (5, 1, None), (5, 1, 0), (7, 0, 0), (None, 1, 0), (8, None, 0), (99, 1, 1)], "doc_id long, quality int, toxic int"
    )
    out = quality_crf.classify(awkward, labels)
    assert out.columns == [*awkward.columns, "__held_out", "__score", "__predicted"]
    rows = out.collect()
    assert len(rows) == awkward.count() and all(0 <= r["__score"] <= 1 for r in rows)
    assert {r["__held_out"] for r in rows if r["doc_id"] is None} == {False}
    assert all(r["__score"] == 0.5 for r in quality_crf.classify(awkward, labels.limit(0)).collect())
    assert quality_crf.classify(nothing, labels).collect() == []


def test_lots_are_bounded_by_characters(monkeypatch):
    monkeypatch.setattr(quality_crf, "_CHARS", 100)
    monkeypatch.setattr(quality_crf, "_DOCS", 3)
    texts = ["a" * 60, "b" * 60, None, "", "c", "d" * 500, "e"]
    lots = [texts[lot] for lot in quality_crf._lots(texts)]
    assert [x for lot in lots for x in lot] == texts
    assert all(len(lot) <= 3 and (len(lot) == 1 or sum(len(x or "") for x in lot) <= 100) for lot in lots)
    assert list(quality_crf._lots([])) == []
