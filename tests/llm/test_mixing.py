import re

import pytest

from antecede.llm import mixing, registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(3, 1, 2), share=1.5, limit=2.0):
    """By the rule: deal out, cut off at the limit, deal the excess out again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    order += [None] if None in sizes else []
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    got = dict.fromkeys(order, 0.0)
    left, open_ = share * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        unit = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            got[s] += unit * weight[s]
            if got[s] >= limit * sizes[s]:
                left += got[s] - limit * sizes[s]
                got[s] = limit * sizes[s]
                open_.discard(s)
    return got


def sizes_of(rows):
    out = {}
    for source, text in rows:
        out[source] = out.get(source, 0) + len(WORD.findall(text or ""))
    return out


def test_query(spark, sf_dir, documents):
    rows = documents.collect()
    sizes = sizes_of([(r["source"], r["text"]) for r in rows])
    want = targets(sizes)
    found = {r["doc_id"]: r for r in registry.op9_source_mix(spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for r in rows:
        f = found[r["doc_id"]]
        size = len(WORD.findall(r["text"]))
        assert f["size"] == size and f["source_size"] == sizes[r["source"]]
        assert f["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        rate = f["target"] / f["source_size"]
        assert f["taken"] in (size * int(rate), size * -int(-rate // 1)) and f["taken"] <= 2 * size
    again = {r["doc_id"]: r for r in registry.op9_source_mix(spark, sf_dir).collect()}
    assert again == found


def test_taken_comes_near_target(spark):
    rows = [(k, "a b c", f"s{k % 3}") for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    per = {}
    for r in mixing.mix(docs, share=1.5).collect():
        t = per.setdefault(r["source"], [0, r["__target"]])
        t[0] += r["__size"] * r["__copies"]
    assert all(abs(a / b - 1) < 0.05 for a, b in per.values())


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 100, "c": 7, None: 50}, {"a": 5}, {"a": 0, "b": 9}, {"é": 4, "z": 4, "Z": 4, "y": 90, "x": 2}])
@pytest.mark.parametrize("share", [0.3, 1.5, 2.0])
def test_targets(spark, sizes, share):
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(frame, share=share).collect()}
    want = targets(sizes, share=share)
    assert found.keys() == want.keys()
    assert all(found[s] == pytest.approx(want[s], abs=1e-6) for s in want)


def test_awkward_rows(awkward, nothing):
    mixed = mixing.mix(awkward)
    assert mixed.count() == awkward.count()
    out = mixing.emit(mixed)
    assert out.columns == awkward.columns
    taken = sum(r["__copies"] for r in mixed.collect())
    assert out.count() == taken
    assert mixing.emit(mixing.mix(nothing)).collect() == []
