import hashlib
from collections import Counter

import numpy as np
import pytest

from antecede.llm import registry, sampling
from antecede.llm.tokens import word_hashes


def bag(text):
    return Counter((text or "").encode().lower().split())


def jaccard(a, b):
    keys = set(a) | set(b)
    top = sum(max(a[k], b[k]) for k in keys)
    return sum(min(a[k], b[k]) for k in keys) / top if top else 1.0


def plain(text, slots=sampling.SLOTS):
    """Each slot's sample straight from the formulas, without a cache."""
    hashes, _ = word_hashes([text])
    terms, weights = np.unique(hashes, return_counts=True)
    if not len(terms):
        return np.zeros(slots, np.uint32)
    order, drawn = sampling.samples(terms, weights, slots)
    return drawn[order.argmin(0), np.arange(slots)]


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (id_, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        a, e, n = plain(text), plain(changed), plain(after)
        out.append((id_, len(text), hashlib.sha256(changed.encode()).hexdigest(), sampling.signature_hex(a),
                    sampling.signature_hex(e), float((a == e).mean()), float((a == n).mean())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_query_against_brute_force(documents, parts):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = sampling.edit_likeness(documents, parts=parts).collect()
    assert sorted((tuple(r) for r in found), key=repr) == expected(rows)


def test_registered_query(spark, sf_dir, documents):
    assert registry.op10_weighted_sampling(spark, sf_dir).count() == documents.count()


def test_collisions_estimate_generalised_jaccard():
    rng = np.random.default_rng(1)
    sampler, errors = sampling.Sampler(), []
    for k in range(60):  # words of its own for each pair: equal words draw alike
        a = " ".join(f"{k}t{x}" for x in rng.zipf(1.4, 300) % 400)
        b = a[: len(a) // 2] + " ".join(f"{k}t{x}" for x in rng.zipf(1.4, 150) % 400)
        one, two = sampler.of_texts([a, b])
        errors.append((one == two).mean() - jaccard(bag(a), bag(b)))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.1


def test_cache_changes_nothing(monkeypatch):
    texts = [f"a b{k} c d{k % 3} a a a x{k * 7 % 5}" for k in range(50)] + ["", None]
    want = np.array([plain(t) for t in texts])
    monkeypatch.setattr(sampling, "CACHED_TERMS", 9)
    sampler = sampling.Sampler()
    assert (sampler.of_texts(texts) == want).all()
    assert (sampler.of_texts(texts) == want).all()


def test_awkward_rows(awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    found = sampling.edit_likeness(awkward, parts=3).collect()
    assert sorted((tuple(r) for r in found), key=repr) == expected(rows)
    assert sampling.edit_likeness(nothing).collect() == []


def test_likeness_column(spark, documents):
    from pyspark.sql import functions as F

    signed = documents.limit(5).select(sampling.signature(F.col("text")).alias("s"))
    assert all(r[0] == 1.0 for r in signed.select(sampling.likeness(F.col("s"), F.col("s"))).collect())
