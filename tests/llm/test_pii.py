import hashlib
import random
import re

import numpy as np
import pytest

from antecede.llm import pii, registry

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def check(rows, texts):
    assert len(rows) == len(texts)
    order = {k: i for i, k in enumerate(pii.KINDS)}
    for r, text in zip(rows, texts, strict=True):
        want = base(text)
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s.startswith(k + ":") for s in want) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (text, want, r["spans"])
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(want) <= set(spans) and len(spans) == len(want) + r["n_added"]
        keys = [(order[k], int(a), int(b)) for k, a, b in (s.split(":") for s in spans)]
        assert keys == sorted(keys) and all(0 <= a < b <= len(text or "") for _, a, b in keys)


def test_query(spark, sf_dir, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = registry.op6_personal_data(spark, sf_dir).orderBy("doc_id").collect()
    check(rows, [texts[r["doc_id"]] for r in rows])


def test_base_spans_of_random_texts(spark):
    rng = random.Random(4)
    pieces = ["a", "b.c", "@", "x-y", ".", "+", "1", "23", "255", "256", "4111 1111 1111 1111", "(", ")", " ", "-", "\n", "é", "\U0001f600", "_", "+1 (555) 010-9999", "10.0.0.1"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["1" * 30_000, "a" * 100_000, "+1" + " " * 20_000, "1-" * 15_000, "a@b.c" * 2000, "1.1." * 5000, "a@" + "b." * 20_000, "10.0.0.1 x" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.digests(pii.find_personal_data(docs)).orderBy("doc_id").collect()
    check(rows, texts)


def test_added_spans(spark):
    texts = [f"please call {a}{b}{c}-{d}{a}{b}-{c}{d}{a}{b} today" for a in "23" for b in "456" for c in "789" for d in "23"]
    texts += [f"order id {a}23-4{a}6-7890 version" for a in "01"] + ["call +1 (555) 010-9999"] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.digests(pii.find_personal_data(docs)).orderBy("doc_id").collect()
    check(rows, texts)
    assert all(r["spans"] == "phone:12:24" for r in rows[:36])
    assert all(r["n_added"] == 0 for r in rows[36:])


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(6)
    accuracy = [0.95, 0.8, 0.7, 0.6, 0.9]
    truth = rng.random(20_000) < 0.4
    votes = np.stack([np.where(rng.random(len(truth)) < a, truth, ~truth) * 2 - 1 for a in accuracy], 1)
    seen, count = np.unique(votes, axis=0, return_counts=True)
    patterns = [(0, *map(int, v), 0, 0, 0, int(n)) for v, n in zip(seen, count, strict=True)]
    p, tables = pii.estimate(patterns)
    for name, a in zip(pii.VOTES, accuracy, strict=True):
        assert tables[0, name][1, 2] == pytest.approx(a, abs=0.05)
        assert tables[0, name][0, 0] == pytest.approx(a, abs=0.05)


def test_awkward_rows(awkward, nothing):
    rows = awkward.select("doc_id", "text").collect()
    texts = {}
    for r in rows:
        texts.setdefault(r["doc_id"], r["text"])
    found = pii.digests(pii.find_personal_data(awkward)).collect()
    check(found, [texts[r["doc_id"]] for r in found])
    assert len(found) == len(rows)
    assert pii.find_personal_data(nothing).collect() == []


def test_long_repeats_end(spark):
    """Each pattern over a hundred thousand of what it repeats."""
    n = 100_000
    texts = [
        "a[at]b" + "[dot]c" * n, "a@b" + ".c" * n, "a" * n + "@b.c", "1." * n + "1", "1 " * n, "+1" + " (1)" * n, "+1." * n,
        "a:" * n, "1:" * n + "1", "(555) 555-5555 " * (n // 10), "[at][dot]" * n, "a " * n + "[at] b", "password=" * (n // 10),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    rows = {r["doc_id"]: r for r in pii.digests(pii.find_personal_data(docs)).collect()}
    assert len(rows) == len(texts) and "email:0:" in rows[0]["spans"] and rows[1]["n_email"] == 1
