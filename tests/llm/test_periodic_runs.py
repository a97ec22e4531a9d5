import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from antecede.llm import periodic_runs as pr
from antecede.llm import registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, min_length=2, min_periods=2):
    """Every period and every maximal stretch that keeps it, the smallest period of each."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                best.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    found = [(s, n, q) for (s, n), q in best.items() if n >= max(min_length, min_periods * q)]
    return sorted((s, n, q) for s, n, q in found)


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def random_words(rng):
    words = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 40))]
    for _ in range(rng.randint(0, 3)):
        unit = [rng.choice("abcd") for _ in range(rng.randint(1, 5))]
        words[rng.randint(0, len(words)) :] = unit * rng.randint(2, 6)
    return words


@pytest.mark.parametrize("seed", range(20))
def test_runs_against_every_period(seed):
    rng = random.Random(seed)
    for _ in range(100):
        words = random_words(rng)
        start, length, period = pr.runs_of(np.array([ord(w) for w in words], np.int64))
        assert list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True)) == plain_runs(words)


def test_suffix_array():
    rng = random.Random(5)
    for _ in range(200):
        symbols = [rng.randint(0, 3) for _ in range(rng.randint(1, 60))] * rng.randint(1, 3)
        order, rank, depth = pr.suffix_array(np.array(symbols, np.int64))
        want = sorted(range(len(symbols)), key=lambda k: symbols[k:])
        assert order.tolist() == want and rank[order].tolist() == list(range(len(symbols)))
        for k in range(1, len(want)):
            a, b = symbols[want[k - 1] :], symbols[want[k] :]
            same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert depth[k] == same


def test_long_periodic_texts_stay_cheap():
    # Every multiple of the period is a branching square of the same end.
    for unit, n in ((1, 200_000), (7, 200_000), (90_000, 200_000)):
        start, length, period = pr.runs_of(np.resize(np.arange(unit), n).astype(np.int64))
        assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [n], [unit])


def test_texts_of_a_block_do_not_mix(spark):
    texts = ["a b a b", "a b a b a b a b", "x", "", None, " \n ", "a a a a a a", "a b a b a b a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["periodic"] for r in pr.add_runs(docs).collect()}
    for k, text in enumerate(texts):
        words = WORD.findall(text or "")
        want = plain_runs(words, 6, 4)
        assert [tuple(r) for r in got[k]["runs"]] == want
        assert got[k]["collapsed"] == collapsed(words, want)


def test_query(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in registry.op11_periodic_runs(spark, sf_dir).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    some = 0
    for r in rows:
        words, h = WORD.findall(r["text"] or ""), zlib.crc32(str(r["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue  # the plain way is quadratic
        runs, f = plain_runs(words, 6, 4), got[r["doc_id"]]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        some += bool(runs)
        assert f["n_runs"] == len(runs)
        assert (f["start"], f["length"], f["period"]) == best
        assert f["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert f["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert f["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert some > 10


def test_awkward_rows(spark, awkward, nothing):
    got = pr.add_runs(awkward, into="key").orderBy("doc_id").collect()
    assert len(got) == awkward.count() and set(got[0].asDict()) == set(awkward.columns)
    for r in got:
        words = WORD.findall(r["text"] or "")
        if len(words) < 1000:
            want = plain_runs(words, 6, 4)
            assert [tuple(x) for x in r["key"]["runs"]] == want and r["key"]["collapsed"] == collapsed(words, want)
    long = next(r["key"] for r in got if r["doc_id"] == 7)  # 977 words over and over, then one more
    assert [tuple(x) for x in long["runs"]] == [(0, 200_000, 977)] and len(long["collapsed"].split()) == 978
    assert pr.add_runs(nothing).count() == 0
    with pytest.raises(ValueError, match="two periods"):
        pr.periodic_runs(F.col("text"), min_periods=1)
