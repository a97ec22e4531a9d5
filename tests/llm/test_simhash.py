import random

import numpy as np
import pytest
import xxhash

from antecede.llm import registry, simhash


def plain(text, words=4):
    tokens = (text or "").encode().lower().split()
    shingles = [b" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or ([b" ".join(tokens)] if tokens else [])
    if not shingles:
        return 0
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, distance):
    """Union of all pairs, one by one."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(len(prints))]


def expected(rows, words=4, distance=4):
    prints = [plain(t, words) for _, t in rows]
    least = {}
    found = roots(prints, distance)
    for (id_, _), root in zip(rows, found, strict=True):
        if id_ is not None:
            least[root] = min(least.get(root, id_), id_)
    return sorted(
        ((id_, f"{p:016x}", least.get(root)) for (id_, _), p, root in zip(rows, prints, found, strict=True)), key=repr
    )


def got(frame):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("count", [2, 3, 4, 5])
def test_segments_cover_every_way_to_differ(count):
    for distance in range(6):
        cut = simhash.segments(distance, count)
        rng = random.Random(distance)
        for _ in range(300):
            bits = sum(1 << b for b in rng.sample(range(64), distance))
            assert any(bin(bits >> s & ((1 << w) - 1)).count("1") <= r for s, w, r in cut)


def test_query_against_brute_force(spark, sf_dir, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert got(registry.op1_simhash_near_dedup(spark, sf_dir)) == expected(rows)


@pytest.mark.parametrize(("distance", "count", "hot"), [(4, 3, 1000), (4, 3, 1), (3, 2, 1), (4, 4, 2), (6, 3, 1000)])
def test_links_of_made_up_fingerprints(spark, distance, count, hot):
    rng = random.Random(7)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(12):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    prints = sorted(prints)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), distance, count, hot)
    groups = {p: {p} for p in signed}
    for r in found.collect():
        joined = groups[r["u"]] | groups[r["v"]]
        for p in joined:
            groups[p] = joined
    want = roots(prints, distance)
    members = {}
    for p, root in zip(signed, want, strict=True):
        members.setdefault(root, set()).add(p)
    assert all(groups[p] == members[root] for p, root in zip(signed, want, strict=True))


def test_awkward_rows(awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert got(simhash.near_duplicates(awkward)) == expected(rows)
    assert got(simhash.near_duplicates(nothing)) == []


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(f"t{k * k % 613}" for k in range(5000))
    whole = simhash.simhash(text, 4)
    monkeypatch.setattr(simhash, "_PIECE", 100)
    assert simhash.simhash(text, 4) == whole == plain(text)


def test_first_of_each_without_ids_and_with_shared_ids(spark):
    a, b, c, d = (" ".join(f"{x}{k * k % 97}" for k in range(60)) for x in "abcd")
    rows = [(None, a), (None, b), (1, c), (1, d), (2, c), (3, a), (None, ""), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(set(roots([plain(x) for x in (a, b, c, d, "")], 4))) == 5
    kept = [(r["doc_id"], r["text"]) for r in simhash.first_of_each(docs).collect()]
    assert sorted(kept, key=repr) == sorted([(3, a), (None, b), (1, c), (1, d), (4, None)], key=repr)
    assert simhash.first_of_each(docs).columns == docs.columns
