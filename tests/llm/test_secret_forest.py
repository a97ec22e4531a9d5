import math
import random
import re
import string
from collections import Counter

import pytest

from antecede.llm import registry, secret_forest

PLANTED = re.compile(r'AKIA[0-9A-Z]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = ")[0-9a-f]{40}')


def test_query_finds_the_planted_secrets(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    found = registry.op7_secret_forest(spark, "/root/testdata/sf0.01").collect()
    for r in found:
        assert docs[r["doc_id"]][r["start"] : r["end"]] == r["match"]
    got = {(r["doc_id"], r["start"], r["end"]) for r in found}
    want = {(i, m.start(), m.end()) for i, t in docs.items() for m in PLANTED.finditer(t)}
    assert want and len(want & got) >= 0.97 * len(want)
    assert len(want & got) >= 0.97 * len(got)


def test_labelled_findings_decide(spark):
    rng = random.Random(2)
    token = lambda: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(32))
    rows = [(token(), 'key = "', '" end', 1.0) for _ in range(200)] + [(token(), "commit ", " merged", 0.0) for _ in range(200)]
    labelled = spark.createDataFrame(rows, "match string, before string, after string, label double")
    texts = [(k, f'key = "{token()}" end' if k % 2 else f"commit {token()} merged") for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    kept = {r["doc_id"] for r in secret_forest.find_secrets(docs, labelled).collect()}
    assert kept == {k for k, _ in texts if k % 2}


def test_awkward_rows(awkward, nothing):
    rows = {r["doc_id"]: r["text"] for r in awkward.select("doc_id", "text").collect()}
    for r in secret_forest.find_secrets(awkward).collect():
        assert rows[r["doc_id"]][r["start"] : r["end"]] == r["match"]
    assert secret_forest.find_secrets(nothing).collect() == []


def test_values_of_any_kind_are_candidates(spark):
    texts = {
        1: ("password=hunter2", ["hunter2"]),
        2: ("say password=Tr0ub4dor&3, then", ["Tr0ub4dor&3"]),
        3: ("{'pwd': 'a b@!#$%&*c', \"token\": \"letmein\"}", ["a b@!#$%&*c", "letmein"]),
        4: ("first=0123456789abcd=secondValueHere=fedcba9876543210==", ["0123456789abcd", "fedcba9876543210==", "secondValueHere"]),
        5: ("u=x&password=p@ss/w0rd&token=t:1;k=2 secret: x", ["p@ss/w0rd", "t:1", "x"]),
        6: ('key = "pa55@word!now#" and AKIA' + "0A" * 8 + ".", ["AKIA" + "0A" * 8, "pa55@word!now#"]),
        7: ("auth: token=abc 'Password=\"q;\"' pwd=", ["abc", "q;"]),
        8: ("client_secret_token1=zq password=" + "p@" * 20_000, ["client_secret_token1", "p@" * 20_000]),
        9: ("Plain words only: nothing to see. \U0001f600 api_key = ü1", ["ü1"]),
    }
    docs = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "doc_id long, text string")
    got = {k: [] for k in texts}
    for r in secret_forest.candidates(docs).collect():
        assert texts[r["id"]][0][r["start"] : r["end"]] == r["match"]
        got[r["id"]].append(r["match"])
    found = {k: sorted(v) for k, v in got.items()}
    assert {k: [x for x in v if x not in found[k]] for k, (_, v) in texts.items()} == {k: [] for k in texts}
    assert {k: [x for x in v if x not in texts[k][1]] for k, v in found.items() if k != 4} == {k: [] for k in texts if k != 4}
    measured = secret_forest.measured(secret_forest.candidates(docs), ["plain"]).collect()
    assert all(r[m] is not None for r in measured for m in secret_forest.MEASURES)


def test_long_candidates_are_measured_whole(spark):
    rng = random.Random(5)
    values = ["q", "aa", "a" * 300 + "".join(rng.choices("ABCdef0123456789+/", k=900)) + "b" * 300]
    found = spark.createDataFrame([(v, "", "") for v in values], "match string, before string, after string")
    got = {r["match"]: (r["entropy"], r["pairs"]) for r in secret_forest.measured(found, ["word"]).collect()}
    for v in values:
        shares = [n / len(v) for n in Counter(v).values()]
        assert got[v][0] == pytest.approx(-sum(p * math.log2(p) for p in shares))
        assert got[v][1] == pytest.approx(max(1, len({v[i : i + 2] for i in range(len(v) - 1)})) / len(v))
