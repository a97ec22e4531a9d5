"""Every stage of the pipeline against a plain version, on what its predecessor kept."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import test_line_dedup
import test_mixing
import test_simhash

import corpus_pipeline
from antecede.llm import byte_bpe, quality_crf

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("public_tokenizers")


def test_stages_one_by_one(spark, sf_dir, documents, tmp_path):
    kept = {}
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == documents.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r["doc_id"] for r in quality_crf.classify(documents, labels).collect() if r["__score"] >= 0.3}
    assert {r["doc_id"] for r in kept["quality_crf"]} == good and 0 < len(good) < documents.count()

    rows = [(r["doc_id"], r["text"]) for r in kept["quality_crf"]]
    want = {i: sha for i, _, _, sha in test_line_dedup.expected(rows)}
    assert {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in kept["line_dedup"]} == want

    rows = [(r["doc_id"], r["text"]) for r in kept["line_dedup"]]
    firsts = {c for _, _, c in test_simhash.expected(rows)}
    assert sorted(r["doc_id"] for r in kept["simhash_near_dedup"]) == sorted(firsts)

    sizes = test_mixing.sizes_of([(r["source"], r["text"]) for r in kept["simhash_near_dedup"]])
    targets = test_mixing.targets(sizes)
    times = Counter(r["doc_id"] for r in kept["source_mix"])
    for r in kept["simhash_near_dedup"]:
        rate = targets[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert int(rate - 1e-9) <= times[r["doc_id"]] <= -int(-(rate + 1e-9) // 1)

    library = tiktoken.Encoding(
        "own", pat_str=tokenizers.PATTERN, mergeable_ranks=byte_bpe.public_vocabulary(), special_tokens={}
    )
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in kept["source_mix"]}
    assert Counter(r["doc_id"] for r in whole) == times
    for r in whole:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_awkward_rows(spark, sf_dir, awkward, nothing):
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
    kept = corpus_pipeline.near_copies(spark, awkward, sf_dir).collect()
    assert len(kept) == len({r["doc_id"] for r in kept})
