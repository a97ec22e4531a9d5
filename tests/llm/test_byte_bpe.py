import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from antecede.llm import byte_bpe, registry

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.public_vocabulary()


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(frame, texts, ranks, library):
    docs = frame.select(F.col("doc_id").alias("n"), "text")
    found = byte_bpe.encode(docs, ranks, id_col="n").withColumn("bytes", byte_bpe.decode(F.col("ids"), ranks)).collect()
    want = sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in texts), key=repr)
    assert sorted(((r["n"], list(r["ids"]), bytes(r["bytes"])) for r in found), key=repr) == want


def test_against_the_library(spark, ranks, library):
    rng = random.Random(1)
    texts = [
        "it's we'll I'd'sx 'sam ''s  's a  b\n\n c \t\n", "   ", "'", "'s", "x' 're", "a  b 12³½ ⅷ",
        "a" * 700, "é" * 300 + "xyz" * 400, "0123456789" * 30, " " * 300 + "x", "<|endoftext|>", "漢字" * 90,
    ]
    texts += ["".join(rng.choice("ab'sl re1 \n\t., é²") for _ in range(40)) for _ in range(500)]
    texts += ["".join(chr(c) for c in range(k, k + 256) if not 0xD800 <= c < 0xE000) for k in range(0, 0x11000, 256)]
    rows = list(enumerate(texts))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, ranks, library)


def test_every_code_point(spark, ranks, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a".join(points[k : k + 2000]) + " " + "1 ".join(points[k : k + 2000]) for k in range(0, len(points), 2000)]
    rows = list(enumerate(texts))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), rows, ranks, library)


def test_frequent_words_change_nothing(spark, monkeypatch, documents, ranks, library):
    monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", 3000)
    for most in (byte_bpe.FREQUENT, 500):
        monkeypatch.setattr(byte_bpe, "FREQUENT", most)
        source = documents.select(F.col("doc_id").alias("id"), "text")
        known = byte_bpe.frequent_words(source, ranks, byte_bpe._rank_maps(ranks), 1 << 30, most)
        assert 0 < len(known.hashes) <= most
        check(documents, [(r["doc_id"], r["text"]) for r in documents.collect()], ranks, library)
    word = documents.first()["text"].split()[1]
    spelled = pa.array(["ffff0000ffff"])
    twin = byte_bpe.Known.of(pa.array([word + "x"]), spelled, 4)
    hashes = byte_bpe.Known.of(pa.array([word]), spelled, 4).hashes
    points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
    clash = byte_bpe.Known(hashes, twin.points, twin.point_ends, twin.ids, twin.id_ends)
    with pytest.raises(ValueError, match="one hash"):
        clash.places(hashes, points, np.array([0]), np.array([len(word)]))


def test_awkward_rows(awkward, nothing, ranks, library):
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    check(awkward, rows, ranks, library)
    assert byte_bpe.encode(nothing, ranks).collect() == []


def test_query(spark, sf_dir, documents, library):
    found = {r["doc_id"]: r for r in registry.op3_byte_bpe(spark, sf_dir).collect()}
    for r in documents.collect():
        ids = library.encode_ordinary(r["text"])
        f = found[r["doc_id"]]
        assert f["n_tokens"] == len(ids)
        assert f["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert f["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_pieces_and_blocks_change_nothing(monkeypatch, ranks, library):
    monkeypatch.setattr(byte_bpe, "PIECE_CHARS", 50)
    texts = ["one two  three it's\n\n four five six seven eight nine ten eleven " * 9, None, "x" * 400, "a  b " * 60]
    block = byte_bpe._Block(ranks, 4)
    block.add(list(range(4)), texts)
    words = [w[4:-4] for w in block.words]
    assert sum(block.counts) == len(np.concatenate(block.index))
    spelled = iter(np.concatenate(block.index).tolist())
    for text, n in zip(texts, block.counts, strict=True):
        data = b"".join(
            next(t for t, r in ranks.items() if r == int(w[k : k + 4], 16))
            for w in (words[next(spelled)] for _ in range(n))
            for k in range(0, len(w), 4)
        )
        assert data == (text or "").encode()


def test_long_words_over_the_heap(ranks, library):
    for word in ("a" * 300, "abcabcab" * 50, "éè" * 90, "thethethe" * 30):
        assert byte_bpe._merged(word.encode(), ranks) == library.encode_ordinary(word)


def test_pairs_are_one_array_of_bytes(spark, ranks):
    sent = spark.range(1).select(byte_bpe._rank_maps(ranks).alias("pairs"))
    assert sent.schema["pairs"].dataType.simpleString() == "binary"
    assert len(sent.first()["pairs"]) <= 8 << 20
    pairs = byte_bpe._pair_ranks(ranks)
    table = byte_bpe._pair_table(pairs, 2)
    for pair, rank in pairs.items():
        key = byte_bpe.xxhash.xxh64_intdigest(pair, 42)
        seats = [table[at : at + 8] for at in (key & (len(table) - 8), key >> 32 & (len(table) - 8))]
        assert pair + rank in [s[:6] for s in seats]
    # Three pairs with the same two seats have no room, in a table of any size.
    assert byte_bpe._seated({b"a": 1 << 32, b"b": 1 << 32, b"c": 1 << 32}, 8, 64) is None
    assert byte_bpe._pair_table({}, 2) == b"\xff" * len(byte_bpe._pair_table({}, 2))


def test_known_words_are_held_narrow():
    known = byte_bpe.Known.of(pa.array([" abc", " défg"]), pa.array(["ffff00010002ffff", "ffff0003ffff"]), 4)
    assert {x.itemsize for x in (known.points, known.point_ends, known.ids, known.id_ends)} == {2}
    assert len(known.spelling().hashes) == len(known.spelling().points) == 0
    assert known.spelling().ids.tolist() == known.ids.tolist()
    wide = byte_bpe.Known.of(pa.array([" 😀"]), pa.array(["ffff0003ffff"]), 4)
    assert wide.points.tolist() == [0x20, 0x1F600]


def test_the_sample_takes_texts_together(ranks):
    texts = ["it's  one", "one two", "", "two 12 " * 3, "\n"]
    words = sorted(byte_bpe._distinct(texts, byte_bpe._classes()))
    assert words == sorted({"it", "'s", " ", " one", "one", " two", "two", " 12", "\n"})


def test_a_pair_elsewhere_has_its_first_seat_taken(ranks):
    pairs = byte_bpe._pair_ranks(ranks)
    table = byte_bpe._pair_table(pairs, 2)
    for pair in pairs:
        at = byte_bpe.xxhash.xxh64_intdigest(pair, 42) & (len(table) - 8)
        assert table[at : at + 4] != b"\xff" * 4
    empty = sum(table[at : at + 4] == b"\xff" * 4 for at in range(0, len(table), 8))
    assert empty > 0.7 * len(table) / 8  # the pairs that are no token mostly need one look
