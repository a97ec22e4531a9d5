import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from antecede.llm import chat_format as cf
from antecede.llm import registry

TEMPLATE = cf.Template()
SCHEMA = "conv_id long, turn long, role string, text string"
BITS = [*TEMPLATE.controls, "<", "[", "\\", "s>", "/", "INST]", " ", "\n", "é", "漢", "\U0001f600", "a", "|", "name|>", "<SYS>>"]


def random_text(rng):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, 12)))


def test_escape_is_reversible_and_hides_controls():
    rng = random.Random(1)
    for _ in range(20_000):
        text = random_text(rng)
        safe = TEMPLATE.escape(text)
        assert TEMPLATE.unescape(safe) == text
        for open_, close in (*TEMPLATE.roles.values(), TEMPLATE.other[1:]):
            around = open_ + safe + close
            assert sum(around.count(c) for c in TEMPLATE.controls) == sum((open_ + close).count(c) for c in TEMPLATE.controls)


def test_assembled_bytes_against_joined_strings():
    rng = random.Random(2)
    for _ in range(200):
        rows = [(rng.choice(["user", "assistant", "system", "tool", "", "[INST]"]), rng.choice([None, random_text(rng)])) for _ in range(rng.randint(1, 12))]
        texts = pa.array(["skip", *[t for _, t in rows]]).slice(1)
        buffer, at, (begin, end) = cf.assemble(TEMPLATE, [r for r, _ in rows], texts)
        data = buffer.to_pybytes()
        for k, (role, text) in enumerate(rows):
            a, b = TEMPLATE.marks(role)
            assert data[at[k] : at[k + 1]] == a + TEMPLATE.escape(text or "").encode() + b
            assert data[begin[k] : end[k]] == TEMPLATE.escape(text or "").encode()
        assert list(TEMPLATE.turns(data.decode())) == [(r, t or "") for r, t in rows]


def plain(rows):
    """What read_back must give, by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        listed = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        scored = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        chars = sum(len(TEMPLATE.escape(r[3] or "")) + sum(len(m.decode()) for m in TEMPLATE.marks(r[2] or "")) for r in turns)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, scored)]
        out[conv] = (len(turns), digests[0], len(scored), digests[1], chars)
    return out


def read(df):
    rows = df.collect()
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"]) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool"]), random_text(rng)) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(1000, t, "assistant" if t % 2 else "user", random_text(rng)) for t in range(400)]  # one of many turns
    rows += [(None, 0, "user", "no id"), (None, 1, None, None), (2000, None, "user", "x"), (2000, 5, "assistant", ""), (2001, 0, "assistant", "long " * 50_000)]
    rows += [(2002, 0, "user", "twice"), (2002, 0, "user", "twice")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("slice_bytes", [1, 2000, cf.SLICE_BYTES])
def test_round_trip(spark, conversations, slice_bytes):
    df = spark.createDataFrame(conversations, SCHEMA).withColumns({n: F.lit(n) for n in ("part", "seq", "conv", "mark", "formatted")})
    pieces = cf.format_conversations(df, slice_bytes=slice_bytes)
    assert read(cf.read_back(pieces)) == plain(conversations)
    assert pieces.where("whole").groupBy("conv_id").count().where("count > 1").isEmpty()


def test_loss_spans_are_code_points_of_assistant_texts(spark, conversations):
    df = spark.createDataFrame(conversations, SCHEMA)
    for r in cf.format_conversations(df).where("conv_id < 60").collect():
        under = [TEMPLATE.unescape(r["formatted"][s["start"] : s["end"]]) for s in r["loss"]]
        assert under == [t for role, t in TEMPLATE.turns(r["formatted"]) if role == "assistant"]


def test_empty(spark):
    assert cf.read_back(cf.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_refused_templates():
    for controls in (("<a>", "<a>b"), ("<a>", "a>"), ("<",), ("<\\a>",)):
        with pytest.raises(ValueError):
            cf.Template(roles={}, controls=(*controls, *TEMPLATE.controls))
    with pytest.raises(ValueError, match="no control"):
        cf.Template(roles={"user": ("User: ", "</s>")})
    with pytest.raises(ValueError, match="complete"):
        cf.Template(roles={"user": ("<s><", "</s>")})
    with pytest.raises(ValueError, match="open alike"):
        cf.Template(roles={"user": ("<s>", "</s>"), "assistant": ("<s>", "</s>")})


def test_awkward_conversation(spark, sf_dir):
    got = read(registry.op13_chat_format(spark, sf_dir))[-7]
    assert got[:4] == plain(registry.AWKWARD)[-7][:4]
