"""Personal data by weak supervision, in DataFrame expressions throughout.

Candidates are the matches of each kind's base pattern (also those that fail its check) and of
looser forms: spelled-out mail addresses, IPv6 addresses, phone numbers without a plus sign. Five
labelers vote on each candidate, for (1), against (-1) or not at all (0): the kind's check, a
gazetteer (top-level domains, reserved networks, card issuers, country and area codes), words
before it that go with the kind, words around it that go with other numbers, and whether it
stands alone.

Expectation-maximisation estimates, for each kind, how often each labeler votes each way on true
and on false candidates, and with that every candidate's probability of being true. A logistic
classifier of the candidate's own shape and surroundings is then fitted to those probabilities,
and decides. Both see only counts of equal vote and shape patterns, whose number is fixed by the
labelers (below ``MAX_PATTERNS``), so that their size does not grow with the corpus.

A base match that passes its check is always a span. The classifier adds candidates of
probability ``THRESHOLD`` or more that overlap no base span and no earlier added one of the kind.

Texts are read once; what is found is written with one row per document, so that nothing is
shuffled and rows with equal ids stay apart. Defined results: a null or empty text has no spans;
an empty table gives an empty result; a kind without candidates adds nothing.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from antecede.session import scratch_path

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.5
MAX_PATTERNS = 100_000
VOTES = ("check", "gazetteer", "cue", "other", "alone")
#: Labelers that only ever vote one way: for these, silence is an answer.
ONE_SIDED = ("cue", "other")
#: What is believed beforehand, as counts of the votes -1, 0, 1 on false and on true candidates: each
#: labeler is better than chance, the check by far. It keeps true and false from changing places.
PRIOR = {
    "check": np.array([[40, 10, 1], [1, 10, 40]]),
    "gazetteer": np.array([[6, 1, 3], [3, 1, 6]]),
    "cue": np.array([[0, 9, 1], [0, 6, 4]]) + 0.1,
    "other": np.array([[4, 6, 0], [1, 9, 0]]) + 0.1,
    "alone": np.array([[6, 1, 3], [3, 1, 6]]),
}
SHAPES = ("form", "digits", "breaks")
_CONTEXT = 40
_LOT = 64

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: The base patterns, written so that a match is only tried where one can begin, and without
#: giving back characters that cannot help: they find what the plain patterns find, in linear time.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",  # fewer digits fail the check anyway
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser forms.
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+ ?[\[(]at[\])] ?{_LABEL}{{1,63}}+(?: ?[\[(]dot[\])] ?{_LABEL}{{1,63}}+)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9A-Za-z+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
}
#: A text without a match of these has none of the kind's patterns.
_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_LOOSE_NEEDS = {"email": r"[\[(]at[\])]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:", "phone": r"[0-9]{3}[ .-][0-9]{4}"}

#: Words that go with a kind, or with other numbers.
CUES = {
    "email": r"mail|contact|write to|reach|correo|courriel|kontakt",
    "ip": r"\bip\b|address|host|server|client|adresse",
    "card": r"card|visa|credit|debit|payment|tarjeta|carte|karte",
    "phone": r"phone|tel|call|mobile|fax|cell|whatsapp|anruf|llama|appel",
}
OTHER_NUMBERS = r"version|release|order|isbn|issn|invoice|serial|\bid\b|\bsku\b|section|chapter|figure|doi|build"
TOP_DOMAINS = r"(com|org|net|edu|gov|mil|int|info|biz|io|de|fr|es|uk|it|nl|eu|us|ca|ch|at|be|mx|ar|br|jp|cn|in|au)"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38)"
RESERVED_NETWORKS = r"^(0|10|127|22[4-9]|2[345][0-9]|169\.254|192\.168|172\.(1[6-9]|2[0-9]|3[01]))\."
COUNTRY_CODES = r"^\+(1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[2368]|35[0-9]|37[0-9]|38[0-9]|42[013]|97[0-9])"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def place(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        double = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 1, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), place) % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    n = F.length(_digits(match))
    if kind == "card":
        return n.between(13, 19) & F.when(n.between(13, 19), _luhn(_digits(match))).otherwise(F.lit(False))
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _found(text: Column, pattern: str, needs: str) -> Column:
    """All matches: array of struct(start, end, match, before, after), in code points."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string>>")

    def laid(both: Column) -> Column:
        gap, hit = both["gaps"], both["hits"]

        def place(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.get(gap, i))
            end = start + F.length(F.get(hit, i))
            one = F.struct(
                start.alias("start"),
                end.alias("end"),
                F.get(hit, i).alias("match"),
                F.right(F.get(gap, i), F.lit(_CONTEXT)).alias("before"),
                F.left(F.get(gap, i + 1), F.lit(_CONTEXT // 2)).alias("after"),
            )
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

        # Some matches at a time, so that the work stays in proportion to their number: first how
        # many characters each lot spans, then the matches of each lot from where it begins.
        n = F.size(hit)
        lots = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(_LOT))).otherwise(F.array().cast("array<int>"))

        def members(first: Column) -> Column:
            return F.sequence(first, F.least(first + _LOT, n) - 1)

        def span(first: Column) -> Column:
            return F.aggregate(members(first), F.lit(0), lambda s, i: s + F.length(F.get(gap, i)) + F.length(F.get(hit, i)))

        def matches(spans: Column) -> Column:
            def lot(first: Column, k: Column) -> Column:
                begin = F.aggregate(F.slice(spans, F.lit(1), k), F.lit(0), lambda s, x: s + x)
                state = F.struct(begin.alias("at"), empty.alias("out"))
                return F.aggregate(members(first), state, place, lambda s: s["out"])

            return F.flatten(F.transform(lots, lot))

        return F.get(F.transform(F.array(F.transform(lots, span)), matches), F.lit(0))

    bound = F.transform(F.array(F.struct(gaps.alias("gaps"), hits.alias("hits"))), laid)
    return F.when(text.rlike(needs), F.get(bound, F.lit(0))).otherwise(empty)


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, 1)
    return (vote.when(no, -1) if no is not None else vote).otherwise(0)


def _gazetteer(kind: str, match: Column) -> Column:
    if kind == "email":
        known = F.lower(match).rlike(rf"(\.|dot[\])] ?){TOP_DOMAINS}$")
        return _vote(known, ~known)
    if kind == "ip":
        reserved = match.rlike(RESERVED_NETWORKS)
        return _vote(~reserved, reserved)
    if kind == "card":
        issued = _digits(match).rlike(ISSUERS)
        return _vote(issued, ~issued)
    known = F.when(match.startswith("+"), match.rlike(COUNTRY_CODES)).otherwise(_digits(match).rlike("^[2-9]"))
    return _vote(known, ~known)


def _candidate(kind: str, c: Column, loose: bool) -> Column:
    match, around = c["match"], F.lower(F.concat(c["before"], F.lit(" "), c["after"]))
    passes = F.lit(False) if loose else _passes(kind, match)
    joined = c["before"].rlike(r"[0-9A-Za-z]$") | c["after"].rlike(r"^[0-9A-Za-z]")
    n = F.length(_digits(match))
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        c["start"].alias("start"),
        c["end"].alias("end"),
        passes.alias("base"),
        (F.lit(0) if loose else _vote(passes, ~passes)).alias("check"),
        _gazetteer(kind, match).alias("gazetteer"),
        _vote(F.lower(c["before"]).rlike(CUES[kind])).alias("cue"),
        F.when(around.rlike(OTHER_NUMBERS), -1).otherwise(0).alias("other"),
        _vote(~joined, joined).alias("alone"),
        F.lit(int(loose)).alias("form"),
        F.when(n < 7, 0).when(n < 9, 1).when(n < 13, 2).when(n < 16, 3).when(n < 20, 4).otherwise(5).alias("digits"),
        F.least(F.length(F.regexp_replace(match, r"[^ ().\-:\[\]]", "")), F.lit(5)).alias("breaks"),
    )


def candidates(text: Column) -> Column:
    """All candidates of a text, by kind as listed."""

    def of(kind: str, loose: bool) -> Column:
        pattern, needs = (LOOSE[kind], _LOOSE_NEEDS[kind]) if loose else (BASE[kind], _NEEDS[kind])
        return F.transform(_found(text, pattern, needs), lambda c: _candidate(kind, c, loose))

    return F.concat(*[of(kind, loose) for kind in KINDS for loose in (False, True) if not loose or kind in LOOSE])


def estimate(patterns: list[tuple], rounds: int = 50) -> tuple[np.ndarray, dict]:
    """Probability of being true for each pattern (kind, votes..., shapes..., count), and each
    labeler's reliabilities: for (kind, labeler), a row for false and true candidates with the
    probabilities of the votes -1, 0, 1."""
    kinds = np.array([p[0] for p in patterns])
    votes = np.array([p[1 : 1 + len(VOTES)] for p in patterns]) + 1
    count = np.array([p[-1] for p in patterns], float)
    # The start: the share of votes for it among those cast.
    signed = votes - 1
    p_true = (1 + (signed > 0).sum(1)) / (2 + (signed != 0).sum(1))
    reliabilities: dict = {}
    for _ in range(rounds):
        odds = np.zeros(len(patterns))
        for kind in np.unique(kinds):
            at = kinds == kind
            true, false = count[at] * p_true[at], count[at] * (1 - p_true[at])
            odds[at] = math.log((true.sum() + 1) / (false.sum() + 1))
            for j in range(len(VOTES)):
                table = np.stack([np.bincount(votes[at, j], w, 3) for w in (false, true)]) + PRIOR[VOTES[j]]
                table /= table.sum(1, keepdims=True)
                reliabilities[int(kind), VOTES[j]] = table
                said = np.log(table[1] / table[0])
                if VOTES[j] not in ONE_SIDED:
                    said[1] = 0.0  # it had nothing to say, which says nothing
                odds[at] += said[votes[at, j]]
        p_true = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return p_true, reliabilities


def _inputs(pattern: tuple) -> list[tuple[str, int, int]]:
    """The classifier's inputs of a pattern: (column, kind, value)."""
    names = ("kind", *VOTES, *SHAPES)
    row = dict(zip(names, pattern, strict=False))
    return [("kind", row["kind"], 0)] + [(n, row["kind"], row[n]) for n in names[1:]]


def fit_classifier(patterns: list[tuple], p_true: np.ndarray, steps: int = 400, ridge: float = 0.05) -> dict:
    """Logistic weights by (column, kind, value), fitted to soft labels."""
    places: dict = {}
    rows = [[places.setdefault(x, len(places)) for x in _inputs(p)] for p in patterns]
    if not rows:
        return {}
    at = np.array(rows)
    count = np.array([p[-1] for p in patterns], float)
    count = np.sqrt(count)  # frequent patterns must not drown the rest
    weights, momentum, square = np.zeros(len(places)), np.zeros(len(places)), np.zeros(len(places))
    for k in range(1, steps + 1):
        p = 1 / (1 + np.exp(-weights[at].sum(1)))
        gap = count * (p_true - p)
        grad = np.bincount(at.ravel(), np.repeat(gap, at.shape[1]), len(places)) - ridge * weights
        momentum += 0.1 * (grad - momentum)
        square += 0.01 * (grad**2 - square)
        weights += 0.1 * (momentum / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-9)
    return {x: float(weights[i]) for x, i in places.items()}


def _probability(c: Column, weights: dict) -> Column:
    odds = F.lit(0.0)
    for name in ("kind", *VOTES, *SHAPES):
        value = F.lit(0) if name == "kind" else c[name]
        chosen = None
        for (column, kind, at), weight in sorted(weights.items()):
            if column == name:
                hit = (c["kind"] == kind) & (value == at)
                chosen = F.when(hit, weight) if chosen is None else chosen.when(hit, weight)
        if chosen is not None:
            odds = odds + chosen.otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def _apart(chosen: Column, base: Column) -> Column:
    """Of the candidates, those that overlap no base span and no earlier one of their kind."""
    clear = F.filter(chosen, lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))

    def keep(out: Column, c: Column) -> Column:
        clash = F.exists(out, lambda o: (o["kind"] == c["kind"]) & (o["start"] < c["end"]) & (c["start"] < o["end"]))
        return F.when(clash, out).otherwise(F.concat(out, F.array(c)))

    kind = "array<struct<kind:int,start:int,end:int>>"
    return F.aggregate(clear, F.array().cast(kind), keep)


def _spelled(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _bare(c: Column) -> Column:
    return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document: its id, ``base`` and ``spans``, arrays of struct(kind, start, end) in
    order of kind (a position in ``KINDS``) and start; ``spans`` also has what the method adds."""
    spark = docs.sparkSession
    at = scratch_path(spark, "candidates")
    docs.select(F.col(id_col).alias("id"), candidates(F.coalesce(F.col(text_col), F.lit(""))).alias("found")).write.parquet(at)
    each = spark.read.parquet(at)
    columns = ["kind", *VOTES, *SHAPES]
    patterns = [
        tuple(r)
        for r in each.select(F.explode("found").alias("c")).groupBy(*[F.col(f"c.{n}").alias(n) for n in columns]).count()
        .orderBy(*columns).limit(MAX_PATTERNS).collect()  # fewer than this can exist: no row is left out
    ]
    weights: dict = {}
    if patterns:
        p_true, _ = estimate(patterns)
        weights = fit_classifier(patterns, p_true)
    base = F.transform(F.filter("found", lambda c: c["base"]), _bare)
    more = F.transform(F.filter("found", lambda c: ~c["base"] & (_probability(c, weights) >= threshold)), _bare)
    return each.select(F.col("id").alias(id_col), base.alias("base"), more.alias("__more")).select(
        id_col, F.array_sort("base").alias("base"), F.array_sort(F.concat("base", _apart(F.col("__more"), F.col("base")))).alias("spans")
    )


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text."""

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        id_col,
        *[number(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _spelled(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )
