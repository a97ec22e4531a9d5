"""Secret scanning with a random forest against false positives, in DataFrame expressions and
Spark's own tree learner throughout.

Candidates are all values assigned to a name such as ``password``, of any length and any characters;
other values after ``=`` or ``:`` or in quotes, of any characters but white space; and runs of letters,
digits and ``_+/.~-`` with their padding, every one between ``=`` signs. The last two count from 12
characters on, with a digit or a change from lower to upper case. A value in quotes ends at the quote
(or the line's end, then at white space), another at white space, a quote or the next assignment, less
``.,;`` at its end. Each is described by its length, how its
characters follow each other (changes between letters, digits and others, entropy, repeated
pairs), how much of it is made of the corpus's ordinary words, what the path or link around it looks
like, and the words before and after it. A forest trained on labelled findings gives each the
probability of being a secret; those below the threshold are dropped as false positives.

Labelled findings can be handed in. Where there are none they are made from the candidates by rule:
a finding is true if a provider's published token form or an assignment to a name such as
``password`` carries a value that looks random, and false if it is an ordinary word, a placeholder,
a version, a path, a hash named as such or a plain number. The forest sees not which form
or name it is, but whether a secret-like or a hash-like name precedes (``named``, ``hash_named``, which
the rule uses too). At most ``MAX_TRAINING`` findings of each label are used, those of
least hash.

The dictionary is the ``DICTIONARY`` most frequent short letter runs of the corpus (counted over all
of it), a fixed number.

Defined results: a null or empty text has no findings; an empty table gives an empty result, also
for want of findings of either label (then every candidate is kept with probability 0.5); rows with
equal ids have findings each of their own.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from antecede.session import scratch_path

MAX_TRAINING = 20_000
DICTIONARY = 2000
THRESHOLD = 0.5
TREES, DEPTH = 40, 8
_CONTEXT = 40
_LOT = 64
_SHORTEST = 12

_PLAIN = r"[A-Za-z0-9_+/.~-]"
_NAME = r"(?i:passw(?:or)?d|pwd|secret|token|api[_-]?key|auth|credential|private[_-]?key)"
_NAMED = rf"{_NAME}[\"']?\s*+[=:]\s*+"
_DELIMITER = "&;,?:|/"
#: Up to white space, a quote or the next assignment.
_VALUE = rf"[^\s\"'{_DELIMITER}]*+(?:[{_DELIMITER}](?![\w.-]+=|[\"']?[\w.-]*?{_NAMED})[^\s\"'{_DELIMITER}]*+)*+"
_OTHER = r"(?:[=:]\s*+[\"']?|[\"'])"
#: A run with its padding.
RUN = rf"(?=[A-Za-z0-9_+/=.~-]{{{_SHORTEST}}}){_PLAIN}++(?:=++(?!{_PLAIN}))?+"
#: A name and the value assigned to it; of names one after the other the last.
ASSIGNED = (
    rf"{_NAMED}(?:\"(?![^\"\r\n]*?{_NAMED})[^\"\r\n]++\"|'(?![^'\r\n]*?{_NAMED})[^'\r\n]++'|"
    rf"[\"']?(?!{_NAMED}){_VALUE})"
)
#: Any other assigned or quoted value.
OTHER = rf"{_OTHER}(?=[^\s\"']{{{_SHORTEST}}}){_VALUE}"
#: Published forms of tokens.
FORMS = r"(AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|xox[abprs]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35}|sk_live_[0-9A-Za-z]{16,}|eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]*"
NAMES = r"(?i)(passw(or)?d|pwd|secret|token|api[_-]?key|auth|credential|private[_-]?key)[\"']?\s*[=:]\s*[\"']?$"
HASH_NAMES = r"(?i)(sha[0-9-]*|md5|commit|checksum|digest|uuid|guid|hash|rev(ision)?)\s*[=:]?\s*[\"']?$"
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|0000|1234567|abcdef"
MEASURES = (
    "n", "upper", "lower", "digit", "other", "turns", "entropy", "pairs", "covered", "hexed",
    "path", "dots", "assigned", "quoted", "named", "hash_named", "words_before", "spaced",
)


def _runs(text: Column, pattern: str = RUN) -> Column:
    """Every match: array of struct(start, end, match, before, after), in code points."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string>>")

    def laid(both: Column) -> Column:
        gap, hit = both["gaps"], both["hits"]
        n = F.size(hit)
        lots = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(_LOT))).otherwise(F.array().cast("array<int>"))

        def members(first: Column) -> Column:
            return F.sequence(first, F.least(first + _LOT, n) - 1)

        def span(first: Column) -> Column:
            return F.aggregate(members(first), F.lit(0), lambda s, i: s + F.length(F.get(gap, i)) + F.length(F.get(hit, i)))

        def place(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.get(gap, i))
            end = start + F.length(F.get(hit, i))
            last = F.coalesce(F.right(F.get(hit, i - 1), F.lit(_CONTEXT)), F.lit(""))
            one = F.struct(
                start.alias("start"), end.alias("end"), F.get(hit, i).alias("match"),
                F.right(F.concat(last, F.right(F.get(gap, i), F.lit(_CONTEXT))), F.lit(_CONTEXT)).alias("before"),
                F.left(F.get(gap, i + 1), F.lit(_CONTEXT)).alias("after"),
            )
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

        def matches(spans: Column) -> Column:
            def lot(first: Column, k: Column) -> Column:
                begin = F.aggregate(F.slice(spans, F.lit(1), k), F.lit(0), lambda s, x: s + x)
                return F.aggregate(members(first), F.struct(begin.alias("at"), empty.alias("out")), place, lambda s: s["out"])

            return F.flatten(F.transform(lots, lot))

        return F.get(F.transform(F.array(F.transform(lots, span)), matches), F.lit(0))

    return F.get(F.transform(F.array(F.struct(gaps.alias("gaps"), hits.alias("hits"))), laid), F.lit(0))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``start``, ``end``, ``match``, ``before``, ``after`` of every candidate. What leads to a
    value (``password=...``) counts as what comes before it."""
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    none = F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string,kind:int>>")

    def scanned(kind: int, pattern: str) -> Column:
        found = F.transform(_runs(text, pattern), lambda c: c.withField("kind", F.lit(kind)))
        return F.when(text.rlike(pattern), found).otherwise(none)

    every = F.concat(scanned(0, RUN), scanned(1, ASSIGNED), scanned(2, OTHER))
    found = source.select("id", F.explode(every).alias("c")).select("id", "c.*")
    named, other = F.col("kind") == 1, F.col("kind") == 2
    lead = F.when(named, F.regexp_extract("match", rf"^{_NAMED}[\"']?", 0)).when(other, F.regexp_extract("match", f"^{_OTHER}", 0))
    led = found.withColumn("lead", F.coalesce(lead, F.lit("")))
    led = led.withColumn("rest", F.expr("substr(match, length(lead) + 1)")).withColumn("before", F.concat("before", "lead"))
    opened = F.right("lead", F.lit(1)).isin("'", '"')
    closed = opened & (F.right("rest", F.lit(1)) == F.right("lead", F.lit(1)))
    value = F.when(closed, F.expr("left(rest, length(rest) - 1)")).when(opened, F.col("rest"))
    led = led.withColumn("value", F.coalesce(value, F.regexp_replace("rest", "[.,;]+$", "")))
    start = F.col("start") + F.length("lead")
    length, mixed = F.length("value"), F.col("value").rlike("[0-9]|[a-z][A-Z]")
    # A value that follows a name is found with it, a plain one as a run.
    again = F.col("before").rlike(NAMES) | other & F.col("value").rlike(f"^{_PLAIN}+=*$")
    return led.where(F.when(named, length > 0).otherwise((length >= _SHORTEST) & mixed & ~again)).select(
        "id", start.alias("start"), (start + length).cast("int").alias("end"), F.col("value").alias("match"), "before", "after"
    )


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """The most frequent letter runs of three to eight letters, in lower case."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"\b[a-z]{3,8}\b"), F.lit(0))).alias("word"))
    top = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(size)
    return [r["word"] for r in top.collect()]  # ``size`` words


def _share(x: Column, pattern: str, n: Column) -> Column:
    return F.length(F.regexp_replace(x, pattern, "")).cast("double") / n


def _entropy(x: Column) -> Column:
    n = F.length(x).cast("double")
    each = F.transform(F.array_distinct(F.split(x, "")), lambda c: (n - F.length(F.replace(x, c, F.lit("")))) / n)
    return F.aggregate(each, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def _pairs(x: Column) -> Column:
    """The number of different pairs of neighbouring characters, 1 at least."""
    chars, last = F.split(x, ""), F.greatest(F.length(x) - 1, F.lit(0))
    both = F.zip_with(F.slice(chars, F.lit(1), last), F.slice(chars, F.lit(2), last), lambda a, b: F.concat(a, b))
    return F.greatest(F.size(F.array_distinct(both)), F.lit(1))


def measured(found: DataFrame, words: list[str]) -> DataFrame:
    """``found`` with the columns ``MEASURES``, each of the whole candidate."""
    match, before = F.col("match"), F.col("before")
    n = F.length(match).cast("double")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(match, "[A-Z]+", "U"), "[a-z]+", "l"), "[0-9]+", "d")
    known = "|".join(sorted(words, key=lambda w: (-len(w), w))) or "(?!)"
    return found.select(
        "*",
        n.alias("n"),
        _share(match, "[^A-Z]", n).alias("upper"),
        _share(match, "[^a-z]", n).alias("lower"),
        _share(match, "[^0-9]", n).alias("digit"),
        _share(match, "[A-Za-z0-9]", n).alias("other"),
        (F.length(kinds) / n).alias("turns"),
        _entropy(match).alias("entropy"),
        (_pairs(match) / n).alias("pairs"),
        (F.lit(1.0) - F.length(F.regexp_replace(F.lower(match), known, "")) / n).alias("covered"),
        match.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hexed"),
        (match.rlike("/[a-z]+/|^[a-z]+/") | before.rlike(r"(?i)(https?:|www\.|\\|/)$")).cast("double").alias("path"),
        _share(match, "[^.]", n).alias("dots"),
        before.rlike(r"[=:]\s*[\"']?$").cast("double").alias("assigned"),
        before.rlike("[\"']$").cast("double").alias("quoted"),
        before.rlike(NAMES).cast("double").alias("named"),
        before.rlike(HASH_NAMES).cast("double").alias("hash_named"),
        F.size(F.split(F.trim(before), r"\s+")).cast("double").alias("words_before"),
        F.col("after").rlike(r"^[\"']?(\s|[.,;!]|$)").cast("double").alias("spaced"),
    )


def rule_labels(found: DataFrame) -> DataFrame:
    """``found`` (with measures) with ``label``: 1, 0, or null where the rule can't tell."""
    match = F.col("match")
    random = (F.col("entropy") > 2.8) & (F.col("covered") < 0.6) & ~match.rlike(PLACEHOLDER)
    ordinary = (
        match.rlike(PLACEHOLDER)
        | match.rlike("^[0-9.-]+$")
        | (F.col("hash_named") == 1)
        | (F.col("path") == 1)
        | ((F.col("named") == 0) & (F.col("digit") == 0))
        | (F.col("covered") > 0.6)
    )
    known = match.rlike(f"^({FORMS})$") | (F.col("named") == 1)
    return found.withColumn("label", F.when(known & random, 1.0).when(ordinary & ~known, 0.0))


def _sampled(labelled: DataFrame, each: int) -> DataFrame:
    """At most ``each`` findings of each label, those of least hash; equal strings count once."""
    one = labelled.where("label is not null").dropDuplicates(["match", "before"])
    order = [F.xxhash64("match", "before"), F.col("match"), F.col("before")]
    return one.where("label = 1").orderBy(*order).limit(each).unionByName(one.where("label = 0").orderBy(*order).limit(each))


def find_secrets(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    max_training: int = MAX_TRAINING,
) -> DataFrame:
    """``doc_id``, ``start``, ``end``, ``match``, ``probability`` of the findings kept. ``labelled``
    has ``match``, ``before``, ``after`` and ``label`` (1.0 or 0.0) of checked findings."""
    spark = docs.sparkSession
    words = dictionary(docs, text_col)
    at = scratch_path(spark, "secret-candidates")
    measured(candidates(docs, id_col, text_col), words).write.parquet(at)
    found = spark.read.parquet(at)
    train_at = scratch_path(spark, "labelled-findings")
    _sampled(rule_labels(found) if labelled is None else measured(labelled, words), max_training).write.parquet(train_at)
    train = spark.read.parquet(train_at)
    out = F.col("id").alias(id_col), "start", "end", "match"
    if train.select("label").distinct().count() < 2:
        return found.select(*out, F.lit(0.5).alias("probability"))
    vectors = VectorAssembler(inputCols=list(MEASURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featureSubsetStrategy="sqrt", maxMemoryInMB=64)
    model = forest.fit(vectors.transform(train).select("features", "label"))
    scored = model.transform(vectors.transform(found)).withColumn("probability", vector_to_array("probability")[1])
    return scored.where(F.col("probability") >= threshold).select(*out, F.round("probability", 6).alias("probability"))
