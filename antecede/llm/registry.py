"""The queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from antecede.llm import (
    bm25_search,
    byte_bpe,
    chat_format,
    line_dedup,
    mixing,
    periodic_runs,
    pii,
    quality_crf,
    sampling,
    secret_forest,
    simhash,
    suffix_dedup,
    whitening,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, links at four bits."""
    return simhash.near_duplicates(_documents(spark, sf_dir), words=4, max_distance=4)


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the labelled ones that are not held out."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_crf.classify(docs, labels).select(
        "doc_id",
        F.col("__held_out").alias("held_out"),
        F.col("__score").alias("score"),
        F.col("__predicted").alias("predicted"),
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by the 50k byte-level vocabulary, and back."""
    return byte_bpe.digests(_documents(spark, sf_dir), byte_bpe.public_vocabulary())


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that an earlier document has are removed."""
    found = suffix_dedup.remove_repeats(_documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents, by all words, for every document whose id is divisible by 20."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return bm25_search.search(docs, docs.where("doc_id % 20 = 0"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail and IP addresses, card and phone numbers of every document."""
    return pii.digests(pii.find_personal_data(_documents(spark, sf_dir)))


def op7_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, false positives removed by the forest."""
    return secret_forest.find_secrets(_documents(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of at least one code point in ten or more documents lose all occurrences."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    kept = line_dedup.drop_lines(docs, min_docs=10, min_chars=1)
    return kept.select(
        "doc_id",
        F.col("__lines").alias("n_lines"),
        F.col("__dropped").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 3, 1, 2 in turn share 150 % of all words; no source above twice its own."""
    docs = _documents(spark, sf_dir).select("doc_id", "text", "source")
    mixed = mixing.mix(docs, weights=(3, 1, 2), share=1.5, limit=2.0)
    return mixed.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__size") * F.col("__copies")).alias("taken"),
    )


def op10_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited form."""
    return sampling.edit_likeness(_documents(spark, sf_dir))


def with_planted_runs(mark: Column, text: Column) -> Column:
    """The text; where the remainder of ``mark`` by 10 is 0, its words from some place on are
    replaced by a stretch of them over and over."""

    @pandas_udf("string")
    def planted(marks: pd.Series, texts: pd.Series) -> pd.Series:
        out = []
        for h, text in zip(marks, texts, strict=True):
            if text is not None and h % 10 == 0:  # a null mark is not
                words = text.encode("utf-8", "surrogatepass").split()
                if n := len(words):
                    g = int(h) // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    words[a:] = (words[a : a + p] * -(-(n - a) // p))[: n - a]
                    text = b" ".join(words).decode("utf-8", "surrogatepass")
            out.append(text)
        return pd.Series(out, dtype=object)

    return planted(mark, text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words with a period, in texts of which a tenth have one planted."""
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = _documents(spark, sf_dir).select("doc_id", with_planted_runs(mark, F.col("text")).alias("text"))
    found = periodic_runs.add_runs(docs, into="found", min_length=6, min_periods=4)
    best = periodic_runs.longest(F.col("found.runs"))
    return found.select("doc_id", "found", best.alias("best")).select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.listed(F.col("found.runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of every embedding."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    found = whitening.whiten(vectors, whitening.fit(vectors, components=8))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


#: A conversation whose texts are control strings.
AWKWARD = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(AWKWARD, rows.schema)
    return chat_format.read_back(chat_format.format_conversations(rows.unionByName(more)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash_near_dedup, op2_quality_crf, op3_byte_bpe, op4_suffix_dedup, op5_topk_search, op6_personal_data, op7_secret_forest, op8_line_dedup, op9_source_mix, op10_weighted_sampling, op11_periodic_runs, op12_embedding_whitening, op13_chat_format)
}

ORACLES: dict[str, str] = {
    "op13_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), measured AS (
  SELECT *, regexp_replace(text, '(<|\[)(\\*)(<SYS>>|</SYS>>|INST\]|/INST\]|s>|/s>|\|name\|>|\|/name\|>|\|end\|>)', '\1\2\\\3', 'g') AS escaped
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(escaped) + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 8
           ELSE 25 + length(role) END)::BIGINT AS formatted_chars
FROM measured GROUP BY conv_id
""",
    "op5_topk_search": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+')) AS word
  FROM documents
), counted AS (
  SELECT doc_id, word, count(*) AS tf FROM words GROUP BY doc_id, word
), lengths AS (
  SELECT doc_id, sum(tf) AS dl FROM counted GROUP BY doc_id
), whole AS (
  SELECT (SELECT count(*) FROM documents)::DOUBLE AS n,
         (SELECT sum(dl) FROM lengths)::DOUBLE / (SELECT count(*) FROM documents) AS mean_length
), idfs AS (
  SELECT word, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM counted, whole GROUP BY word, n
), chosen AS (
  SELECT doc_id AS query_id, word, idf FROM counted JOIN idfs USING (word) WHERE doc_id % 20 = 0
), scored AS (
  SELECT query_id, doc_id,
         sum(floor(idf * tf * (1.2::DOUBLE + 1) / (tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * dl / mean_length)) * 1000000 + 0.5)::BIGINT) AS micro
  FROM chosen JOIN counted USING (word) JOIN lengths USING (doc_id), whole
  GROUP BY query_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY micro DESC, doc_id) AS rank FROM scored
)
SELECT query_id, rank, doc_id, micro::DOUBLE / 1000000 AS score FROM ranked WHERE rank <= 10
""",
    "op8_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT keyed.*, frequent.key IS NOT NULL AS gone FROM keyed LEFT JOIN frequent USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
}
