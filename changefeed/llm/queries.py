"""The registered queries of the operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.llm import bagminhash, binslack, bpe, collocations, fingerprints, fixity, gnat, htmltext, kneser, packing, rules, scoring, urlrules
from changefeed.llm.common import saved, table
from changefeed.llm.oracle import ORACLE_SQL  # noqa: F401
from changefeed.operators import once


#: (host, path, verdict)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    got = htmltext.extract(table(spark, sf_dir, "pages"))
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's perplexity, its language's threshold and verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    got = kneser.classify(docs, table(spark, sf_dir, "labels"), keep_columns=False)
    return got.select("doc_id", F.col("kn_model").alias("model"), F.col("kn_symbols").alias("n_symbols"),
                      "perplexity", "threshold", "kept")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the fixed rules, else by the mined ones."""
    judged = urlrules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "matched")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measurements, base verdict and policy verdict."""
    marked = rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    judged = rules.apply_policy(marked).withColumn(
        "base_failed", F.col("failed").bitwiseAND(F.lit(rules.policy_mask("base/1")).cast("long")) != 0)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "failed")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, against its edited text's and the next
    document's."""
    rows = fingerprints.with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    edited = F.concat(F.expr("substring(text, 1, cast(n - n div 2 as int))"), "next_text")
    rows = once(rows, edited, "edited").drop("text", "next_text")
    rows = fingerprints.sketch(rows, F.col("edited"), "edited_fp")
    return rows.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("fp")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fingerprints.resemblance(F.col("fp"), F.col("next_fp")).alias("near_next"), "next_doc_id")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count and the digests of its ids and of the
    bytes they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, path, pattern).drop("text")
    both = bpe.decode(ids, path, pattern)
    joined = F.concat_ws(",", F.col("token_ids").cast("array<string>"))
    return saved(both.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                             F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")), "op6")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id of its class of near-duplicates."""
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged records of a replica of the pages' archive: in it, every
    97th page has one byte changed, every 211th is lost, every 389th stands
    twice and every 13th file is cut short."""
    pages = table(spark, sf_dir, "pages")
    good = fixity.records(pages)
    bad_byte = F.expr("overlay(record PLACING '~' FROM 6 FOR 1)")
    other = good.withColumn("record", F.when(F.expr("page_id % 97 = 13"), bad_byte).otherwise(F.col("record")))
    other = other.where(~F.coalesce(F.expr(f"file % 13 = 5 AND page_id % {fixity.PER_FILE} >= 1900"), F.lit(False)))
    times = F.expr("CASE WHEN page_id % 211 = 57 THEN 0 WHEN page_id % 389 = 101 THEN 2 ELSE 1 END")
    other = other.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), times))).drop("__copy")
    other = other.withColumn("seat", F.expr("idx + CASE page_id % 503 WHEN 7 THEN 1 WHEN 8 THEN -1 ELSE 0 END"))
    found = fixity.audit(fixity.tree(good, name="primary"), fixity.tree(other, name="replica"))
    return found.select("page_id", "file", "idx", F.col("start").alias("offset"), "length", "status", "expected", "found")


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's scores under the word counts and the byte trie."""
    return scoring.score(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequences."""
    pieces = packing.pack(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return saved(pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"), "op10")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 phrases."""
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor's positives."""
    return gnat.mine(gnat.prepared(table(spark, sf_dir, "embeddings")))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in shared sequences."""
    pieces = binslack.pack(table(spark, sf_dir, "documents"),
                           public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_url_filter": op3_url_filter,
    "op4_quality_rules": op4_quality_rules,
    "op5_fingerprints": op5_fingerprints,
    "op6_bpe": op6_bpe,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_fixity": op8_fixity,
    "op9_lm_scores": op9_lm_scores,
    "op10_packing": op10_packing,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_best_fit_packing": op13_best_fit_packing,
}
