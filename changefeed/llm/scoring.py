"""Language-model scores of documents against a held-out split.

Documents whose crc32 of the id (as text) leaves 2 when divided by 7 are held
out; the others are learnt from.  ``base_score`` is an add-one unigram model
over words, ``score`` the pretrained byte trie of :mod:`changefeed.llm.ppm`
over the same words, joined by one space.

Words: the counts of the commonest words (a fixed number) are broadcast, so
the words that fill most of every text are settled in place; the rest are
counted per document and joined with their counts by word.  A common word
therefore never makes a hot join key.

Defined results: a null text is an empty one (the end token alone); a null
doc_id counts as the empty text for the split; repeated rows are scored each;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm import ppm
from changefeed.llm.common import SPACE, WORD, saved, text_or_empty

HELD_OUT_OF, HELD_OUT = 7, 2
#: Words settled by broadcast.
COMMON_WORDS = 100_000
_WORD = re.compile(WORD)
_ODD_SPACE = re.compile(r"[^\S\x20\x09-\x0D]|[\x1c-\x1f]")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str) -> list[str]:
    return _WORD.findall(text) if _ODD_SPACE.search(text) else text.split()


def _prepared(docs: DataFrame) -> DataFrame:
    """uid, doc_id, held_out, text with A-Z in lower case."""
    lower = F.translate(text_or_empty(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id",
                       (crc % HELD_OUT_OF == HELD_OUT).alias("held_out"), lower.alias("text"))


def _joined(text: str = "text"):
    """The words of a text column, one space between, as bytes."""
    return F.trim(F.regexp_replace(text, SPACE, " ")).cast("binary")


def word_counts(texts: DataFrame) -> DataFrame:
    """word, c over a ``text`` column, each task's counts added up first."""
    def out(seen):
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "c"])

    def run(batches):
        seen: Counter[str] = Counter()
        for batch in batches:
            for t in batch.column(0):
                seen.update(words(t.as_py()))
                if len(seen) > 200_000:
                    yield out(seen)
                    seen.clear()
        yield out(seen)

    return texts.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _words_per_doc(rows: DataFrame, common) -> DataFrame:
    """Per row one line with its number of tokens and, over the common words,
    known tokens and summed logs, then a line per other word with its count."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"uid long, doc_id {id_type}, held_out boolean, word string, n long, "
              "known long, log_sum double")
    names = ["uid", "doc_id", "held_out", "word", "n", "known", "log_sum"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.float64()]

    def run(batches):
        table = common.value
        for batch in batches:
            texts = batch.column(3)
            at: list[int] = []
            lines: list[tuple] = []
            for i, t in enumerate(texts):
                ws = words(t.as_py())
                rest, known, logs = [], 0, 0.0
                for w, k in Counter(ws).items():
                    v = table.get(w)
                    if v is None:
                        rest.append((w, k, 0, 0.0))
                    else:
                        known += k
                        logs += k * v
                lines.append((None, len(ws) + 1, known, logs))
                lines += rest
                at += [i] * (len(rest) + 1)
                if len(lines) > 100_000 or i == len(texts) - 1:
                    take = pa.array(at, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(take) for c in range(3)),
                         *(pa.array(c, kind) for c, kind in zip(zip(*lines), types))], names=names)
                    at, lines = [], []

    return rows.select("uid", "doc_id", "held_out", "text").mapInArrow(run, schema)


def score(docs: DataFrame, order: int = ppm.ORDER, common_words: int = COMMON_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    # Written once: numbered anew, a lost executor could give rows other ids.
    rows = saved(_prepared(docs), "prepared")
    learnt = rows.where(~F.col("held_out"))
    counts = saved(word_counts(learnt), "words")
    ends = learnt.select("uid").count()
    stats = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    n_train = (stats[0] or 0) + ends
    distinct = stats[1] + (1 if ends else 0)
    smooth = n_train + distinct + 1
    top = counts.orderBy(F.desc("c"), "word").limit(common_words).toArrow()
    table = {w: math.log10(c + 1) for w, c in zip(top.column(0).to_pylist(), top.column(1).to_pylist())}
    common = spark.sparkContext.broadcast(table)

    shards = ppm.train(learnt.select(_joined().alias("bytes")), order)
    # Two passes, so that a core has one Python worker at a time.
    scored = ppm.pretrained(rows.select("uid", _joined().alias("bytes")), shards)
    scored = saved(scored.select("uid", "score"), "scores")
    parts = saved(_words_per_doc(rows, common), "word-lines")
    rest = (parts.where(F.col("word").isNotNull()).select("uid", "word", "n").join(counts, "word")
            .groupBy("uid").agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_log")))
    zero = F.lit(0)
    return parts.where(F.col("word").isNull()).join(scored, "uid").join(rest, "uid", "left").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more_known", zero) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("log_sum") + F.coalesce("more_log", F.lit(0.0)) + F.lit(math.log10(ends + 1))
         - F.col("n") * F.lit(math.log10(smooth))).alias("base_score"),
        "score")
