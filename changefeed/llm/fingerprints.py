"""Bottom-k sketches of shingle hashes.

A sketch is the ``k`` smallest distinct 64-bit hashes of a text's word
shingles, ascending.  Sketches of parts merge into the sketch of the whole,
and two sketches give resemblance, containment and the number of distinct
shingles; all are exact for texts with at most ``k`` shingles.

Built-in functions only.  A sketch is made within its own row.  The neighbour
in id order is found on small rows (two hashes and an id, range partitioned);
the texts themselves move once by a hash that no hot key can skew, and the
part of the neighbour's text that is needed moves once more.

Defined results: a null text is an empty one and has an empty sketch; a text
of one to four words has one shingle, all its words; two empty sketches
resemble each other (1.0), an empty and a non-empty one do not (0.0); rows
with equal id and text follow one another; null ids come after all others;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm.common import saved, text_or_empty, words_of
from changefeed.operators import once

K = 128
SHINGLE = 5
_MAX = float(2**64)


def _shingles(words: str, size: int) -> str:
    """SQL: hashes of the shingles of an array column of words."""
    parts = ", ".join(f"{words}[i + {j}]" if j else f"{words}[i]" for j in range(size))
    return (f"CASE WHEN size({words}) = 0 THEN array() "
            f"WHEN size({words}) < {size} THEN array(xxhash64(concat_ws(' ', {words}))) "
            f"ELSE transform(sequence(0, size({words}) - {size}), i -> xxhash64({parts})) END")


def sketch(df: DataFrame, text: Column, to: str, k: int = K, size: int = SHINGLE) -> DataFrame:
    """Add ``to`` (array of long): the sketch of a text column."""
    df = once(df, words_of(text), "__words")
    hashes = F.expr(_shingles("__words", size)).cast("array<bigint>")
    return once(df, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k), to).drop("__words")


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two texts' union."""
    return F.slice(F.sort_array(F.array_distinct(F.concat(a, b))), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1."""
    both = merged(a, b, k)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles (exact below ``k``)."""
    kth = (F.element_at(a, -1).cast("double") + 2.0**63 + 1) / _MAX
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / kth)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1 (an empty a: 1)."""
    inside = resemblance(a, b, k) * distinct_count(merged(a, b, k), k) / distinct_count(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), inside))


def merge_parts(parts: DataFrame, key: str, sketch_col: str, k: int = K) -> DataFrame:
    """The sketch of each key's union of parts.  Hashes are made distinct
    with map-side combination, then ranked; no list of parts is gathered."""
    hashes = parts.select(key, F.explode(sketch_col).alias("__h")).distinct()
    low = F.row_number().over(Window.partitionBy(key).orderBy("__h"))
    return (hashes.withColumn("__r", low).where(F.col("__r") <= k)
            .groupBy(key).agg(F.sort_array(F.collect_list("__h")).alias(sketch_col)))


def as_text(a: Column) -> Column:
    """A sketch as text: 16 hex digits per hash."""
    return F.concat_ws("", F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")))


def _followers(keyed: DataFrame) -> DataFrame:
    """Per distinct (k1, k2) in descending id order: copies, the length of
    the row before (pred_n) and its key, the ends joined to a ring."""
    ring = keyed.groupBy("k1", "k2").agg(F.max("doc_id").alias("doc_id"), F.max("n").alias("n"),
                                         F.count(F.lit(1)).alias("copies"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("k1"), F.col("k2")]
    placed = saved(ring.repartitionByRange(*order).withColumn("pid", F.spark_partition_id()), "id-order")
    within = Window.partitionBy("pid").orderBy(*order)
    own = F.struct("k1", "k2", "n")
    rows = placed.withColumn("pred", F.lag(own).over(within))
    # One row per partition: its last row, which precedes the next one's first.
    last = placed.groupBy("pid").agg(F.max_by(own, F.struct(
        F.col("doc_id").isNull(), F.bitwise_not("doc_id"), F.col("k1"), F.col("k2"))).alias("tail"))
    chain = Window.orderBy("pid")
    everything = chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = last.select("pid", F.coalesce(F.lag("tail").over(chain), F.last("tail").over(everything)).alias("before"))
    return (rows.join(ends, "pid")
            .select("k1", "k2", "copies", F.coalesce("pred", "before").alias("p"))
            .select("k1", "k2", "copies", F.col("p.k1").alias("p1"), F.col("p.k2").alias("p2"), F.col("p.n").alias("pred_n")))


def with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """Every row with its sketch, and of the next row in descending doc_id
    order (the first after the last) the sketch and as much text as half the
    row's own length: doc_id, text, n, fp, next_doc_id, next_fp, next_text."""
    t = text_or_empty()
    rows = docs.select(F.col("doc_id"), t.alias("text"))
    rows = rows.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64("text", "doc_id"), "n": F.length("text")})
    follow = _followers(rows.drop("text"))
    copy = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("n"))
    here = sketch(rows.withColumn("copy", copy).join(follow.drop("p1", "p2", "pred_n"), ["k1", "k2"]), F.col("text"), "fp", k)
    # Any one copy stands for its text here.  The columns are those of
    # ``here``, so that the texts' exchange is made once and used twice (an
    # equality here would become a join key and deal the texts anew).
    there = rows.withColumn("copy", copy).join(follow, ["k1", "k2"]).where(F.col("copy") >= F.col("copies"))
    there = sketch(there, F.col("text"), "next_fp", k)
    there = there.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("doc_id").alias("next_id"), "next_fp",
                         F.expr("substring(text, 1, cast(pred_n div 2 as int))").alias("next_text"))
    out = here.join(there, ["k1", "k2"], "left")
    same = F.col("copy") < F.col("copies")  # the next row is another copy of this one
    return out.select("doc_id", "text", "n", "fp",
                      F.when(same, F.col("doc_id")).otherwise(F.col("next_id")).alias("next_doc_id"),
                      F.when(same, F.col("fp")).otherwise(F.col("next_fp")).alias("next_fp"),
                      F.when(same, F.expr("substring(text, 1, cast(n div 2 as int))"))
                      .otherwise(F.col("next_text")).alias("next_text"))
