"""URL filter by association rules.

A URL becomes a set of tokens (parts of its host, path and query).  Spark's
FP-growth mines the token sets of labelled URLs together with their label;
an itemset that holds the label ``bad`` gives a rule "these tokens: bad".
Rules below the support or confidence asked for are pruned, and so is a rule
that a shorter rule with no less confidence covers.  Rules match through an
inverted index: each is filed under its rarest token, so a URL meets only
the rules of its own tokens and then has the rest of their tokens checked.

Explicit host and path rules go first; the longest that fits decides.

A rule must also be more than chance: with ``m`` token sets looked at and a share
``p`` of bad rows among all, a set of ``n`` rows with a share ``c`` of bad ones counts only
if ``n * KL(c, p) >= ln(m / FALSE_RULES)``.  By the Chernoff bound, labels drawn at
random then give ``FALSE_RULES`` rules in expectation at most, at any size of
the input.

Mining runs over all labelled rows, and the support asked for is a number of
bad rows; beyond that a rule needs only as many more as the logarithm of the
number of sets.  Rules of
one token are counted exactly; only tokens of enough bad rows that are not
wholly bad go into FP-growth (a wider set with a wholly bad token is covered
by that token), which keeps its itemsets few.  A rule meets
the distinct URLs that have its rarest token; the result is joined back by
URL, so repeated URLs are judged once.

Defined results: a null URL, or one without ``://``, has an empty host and
path and no tokens, fits no rule and is allowed; repeated rows are each
returned; conflicting labels of one id count as bad; with no labels or no
rule that holds, the method allows; empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import saved

ALLOW, BLOCK = "allow", "block"
LABEL = "label=bad"
#: Share of the rows asked for besides ``MIN_COUNT`` rows: none.
MIN_SUPPORT = 0.0
MIN_CONFIDENCE = 0.6
MIN_COUNT = 5
#: Rules expected at most where labels mean nothing.
FALSE_RULES = 0.01
#: Tokens broadcast at most; more are joined.
BROADCAST_TOKENS = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest (host, path, verdict) rule that
    fits the host or a parent domain and begins the path; null if none."""
    found = F.lit(None)
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens_of(url: Column) -> Column:
    """Distinct tokens: ``h=`` host parts, ``p=`` path parts, ``q=`` query names."""
    def parts(text: Column, mark: str) -> Column:
        words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
        return F.transform(words, lambda w: F.concat(F.lit(mark), w))

    query = F.regexp_extract(_rest(url), r"\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(query, "&"), lambda kv: F.substring_index(kv, "=", 1)), lambda n: n != "")
    return F.array_distinct(F.concat(
        parts(host_of(url), "h="), parts(path_of(url), "p="),
        F.coalesce(F.transform(names, lambda n: F.concat(F.lit("q="), F.lower(n))), F.array().cast("array<string>"))))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_count: int = MIN_COUNT) -> DataFrame:
    """Rules from (url, bad boolean): tokens, index_token, support (rows),
    confidence."""
    spark = labelled.sparkSession
    schema = "tokens array<string>, index_token string, support long, confidence double"
    items = labelled.where(F.col("url").isNotNull()).select(
        F.concat(tokens_of(F.col("url")), F.when(F.col("bad"), F.array(F.lit(LABEL)))
                 .otherwise(F.array().cast("array<string>"))).alias("items"))
    items = saved(items.withColumn("row", F.monotonically_increasing_id()), "url-items")
    n, n_bad = items.agg(F.count(F.lit(1)), F.coalesce(F.count_if(F.array_contains("items", LABEL)), F.lit(0))).first()
    if n_bad == 0:
        return spark.createDataFrame([], schema)
    base = n_bad / n
    least = max(min_count, math.ceil(min_support * n), 1)
    marked = items.select(F.array_contains("items", LABEL).cast("long").alias("bad"),
                          F.explode(F.array_remove("items", LABEL)).alias("token"))
    counts = marked.groupBy("token").agg(F.count(F.lit(1)).alias("freq"), F.sum("bad").alias("support"))
    counts = saved(counts.where(F.col("freq") >= least), "url-tokens")
    n_sets = counts.count()
    counts = counts.where(F.col("support") >= least)
    share = F.col("support") / F.col("freq")
    alone = counts.where(share >= min_confidence).select(F.array("token").alias("tokens"), "support", share.alias("confidence"))
    mixed = counts.where("support < freq").select("token")
    if mixed.count() <= BROADCAST_TOKENS:
        mixed = F.broadcast(mixed)
    pruned = (items.select("row", F.array_contains("items", LABEL).alias("bad"), F.explode("items").alias("token"))
              .join(mixed, "token").groupBy("row", "bad").agg(F.collect_list("token").alias("items")))
    pruned = pruned.select(F.when(F.col("bad"), F.array_append("items", F.lit(LABEL))).otherwise(F.col("items")).alias("items"))
    pruned = saved(pruned.where(F.size("items") > 1), "url-pruned")
    kept = pruned.count()
    rules = alone
    if kept:
        # Half a row less, so that rounding cannot ask for one more.
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / kept), minConfidence=1.0).fit(pruned)
        sets = saved(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
        n_sets += sets.where(~F.array_contains("items", LABEL) & (F.size("items") > 1)).count()
        bad = (sets.where(F.array_contains("items", LABEL) & (F.size("items") > 2))
               .select(F.array_remove("items", LABEL).alias("items"), F.col("freq").alias("support")))
        wider = (bad.join(sets, "items").select(F.col("items").alias("tokens"), "support",
                                                (F.col("support") / F.col("freq")).alias("confidence"))
                 .where(F.col("confidence") >= min_confidence))
        rules = alone.unionByName(wider)
    rules = saved(rules.where(_evidence(F.col("support"), F.col("confidence"), base) >= math.log(n_sets / FALSE_RULES)),
                  "url-mined") if n_sets else rules
    # A covering rule begins with one of the covered rule's tokens.
    wide = rules.select("tokens", "confidence", F.explode("tokens").alias("first"))
    short = rules.select(F.col("tokens").alias("t2"), F.col("confidence").alias("c2"), F.col("tokens")[0].alias("first"))
    covered = (wide.join(short, "first").where(
        (F.size("t2") < F.size("tokens")) & (F.col("c2") >= F.col("confidence"))
        & (F.size(F.array_except("t2", "tokens")) == 0)).select("tokens").distinct())
    rules = rules.join(covered, "tokens", "left_anti")
    single = counts.select("token", "freq")
    rarest = (rules.select("tokens", F.explode("tokens").alias("token")).join(single, "token")
              .groupBy("tokens").agg(F.min(F.struct("freq", "token")).alias("r"))
              .select("tokens", F.col("r.token").alias("index_token")))
    return rules.join(rarest, "tokens").select("tokens", "index_token", "support", "confidence")


def _evidence(support: Column, confidence: Column, base: float) -> Column:
    """n * KL(confidence, base) in nats: how far beyond the base rate a rule is."""
    if base >= 1:
        return F.lit(0.0)  # all rows are bad: no token tells anything
    good = F.when(confidence < 1, (1 - confidence) * F.ln((1 - confidence) / (1 - base))).otherwise(0.0)
    gain = confidence * F.ln(confidence / base) + good
    return F.when(confidence > base, support / confidence * gain).otherwise(0.0)


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct URLs that fit a mined rule: url, matched (tokens of the most
    confident rule), confidence."""
    sets = urls.select("url").where(F.col("url").isNotNull()).distinct().withColumn("have", tokens_of(F.col("url")))
    met = sets.select("url", "have", F.explode("have").alias("index_token")).join(rules, "index_token")
    fit = met.where(F.size(F.array_except("tokens", "have")) == 0)
    best = F.max(F.struct("confidence", "support", "tokens")).alias("b")
    return fit.groupBy("url").agg(best).select("url", F.col("b.tokens").alias("matched"),
                                               F.col("b.confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, fixed: list[tuple[str, str, str]],
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
          min_count: int = MIN_COUNT) -> DataFrame:
    """page_id, url, host, path, rule, verdict, matched of every page; labels
    are (doc_id, quality, toxic) by page id, bad when quality is 0 or toxic 1."""
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"))
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("bad"))
    mined = mine(pages.join(known, "page_id").select("url", "bad"), min_support, min_confidence, min_count)
    hit = matches(pages, saved(mined, "url-rules"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    out = pages.select("page_id", "url", host.alias("host"), path.alias("path")).join(hit, "url", "left")
    out = out.withColumn("__fit", fitting_rule(F.col("host"), F.col("path"), fixed).cast("struct<rule:string,verdict:string>"))
    method = F.when(F.col("matched").isNotNull(), BLOCK).otherwise(ALLOW)
    return out.select("page_id", "url", F.coalesce("host", F.lit("")).alias("host"),
                      F.coalesce("path", F.lit("")).alias("path"), F.col("__fit.rule").alias("rule"),
                      F.coalesce("__fit.verdict", method).alias("verdict"), "matched", "confidence")
