"""Quality rules as a bitmask ledger.

``ledger`` measures every whole text once and stores, per row, the
measurements and one bit per failed rule (``failed``).  A policy is a named,
versioned set of rules; ``apply_policy`` and ``ablation`` only read the bits,
so a new policy or an ablation never touches the texts again.

Built-in functions only.  Everything about one text is computed in its own
row, so no shuffle takes place and a hot source or a group of copies costs
nothing extra.  Repeated 3-word windows are found by sorting one 64-bit key
per window (hash and place); windows whose hash parts agree are then
compared as text, so the counts are exact.

Defined results: a null or empty text has no words and all counts 0 (the
rules that need words fail); rows are judged one by one, so ties and repeated
rows are all kept in the ledger; extra columns are carried through, and input
columns with the ledger's own names are replaced; an empty table gives an
empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import SPACE, WORD, text_or_empty, words_of
from changefeed.operators import once


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  #: SQL condition over the measurements, never null


#: In bit order; append only, so that stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines AND n_lines >= 4"),
    Rule("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 12 * n_words)"),
    Rule("capitals", "10 * n_upper > 4 * word_chars"),
    Rule("few_distinct_words", "n_words >= 100 AND 100 * n_distinct_words < 12 * n_words"),
    Rule("few_letters", "n_words > 0 AND 10 * n_letter_words < 7 * n_words"),
)

#: Versioned policies: the rules that a document must not fail.
POLICIES = {
    "base/1": ("few_words", "repeated_windows"),
    "web/1": tuple(r.name for r in RULES),
}
DEFAULT_POLICY = "web/1"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_upper", "n_distinct_words", "n_letter_words")


def mask(names) -> int:
    bit = {r.name: i for i, r in enumerate(RULES)}
    return sum(1 << bit[n] for n in names)


def policy_mask(policy: str) -> int:
    return mask(POLICIES[policy])


def _removed(text: Column, pattern: str) -> Column:
    """How many characters of the text match a one-character pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


_WORK = ("__w", "__keys", "__places", "__texts", "__lines")


def _own_names(columns: list[str]) -> list[str]:
    """Names of working columns that the caller's columns don't have."""
    taken, mark = {c.lower() for c in columns}, ""
    while any(n + mark in taken for n in _WORK):
        mark += "_"
    return [n + mark for n in _WORK]


def _repeat_words(w: str, keys_name: str, places_name: str) -> tuple[str, str, str]:
    """SQL, step by step, for the words inside 3-word windows that occur
    twice or more: sorted keys, candidate places, their texts sorted."""
    bits = f"cast(ceil(log2(size({w}) + 1)) as int)"
    keys = (f"CASE WHEN size({w}) < 4 THEN array() ELSE sort_array(transform(sequence(0, size({w}) - 3), "
            f"i -> shiftleft(xxhash64({w}[i], {w}[i + 1], {w}[i + 2]), {bits}) | cast(i as bigint))) END")
    same = f"shiftright(x, {bits}) = shiftright({keys_name}[i {{}} 1], {bits})"
    places = (f"transform(filter({keys_name}, (x, i) -> (i > 0 AND {same.format('-')}) OR "
              f"(i + 1 < size({keys_name}) AND {same.format('+')})), "
              f"x -> cast(x & (shiftleft(1L, {bits}) - 1) as int))")
    texts = (f"array_sort(transform({places_name}, p -> struct(concat_ws(' ', {w}[p], {w}[p + 1], {w}[p + 2]) "
             "AS s, p AS p)))")
    return keys, places, texts


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements (long) of each whole text."""
    t = text_or_empty(text)
    df = df.drop(*MEASURES)
    work = w, k, p, s, ls = _own_names(df.columns)
    keys, places, texts = _repeat_words(w, k, p)
    df = once(df, words_of(t), w)
    df = once(df, F.expr(keys), k)
    df = once(df, F.expr(places), p)
    df = once(df, F.expr(texts), s)
    starts = (f"array_sort(transform(filter({s}, (x, i) -> (i > 0 AND x.s = {s}[i - 1].s) OR "
              f"(i + 1 < size({s}) AND x.s = {s}[i + 1].s)), x -> x.p))")
    covered = (f"aggregate({starts}, struct(0L AS n, 0 AS done), (a, s) -> struct("
               "a.n + (s + 3) - greatest(a.done, s) AS n, s + 3 AS done), a -> a.n)")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    df = once(df, lines, ls)
    long = lambda c: c.cast("long")
    return df.withColumns({
        "n_words": long(F.size(w)),
        "word_chars": long(F.length(F.regexp_replace(t, SPACE, ""))),
        "n_symbols": long(_removed(t, r"[#*$%&|<>]")),
        "n_lines": long(F.size(ls)),
        "n_dup_lines": long(F.size(ls) - F.size(F.array_distinct(ls))),
        "n_repeat_words": F.expr(covered),
        "n_upper": long(_removed(t, r"\p{Lu}")),
        "n_distinct_words": long(F.size(F.array_distinct(w))),
        "n_letter_words": long(F.size(F.filter(w, lambda x: x.rlike(r"\p{L}")))),
    }).drop(*work)


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements and ``failed`` (long): bit i set if rule i fails."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measure(df.drop("failed"), text).withColumn("failed", failed.cast("long"))


def keep(df: DataFrame, policy: str | None = None, text: str = "text") -> DataFrame:
    """The rows that fail no rule of the policy, with the very columns they
    came with, whatever their names."""
    own = df.select(F.struct(*df.columns).alias("row"))
    return apply_policy(ledger(own, f"row.`{text}`"), policy or DEFAULT_POLICY).where("kept").select("row.*")


def apply_policy(marked: DataFrame, policy: str = DEFAULT_POLICY, to: str = "kept") -> DataFrame:
    """Add ``to``: whether the row fails no rule of the policy."""
    return marked.withColumn(to, F.col("failed").bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0)


def ablation(marked: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Per rule of a policy: rows that fail it, that fail it alone (it would
    keep them if left out), and the rows kept without it.

    One aggregate over the distinct bit patterns (at most 2 ** rules, however
    large the ledger), then bitwise sums over those.
    """
    full = policy_mask(policy)
    patterns = marked.groupBy(F.col("failed").bitwiseAND(F.lit(full).cast("long")).alias("bits")).count()
    rules = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(mask([n])).cast("long").alias("bit"))
                                for n in POLICIES[policy]]))
    rows = patterns.select("bits", "count", rules.alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("bits") == F.col("r.bit")
    count = lambda cond: F.sum(F.when(cond, F.col("count")).otherwise(F.lit(0)))
    return rows.groupBy(F.col("r.rule").alias("rule")).agg(
        count(hit).alias("n_failed"), count(alone).alias("n_failed_alone"),
        count((F.col("bits") == 0) | alone).alias("n_kept_without"))
