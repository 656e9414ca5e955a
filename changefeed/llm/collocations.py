"""Phrase collocations by best-first branch and bound.

Phrases of two to four words grow word by word.  A cut after k words scores
floor(2000000 * a / (l + r)), and no part of a phrase occurs less often than
the phrase, so the count of a prefix bounds the score of all that grows from
it: with prefix count f and the count l of the prefix's first k words, no
longer phrase scores above floor(2000000 * f / (l + f)).  The same holds from
the right for suffixes.  Per language the search goes on like this:

1. Words and two-word phrases are counted.  A threshold is guessed from the
   scores of the two-word phrases (the ``AHEAD`` * top-th).
2. The frontier, all prefixes and suffixes whose bound reaches the threshold, is
   expanded by a word, and by one more.
3. Every phrase that scores the threshold or more is now known, and so are all
   longer phrases that could drop it: if a longer phrase holds a phrase often
   enough, so does the part of it that is one word longer.  Where ``top``
   phrases survive at or above the threshold, ties included, the language is
   settled; elsewhere the threshold goes down and the next part of the frontier is
   expanded, until none is left.

A guess decides about work only.  Counting is one narrow pass over the texts
per length: a task turns words into 64-bit hashes, adds up equal phrases and
hands Spark the sums, which are keyed by the hashes of all words (a common word
or phrase costs one row a task).  Words that share a hash are looked for among
all words counted, and the pass is repeated with another seed if there are
any, so counts are exact.  Which phrases to count is asked of bit maps of
``MAP_BITS`` bits, the only thing all tasks hold: a chance hit there costs work
and is dropped by its count.

Defined results: null text is empty, null language is ``und``; repeated rows
count each; words and phrases keep any character but the separators; a text
of any length is read in parts that overlap by three words; empty input gives
no rows; other columns are not read.  Scores and shares are worked out in
decimals of 38 digits.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm.common import saved

SCALE = 2_000_000
MIN_COUNT, TOP, MAX_WORDS = 30, 2000, 4
#: A longer phrase with this percentage of the occurrences drops a phrase.
DROP_PERCENT = 80
#: First threshold: the score of the AHEAD * top-th two-word phrase.
AHEAD = 2
MAP_BITS = 1 << 26
#: Tokens worked on at once, phrases a task gathers, rows handed back at once,
#: words whose hashes a worker remembers, bytes of a text read at once.
AT_ONCE, GATHERED, OUT_ROWS, REMEMBERED, PART = 500_000, 1 << 20, 50_000, 400_000, 1 << 22

_BREAK = 0xFF  # a byte that UTF-8 never has
_TABLE = bytes(b + 32 if 65 <= b <= 90 else _BREAK if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b
               for b in range(256))
_STOP = bytes([_BREAK])


def _parts(text: bytes):
    """Lists of words and stops of one text, cut between words."""
    data = text.translate(_TABLE)
    at = 0
    while at < len(data):
        end = at + PART
        if end < len(data):
            ends = [e for e in (data.find(b" ", end), data.find(_STOP, end)) if e >= 0]
            end = min(ends, default=len(data))
        yield data[at:end].replace(_STOP, b" \xff ").split()
        at = end


class _Hashes(dict):
    """Signed 64-bit numbers of a language's words, never 0 but for a stop."""

    def __init__(self, lang: str, seed: int, bits: int):
        salt = hashlib.blake2b(f"{seed} {lang}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        self.start = hashlib.blake2b(digest_size=8, key=salt)
        self.shift = 64 - bits
        self[_STOP] = 0

    def of(self, word: bytes) -> int:
        state = self.start.copy()
        state.update(word)
        h = int.from_bytes(state.digest(), "little") >> self.shift
        return (h or 1) - (1 << 64 if h >> 63 else 0)

    def __missing__(self, word: bytes) -> int:
        self[word] = h = self.of(word)
        return h


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One key of two."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(31)


def _hit(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys.astype(np.uint64) % np.uint64(8 * len(bitmap))).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _tally(columns: list[np.ndarray], n: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows added up; the first column is a key of the others.  Rows that
    share a key by chance stay apart."""
    order = np.argsort(columns[0])
    columns = [c[order] for c in columns]
    if not len(order):
        return columns, np.zeros(0, np.int64)
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(order))) if n is None else np.add.reduceat(n[order], first)
    return [c[first] for c in columns], counts


def bitmap(rows: DataFrame, key: str = "key", bits: int = MAP_BITS) -> np.ndarray:
    """The keys as a bit map of fixed size."""
    bit = F.pmod(F.col(key), F.lit(bits)) + 1
    out = np.zeros(max(bits // 8, 4096), np.uint8)
    parts = (rows.select(F.bitmap_bucket_number(bit).alias("b"), F.bitmap_bit_position(bit).alias("p"))
             .groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")))
    for r in parts.collect():  # bits / 32768 rows of 4 KB at most
        out[(r["b"] - 1) * 4096:r["b"] * 4096] |= np.frombuffer(r["m"], np.uint8)
    return out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def _by_lang(batch):
    out: dict[str, list[bytes]] = {}
    for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
        out.setdefault(lang, []).append(text)
    return out.items()


def words(docs: DataFrame, seed: int = 0, bits: int = 64) -> DataFrame:
    """All words: lang, word (binary), h, n."""

    def run(batches):
        held: dict[str, Counter] = {}

        def out():
            for lang, counter in held.items():
                counter.pop(_STOP, None)
                items, hashes = list(counter.items()), _Hashes(lang, seed, bits)
                for lo in range(0, len(items), OUT_ROWS):
                    own, n = zip(*items[lo:lo + OUT_ROWS])
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(lang, pa.string()), len(own)), pa.array(own, pa.binary()),
                         pa.array(list(map(hashes.of, own)), pa.int64()), pa.array(n, pa.int64())],
                        names=["lang", "word", "h", "n"])
            held.clear()

        for batch in batches:
            for lang, texts in _by_lang(batch):
                counter = held.setdefault(lang, Counter())
                for text in texts:
                    for part in _parts(text):
                        counter.update(part)
                    if len(counter) > REMEMBERED:
                        yield from out()
                        counter = held.setdefault(lang, Counter())
            if sum(map(len, held.values())) > REMEMBERED:
                yield from out()
        yield from out()

    counted = _texts(docs).mapInArrow(run, "lang string, word binary, h long, n long")
    return counted.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


def phrases(docs: DataFrame, k: int, maps: dict[str, np.ndarray], seed: int = 0, bits: int = 64) -> DataFrame:
    """Phrases of k words that the bit maps let through: h1 .. hk, a.

    ``words``: words to count at all.  For three words ``pairs`` (pairs to count at all),
    ``before`` and ``after`` (the frontier's prefixes and suffixes).  For four also
    ``inside`` (phrases of three words that a longer one might drop).
    """
    names = [*(f"h{i + 1}" for i in range(k)), "n"]

    def chosen(h: np.ndarray, fresh: int):
        """Key and words of the phrases of which the last word is no earlier than ``fresh``."""
        h = np.where(_hit(maps["words"], h), h, 0)
        m = len(h) - k + 1
        ok = np.ones(max(m, 0), bool)
        ok[:max(0, fresh - k + 1)] = False
        for i in range(k):
            ok &= h[i:m + i] != 0
        at = np.flatnonzero(ok)
        cols = [h[at + i] for i in range(k)]
        pairs = [mixed(cols[i], cols[i + 1]) for i in range(k - 1)]
        if k == 2:
            return [pairs[0], *cols]
        good = np.ones(len(at), bool)
        for p in pairs:
            good &= _hit(maps["pairs"], p)
        cols, pairs = [c[good] for c in cols], [p[good] for p in pairs]
        if k == 3:
            good = _hit(maps["before"], pairs[0]) | _hit(maps["after"], pairs[1])
            key = mixed(pairs[0], cols[2])
        else:
            left, right = mixed(pairs[0], cols[2]), mixed(pairs[1], cols[3])
            good = (_hit(maps["before"], left) & _hit(maps["after"], right)
                    | _hit(maps["inside"], left) | _hit(maps["inside"], right))
            key = mixed(left, cols[3])
        return [key[good], *(c[good] for c in cols)]

    def run(batches):
        hashes: dict[str, _Hashes] = {}
        carry: dict[str, np.ndarray] = {}
        gathered: list[tuple[list[np.ndarray], np.ndarray]] = []

        def count(lang: str, tokens: list[bytes]):
            table = hashes.setdefault(lang, _Hashes(lang, seed, bits))
            h = np.fromiter(map(table.__getitem__, tokens), np.int64, len(tokens))
            if sum(map(len, hashes.values())) > REMEMBERED:
                hashes.clear()
            tail = carry.get(lang, h[:0])
            h = np.concatenate([tail, h])
            carry[lang] = h[-(MAX_WORDS - 1):]
            gathered.append(_tally(chosen(h, len(tail))))

        def added():
            cols = [np.concatenate([c[i] for c, _ in gathered]) for i in range(k + 1)]
            return _tally(cols, np.concatenate([n for _, n in gathered]))

        def out():
            if gathered:
                cols, n = added()
                gathered.clear()
                for lo in range(0, len(n), OUT_ROWS):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[lo:lo + OUT_ROWS]) for c in (*cols[1:], n)], names=names)

        for batch in batches:
            for lang, texts in _by_lang(batch):
                tokens: list[bytes] = []
                for text in texts:
                    for part in _parts(text):
                        tokens += part
                        if len(tokens) >= AT_ONCE:
                            count(lang, tokens)
                            tokens = []
                    tokens.append(_STOP)
                count(lang, tokens)
            if sum(len(n) for _, n in gathered) > GATHERED:
                gathered[:] = [added()]
                if len(gathered[0][1]) > GATHERED // 2:
                    yield from out()
        yield from out()

    keys = names[:-1]
    counted = _texts(docs).mapInArrow(run, ", ".join(f"{c} long" for c in names))
    return counted.groupBy(*keys).agg(F.sum("n").alias("a"))


def keyed(rows: DataFrame, k: int) -> DataFrame:
    """The rows with the key that the bit maps know a phrase by."""

    def run(batches):
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(k)]
            key = mixed(cols[0], cols[1])
            for c in cols[2:]:
                key = mixed(key, c)
            yield batch.append_column("key", pa.array(key.astype(np.int64)))

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in [*rows.columns, "key"]))


def score(a: Column, both: Column) -> Column:
    """floor(2000000 * a / both), exactly."""
    whole = F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * a.cast("decimal(20,0)"), both.cast("decimal(20,0)"))
    return whole.cast("long")


def _cut(a: Column, cuts: list[tuple[Column, Column]]) -> Column:
    """(score, l, r) of the lowest-scoring cut, the shortest of equal ones."""
    options = [F.struct(score(a, l + r).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))
               for k, (l, r) in enumerate(cuts)]
    return F.least(*options) if len(options) > 1 else options[0]


def _lowest(a: Column, counts: list[Column]) -> Column:
    """The bound of what grows from a phrase: the lowest over its parts."""
    bounds = [score(a, c + a) for c in counts]
    return F.least(*bounds) if len(bounds) > 1 else bounds[0]


def _kept(rows: DataFrame, longer: DataFrame | None, names: list[str]) -> DataFrame:
    """Phrases that no phrase one word longer drops."""
    if longer is None:
        return rows
    n = len(names)
    shifted = [f"h{i + 2}" for i in range(n)]
    most = (longer.select(*names, "a").union(longer.select(*shifted, "a"))
            .groupBy(*names).agg(F.max("a").alias("__most")))
    wide = "decimal(20,0)"
    dropped = (F.lit(100).cast("decimal(3,0)") * F.col("__most").cast(wide)
               >= F.lit(DROP_PERCENT).cast("decimal(3,0)") * F.col("a").cast(wide))
    return rows.join(most, names, "left").where(~F.coalesce(dropped, F.lit(False))).drop("__most")


def _thresholds(pairs: DataFrame, rank: int) -> DataFrame:
    """(lang, tau): about the score of the rank-th pair, 0 where there are fewer.
    At most 1,001 rows a language are ranked."""
    steps = pairs.groupBy("lang", F.expr("score div 1000").alias("step")).agg(F.count("*").alias("n"))
    down = Window.partitionBy("lang").orderBy(F.col("step").desc())
    steps = steps.withColumn("upto", F.sum("n").over(down))
    return steps.groupBy("lang").agg(
        F.coalesce(F.max(F.when(F.col("upto") >= rank, F.col("step") * 1000)), F.lit(0)).alias("tau"))


def mine(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, words: each language's first
    ``top`` phrases.  ``bits`` of the word hashes is for tests."""
    for seed in range(100):
        counted = saved(words(docs, seed, bits), "phrase-words")
        if counted.groupBy("h").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("words share hashes under every seed")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    single = saved(counted.where(F.col("n") >= min_count), "phrase-frequent")
    maps = {"words": bitmap(single, "h")}

    def count(k):
        return saved(keyed(phrases(docs, k, maps, seed, bits).where(F.col("a") >= min_count), k), f"phrase-{k}")

    a = F.col("a")
    f1 = single.select("lang", F.col("h").alias("h1"), F.col("n").alias("first"))
    f2 = single.select(F.col("h").alias("h2"), F.col("n").alias("last"))
    pairs = (count(2).join(f1, "h1").join(f2, "h2")
             .withColumn("cut", _cut(a, [(F.col("first"), F.col("last"))]))
             .select("lang", "key", "h1", "h2", "a", "first", "last", "cut", F.col("cut.score").alias("score"),
                     _lowest(a, [F.col("first")]).alias("grows"), _lowest(a, [F.col("last")]).alias("back")))
    pairs = saved(pairs, "phrase-pairs")
    maps["pairs"] = bitmap(pairs)

    found, rank = [], AHEAD * top
    while True:
        taus = saved(_thresholds(pairs, rank), "phrase-taus")
        best = saved(_search(pairs.join(taus, "lang"), maps, count), "phrase-best")
        settled = (taus.join(best.groupBy("lang").agg(F.count("*").alias("n")), "lang", "left")
                   .where((F.col("tau") == 0) | (F.col("n") >= top)).select("lang"))
        settled = saved(settled, "phrase-settled")
        found.append(best.join(settled, "lang", "left_semi"))
        pairs = pairs.join(settled, "lang", "left_anti")
        if pairs.isEmpty():
            break
        rank *= 4
    best = found[0]
    for part in found[1:]:
        best = best.union(part)

    spelled = (best.select("lang", "hs", "a", "cut", F.posexplode("hs").alias("pos", "h"))
               .join(single.select("h", "word"), "h")
               .groupBy("lang", "hs", "a", "cut")
               .agg(F.array_sort(F.collect_list(F.struct("pos", F.col("word").cast("string").alias("word")))).alias("w")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = (spelled.select("lang", "a", "cut.l", "cut.r", "cut.score",
                             F.concat_ws(" ", "w.word").alias("phrase"), F.size("hs").alias("words"))
              .withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "words")


def _search(pairs: DataFrame, maps: dict[str, np.ndarray], count) -> DataFrame:
    """Surviving phrases that score tau or more: lang, hs, a, cut.  ``maps`` gets
    the frontier's maps."""
    a, tau = F.col("a"), F.col("tau")
    maps["before"] = bitmap(pairs.where(F.col("grows") >= tau))
    maps["after"] = bitmap(pairs.where(F.col("back") >= tau))
    head = pairs.select("lang", "tau", "h1", "h2", F.col("a").alias("f12"), "first")
    tail = pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"), "last")
    triples = (count(3).join(head, ["h1", "h2"]).join(tail, ["h2", "h3"])
               .withColumn("cut", _cut(a, [(F.col("first"), F.col("f23")), (F.col("f12"), F.col("last"))]))
               .select("lang", "tau", "key", "h1", "h2", "h3", "a", "first", "last", "f12", "f23", "cut",
                       _lowest(a, [F.col("first"), F.col("f12")]).alias("grows"),
                       _lowest(a, [F.col("last"), F.col("f23")]).alias("back")))
    triples = saved(triples, "phrase-triples")
    maps["before"] = bitmap(triples.where(F.col("grows") >= tau))
    maps["after"] = bitmap(triples.where(F.col("back") >= tau))
    maps["inside"] = bitmap(triples.where(F.col("cut.score") >= tau))
    quads = count(4)
    head = triples.select("lang", "tau", "h1", "h2", "h3", F.col("a").alias("f123"), "f12", "first")
    tail = triples.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("h3").alias("h4"),
                          F.col("a").alias("f234"), F.col("f23").alias("f34"), "last")
    # A phrase one side of which was not counted only drops others; its score is below tau.
    scored = (quads.join(head, ["h1", "h2", "h3"]).join(tail, ["h2", "h3", "h4"])
              .withColumn("cut", _cut(a, [(F.col("first"), F.col("f234")), (F.col("f12"), F.col("f34")),
                                          (F.col("f123"), F.col("last"))])))

    def above(rows, names):
        return rows.where(F.col("cut.score") >= tau).select(
            "lang", F.array(*names).alias("hs"), "a", F.struct("cut.score", "cut.l", "cut.r").alias("cut"))

    two, three, four = (["h1", "h2", "h3", "h4"][:n] for n in (2, 3, 4))
    return (above(_kept(pairs.where(F.col("score") >= tau), triples, two), two)
            .union(above(_kept(triples.where(F.col("cut.score") >= tau), quads, three), three))
            .union(above(scored, four)))
