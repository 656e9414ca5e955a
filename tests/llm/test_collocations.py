"""Phrase collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from changefeed.llm import collocations, queries
from changefeed.llm.oracle import ORACLE_SQL
from compare import compare
from conftest import SF_CHECK

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute(rows, min_count, top):
    f = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i:i + k])] += 1
    out = []
    for lang, count in f.items():
        n = sum(c for p, c in count.items() if len(p) == 1)
        good = {p: c for p, c in count.items() if len(p) > 1 and c >= min_count}
        kept = []
        for p, a in good.items():
            cuts = [(2000000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            longer = [c for q, c in good.items() if len(q) > len(p)
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * c >= 80 * a for c in longer):
                kept.append((score, a, " ".join(p), left, right))
        kept.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, r, p, a, le, ri, n, s) for r, (s, a, p, le, ri) in enumerate(kept[:top], 1)]
    return sorted(out)


def _texts(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"W{i}é"[rng.randrange(2):] for i in range(40)] + ["the", "of", "«x»", "\x85"]
    fixed = ["new york city hall", "as well as", "of the", "the W1", "York city hall tour guide"]
    rows = []
    for i in range(n):
        words = []
        while len(words) < 120:
            words += rng.choice(fixed).split(" ") if rng.random() < 0.3 else [rng.choice(vocabulary)]
            if rng.random() < 0.1:
                words.append(rng.choice([".", ",\n", "\t", "; x", "?!"]))
        rows.append((" ".join(words), rng.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", None), ("Only two", "fr"), (" . , ", "xx")]


def _got(df):
    return sorted(tuple(r)[:8] for r in df.collect())


@pytest.mark.parametrize("min_count,top,bits", [(5, 2000, 64), (3, 4, 64), (8, 15, 14)])
def test_equal_to_brute_force(spark, min_count, top, bits):
    rows = _texts(min_count)
    docs = spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows],
                                 "text string, lang string, a int, h1 string").repartition(3)
    got = _got(collocations.mine(docs, min_count, top, bits))
    assert got == _brute(rows, min_count, top) and len(got) > 2


def test_more_rounds_when_survivors_are_few(spark):
    # Long fixed phrases drop all their best parts, so the first threshold does not do.
    rng = random.Random(9)
    fixed = [" ".join(f"p{i}q{j}" for j in range(4)) for i in range(60)]
    loose = [f"z{i}" for i in range(9)]
    rows = [(" . ".join(rng.sample(fixed, 20) + [" ".join(rng.choices(loose, k=30))]), "en") for _ in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for top in (20, 70):
        assert _got(collocations.mine(docs, 4, top)) == _brute(rows, 4, top)


def test_empty_and_long_texts(spark, monkeypatch):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.mine(empty).count() == 0
    monkeypatch.setattr(collocations, "PART", 10)
    text = "Ab cd,ef  gh\tij klmnopqrstuvwxyz. " * 9
    whole = [w for p in collocations._parts(text.encode()) for w in p]
    monkeypatch.setattr(collocations, "PART", 1 << 22)
    assert whole == [w for p in collocations._parts(text.encode()) for w in p]


def test_scores_beyond_64_bits(spark):
    a, b = 9 * 10 ** 18, 9 * 10 ** 18 + 12345
    got = spark.range(1).select(collocations.score(F.lit(a), F.lit(b)).alias("s")).first()["s"]
    assert got == 2000000 * a // b


def test_query_matches_sql(spark, duck_check):
    ok, msg = compare(queries.QUERIES["op11_collocations"](spark, SF_CHECK), duck_check, ORACLE_SQL["op11_collocations"])
    assert ok, msg
