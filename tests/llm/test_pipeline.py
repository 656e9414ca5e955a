"""The pipeline against plain Python, and queries against their SQL."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

import corpus_pipeline
from changefeed.llm import bagminhash, kneser
from changefeed.llm.oracle import ORACLE_SQL
from changefeed.llm.queries import QUERIES
from test_operators import _brute_rules


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    ok, said = compare(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLE_SQL[name])
    assert ok, said


class PlainModel:
    """Interpolated modified Kneser-Ney from dictionaries."""

    def __init__(self, texts, order=4):
        self.order, self.n = order, [None] * order + [Counter()]
        for t in texts:
            data = b"\xfe" * order + t + b"\xff"
            self.n[order].update(data[i - order:i + 1] for i in range(order, len(data)))
        for k in range(order - 1, -1, -1):
            self.n[k] = Counter(g[1:] for g in self.n[k + 1])
        self.d = [kneser.discounts(np.array(list(c.values()))) for c in self.n]
        self.total = [defaultdict(int) for _ in self.n]
        self.cut = [defaultdict(float) for _ in self.n]
        for k, counts in enumerate(self.n):
            for g, c in counts.items():
                self.total[k][g[:-1]] += c
                self.cut[k][g[:-1]] += self.d[k][min(c, 3)]

    def p(self, gram, k):
        if k < 0:
            return 1 / 256
        below = self.p(gram[1:], k - 1)
        total = self.total[k].get(gram[:-1])
        if not total:
            return below
        c = self.n[k].get(gram, 0)
        return (c - self.d[k][min(c, 3)]) / total + self.cut[k][gram[:-1]] / total * below

    def log10p(self, text):
        data = b"\xfe" * self.order + text + b"\xff"
        return sum(math.log10(self.p(data[i - self.order:i + 1], self.order)) for i in range(self.order, len(data)))


def plain_classifier(docs, trusted, part):
    texts = {lang: [t.encode() for i, t, own in docs if i in trusted and part[i] != 0 and (own or "") == lang] for lang in {o or "" for _, _, o in docs}}
    groups = {g: ts for g, ts in texts.items() if len(ts) >= kneser.MIN_DOCS}
    groups[""] = [(t or "").encode() for i, t, _ in docs if i in trusted and part[i] != 0]
    models = {g: PlainModel(ts) for g, ts in groups.items()}
    rows = []
    for i, t, lang in docs:
        g = lang if lang in models else ""
        raw = (t or "").encode()
        rows.append((i, g, len(raw) + 1, models[g].log10p(raw)))
    held = defaultdict(list)
    for i, g, n, lp in rows:
        if i in trusted and part[i] == 0:
            for group in {g, ""}:
                held[group].append((n, lp))
    mean = {g: sum(lp for _, lp in x) / sum(n for n, _ in x) for g, x in held.items()}
    drawn = lambda n, lp, g: 10 ** (-(lp + kneser.PRIOR * mean[g]) / (n + kneser.PRIOR))
    level = {g: kneser.SLACK * sorted(drawn(n, lp, g) for n, lp in x)[math.ceil(kneser.QUANTILE * len(x)) - 1] for g, x in held.items()}
    out = []
    for (i, g, n, lp), doc in zip(rows, docs):
        own = g if g in level else ""
        if drawn(n, lp, own) <= level[own]:
            out.append(doc)
    return out


def plain_rules(docs):
    kept = []
    for doc in docs:
        t = doc[1] or ""
        n, chars, symbols, dup_lines, repeat = _brute_rules(t)
        ws = t.split()
        lines = [x for x in t.split("\n") if x.split()]
        fails = (n < 50, 100 * repeat > 50 * n, 10 * symbols > 3 * n, 2 * dup_lines > len(lines) and len(lines) >= 4,
                 n > 0 and not 2 * n <= chars <= 12 * n, 10 * sum(c.isupper() for c in t) > 4 * chars,
                 n >= 100 and 100 * len(set(ws)) < 12 * n, n > 0 and 10 * sum(any(c.isalpha() for c in w) for w in ws) < 7 * n)
        if not any(fails):
            kept.append(doc)
    return kept


def plain_dedup(docs):
    bags = [bagminhash.bag(t or "") for _, t, _ in docs]
    up = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if up[i] != up[j] and bagminhash.similarity(bags[i], bags[j]) >= 0.8:
                low, high = sorted((up[i], up[j]))
                up = [low if u == high else u for u in up]
    return [docs[i] for i in sorted(set(up))]


def plain_pieces(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, text, _ in docs:
        ids, at = [*t.encode(text or "", add_special_tokens=False).ids, 2], 0
        while at < len(ids):
            size = min(4096, 1 << (len(ids) - at).bit_length() - 1)
            yield i, at, size, zlib.crc32(np.array(ids[at:at + size], "<u4").tobytes()), len(ids)
            at += size


def test_pipeline_equals_plain_python(spark, tmp_path):
    rng = np.random.default_rng(11)
    vocab = ["".join(rng.choice(list("aeioubdklmnrst"), rng.integers(3, 8))) for _ in range(150)]
    docs = [(i, " ".join(rng.choice(vocab, rng.integers(60, 90))), ("en", "de")[i % 2]) for i in range(90)]
    docs += [(100 + i, docs[i][1], "en") for i in range(0, 20, 2)]  # exact copies
    docs += [(200 + i, docs[i][1] + " ending", "de") for i in range(1, 21, 2)]  # near copies
    docs += [(300, "XQ7#zz%9|" * 90, "en"), (301, "too short a text", "en"), (302, None, None), (303, "", "fr"),
             (304, docs[5][1].upper(), "de"), (305, (docs[7][1][:40] + " ") * 20, "en"), (306, " ".join(rng.choice(vocab, 9000)), "fr")]
    labels = [(i, 1, 0) for i, _, _ in docs if i < 90] + [(3, 0, 0), (301, None, None), (None, 1, 0)]
    frame = spark.createDataFrame([(i, t, g, "s", None if t is None else len(t)) for i, t, g in docs],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    part = {r[0]: r[1] for r in frame.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(4))).collect()}

    kept = plain_classifier(docs, set(range(90)) - {3}, part)
    clean = plain_rules(kept)
    alone = plain_dedup(clean)
    assert len(kept) < len(docs) and len(clean) < len(kept) and len(alone) < len(clean)
    assert set(range(90)) <= {i for i, _, _ in kept}
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    got = corpus_pipeline.run(spark, str(tmp_path)).select(*names).collect()
    assert Counter(map(tuple, got)) == Counter(plain_pieces(alone))


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
