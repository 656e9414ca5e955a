"""The training-data operators against brute force on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from changefeed.llm import bagminhash, bpe, fingerprints, fixity, htmltext, kneser, packing, ppm, rules, scoring, urlrules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    (1, "one two three four five six seven one two three " * 8), (2, None), (3, ""), (4, "a\nb b\na\n\n a\n"),
    (5, "one two three four five six seven one two three " * 8), (5, "one two three four five six seven one two three " * 8),
    (None, "Ünï çødé # | wörds\x0b<b> &c $1"), (6, "x " * 3000 + "end"), (7, "tie"), (8, "The quick brown fox. " * 40 + "tail words here"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(i, t, "en", "s", 9, "clash") for i, t in TEXTS],
        "doc_id long, text string, lang string, source string, n_chars long, failed string")


def _brute_rules(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_rules_equal_brute_force(docs):
    marked = rules.apply_policy(rules.ledger(docs))
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                  for r in marked.collect())
    assert got == Counter((i, *_brute_rules(t)) for i, t in TEXTS)
    rows = {r["rule"]: r for r in rules.ablation(marked).collect()}
    failed = [r["failed"] for r in marked.collect()]
    for n, rule in enumerate(rules.RULES):
        if rule.name in rows:
            assert rows[rule.name]["n_failed"] == sum(f >> n & 1 for f in failed)
            assert rows[rule.name]["n_failed_alone"] == sum(f == 1 << n for f in failed)
    assert rules.ledger(docs.limit(0)).count() == 0


def test_bpe_equals_whole_encoding_and_decodes(docs):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    enc = bpe.encoding(path, pattern)
    got = bpe.decode(bpe.encode(docs, path, pattern, part_chars=50), path, pattern).collect()
    for r in got:
        assert r["token_ids"] == enc.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    for text in (" " * 300 + "x", "a\n \n  b", "it's 12 3  \n", "日本 語 " * 60):
        assert [i for p in bpe.safe_parts(text, 7) for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_word_encoder_equals_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    texts = ["foo<|endoftext|>bar <|endoftext|>", "<|startoftext|>0 x 0 <|ENDOFTEXT|>,", "it's IT'S don't 'S's 12a 0",
             "İstanbul ΑΣ Σ ﬁ K Å 日本", "a\x1cb\xa0c\x85d", "", "  ", "Word, word. WORD",
             "Über, ÜBER straße STRASSE ŸÇ ŉ ĸ ı İ ſ ĿL· ǅ e\u0301a, naïve... œuvre; ŒUVRE ªº ×÷ x×y",
             *(f"a{chr(c)}b {chr(c)} {chr(c)}, Z{chr(c)}!" for c in range(0xA1, 0x250))]
    encoder = packing.WordEncoder(path, cache_words=8)
    want = [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want == encoder.encode(texts)
    assert b"".join(encoder.encode([x])[0] for x in texts) == b"".join(want)


def test_packing_covers_each_id_once(docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, max_len=64).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    got = Counter()
    for key in {(r["doc_id"]) for r in rows}:
        pieces = [r for r in rows if r["doc_id"] == key]
        for r in pieces:
            assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 64 and r["offset"] == 0
            assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        copies = sum(i == key for i, _ in TEXTS)
        text = next(x for i, x in TEXTS if i == key) or ""
        ids = t.encode(text, add_special_tokens=False).ids + [2]
        whole = sorted({(r["start"], tuple(r["ids"])) for r in pieces})
        assert [i for _, part in whole for i in part] == ids and len(pieces) == copies * len(whole)
        got[key] += 1
    assert set(got) == {i for i, _ in TEXTS}


def test_fingerprints_of_edited_and_next(docs, spark):
    order = sorted([(i, t or "") for i, t in TEXTS if i not in (5, None)], key=lambda x: -x[0])
    small = spark.createDataFrame(order, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in fingerprints.with_next(small).collect()}
    for n, (i, t) in enumerate(order):
        follower = order[(n + 1) % len(order)]
        assert rows[i]["next_doc_id"] == follower[0]
        assert rows[i]["next_text"] == follower[1][:len(t) // 2]
    assert fingerprints.with_next(docs).count() == len(TEXTS)
    same = {tuple(r["fp"]) for r in fingerprints.with_next(docs).where("doc_id IN (1, 5)").collect()}
    assert len(same) == 1
    assert fingerprints.with_next(docs.limit(0)).count() == 0


def test_sketch_merges_and_estimates(spark):
    from pyspark.sql import functions as F

    a = " ".join(f"w{i}" for i in range(3000))
    b = " ".join(f"w{i}" for i in range(1500, 4500))
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = fingerprints.sketch(fingerprints.sketch(df, F.col("a"), "fa"), F.col("b"), "fb")
    r = df.select(fingerprints.resemblance(F.col("fa"), F.col("fb")), fingerprints.containment(F.col("fa"), F.col("fb")),
                  fingerprints.distinct_count(F.col("fa"))).first()
    assert abs(r[0] - 1 / 3) < 0.15 and abs(r[1] - 0.5) < 0.2 and abs(r[2] / 2996 - 1) < 0.3


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [[f"v{x}" for x in rng.integers(0, 900, 120)] for _ in range(12)]
    texts = []
    for words in base:
        for edits in (0, 0, 1, 2, 3, 9):
            w = list(words)
            for at in rng.integers(0, 120, edits):
                w[at] = f"e{rng.integers(0, 10**6)}"
            texts.append(" ".join(w))
    texts += ["", None, "short", "short", "a b c d e f"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bags = [bagminhash.bag(t or "") for t in texts]
    up = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if bagminhash.similarity(bags[i], bags[j]) >= 0.8 and up[i] != up[j]:
                up = [min(up[i], up[j]) if u in (up[i], up[j]) else u for u in up]
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.near_duplicates(df).collect()}
    assert got == dict(enumerate(up))
    assert {r["doc_id"] for r in bagminhash.one_of_each(df).collect()} == set(up)
    assert bagminhash.near_duplicates(df.limit(0)).count() == 0


def test_signatures_estimate_weighted_jaccard():
    k = np.arange(1, 60, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = (k, np.arange(59) % 5 + 1), (k, np.arange(59) % 3 + 1)
    agree = np.mean(np.equal(*bagminhash.signatures([a, b], 2048)))
    assert abs(agree - bagminhash.similarity(a, b)) < 0.05


def test_scores_equal_brute_force(docs):
    got = scoring.score(docs, common_words=3).collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = [(i, [*WORD.findall((t or "").translate(lower)), None],
             zlib.crc32(str("" if i is None else i).encode()) % 7 == 2) for i, t in TEXTS]
    c = Counter(w for _, ws, held in rows if not held for w in ws)
    n = sum(c.values())
    want = Counter((i, held, len(ws), sum(c[w] > 0 for w in ws), n,
                    round(sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in ws), 5)) for i, ws, held in rows)
    assert want == Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                            round(r["base_score"], 5)) for r in got)
    assert scoring.score(docs.limit(0)).count() == 0


def test_trie_sums_to_one_and_shards_agree(spark):
    df = spark.createDataFrame([(b"banana bandana cabana",), (b"",), (None,)], "bytes binary")
    one, many = ppm.train(df), ppm.train(df, shard_grams=5)
    assert len(one) == 1 and len(many) > 1
    trie = one[0]().trie
    for ctx in (b"bana", b"\xfe\xfe\xfe\xfe", b"zzzz", b" ban"):
        keys = np.array([int.from_bytes(ctx, "big") << 8 | s for s in range(256)], np.uint64)
        assert abs((10 ** trie.log10p(keys)).sum() - 1) < 1e-9
    a, b = ([r["score"] for r in ppm.pretrained(df, s).collect()] for s in (one, many))
    assert np.allclose(a, b)
    assert ppm.adaptive_bits(b"abababababababab") < ppm.adaptive_bits(b"qwertyuiopasdfgh")


def test_kneser_ney_sums_to_one_and_separates(spark):
    keys = np.unique(np.concatenate([k for k, _ in kneser.grams.slices([b"the cat sat on the mat"], 4)]))
    model = kneser.Model(4, keys, np.ones(len(keys), np.int64))
    for ctx in (b"the ", b"zzzz"):
        all_ = np.array([int.from_bytes(ctx, "big") << 8 | s for s in range(256)], np.uint64)
        assert abs((10 ** model.log10p(all_)).sum() - 1) < 1e-9
    good = [(i, f"the cat {w} on the mat and the dog {w} too " * 4, "en") for i, w in enumerate(["sat", "lay", "ran", "sang"] * 20)]
    docs = spark.createDataFrame([*good, (900, "#$%&*|<> " * 30, "en"), (901, None, None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in good], "doc_id long, quality long, toxic long")
    got = {r["doc_id"]: r["kept"] for r in kneser.classify(docs, labels).collect()}
    assert not got[900] and got[901] and sum(got[i] for i, _, _ in good) == len(good)
    assert all(r["kept"] for r in kneser.classify(docs, labels.limit(0)).collect())
    assert kneser.classify(docs.limit(0), labels).count() == 0


def test_url_rules_and_mined_rules(spark):
    fixed = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block")]
    urls = ["http://A.example.org/es/1?x", "https://b.org/q", "ftp://x.com/de/", "no scheme", None, "http://notexample.org/es/1"]
    urls += [f"http://casino{i % 3}.net/win/{i}" for i in range(30)] + [f"http://news.net/en/{i}" for i in range(60)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int("casino" not in (u or "")), 0) for i, u in enumerate(urls)], "doc_id long, quality long, toxic long")
    got = {r["page_id"]: r for r in urlrules.judge(pages, labels, fixed).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(6)] == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("b.org", "/q", "org/", "allow"), ("x.com", "/de/", "com/de/", "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("notexample.org", "/es/1", "org/", "allow")]
    assert all((got[i]["verdict"] == "block") == ("casino" in u) for i, u in enumerate(urls) if i > 5)
    assert {r["verdict"] for r in urlrules.judge(pages.where("page_id > 5"), labels.limit(0), fixed).collect()} == {"allow"}


def test_template_is_deduced_and_left_out(spark):
    page = ("<html><head><title>t</title></head><body><nav><a>menu {i}</a></nav><header>site</header><div class='x'>"
            "<p class=q>Read our terms</p></div><article><h1>Head&amp; {i}</h1><p>First  {i}<br>line<p>Second &lt;b&gt; {i}"
            "<script>var x = '<p>no</p>'</script></article><div class=comments><p>reader {i}</p></div><footer>(c)</footer></body>")
    plain = page.replace("<article>", "<section>").replace("</article>", "</section>")
    rows = [(i, "http://a.com/", page.replace("{i}", str(i))) for i in range(20)]
    rows += [(100 + i, "http://b.com/", plain.replace("{i}", str(i))) for i in range(20)] + [(200, None, None), (201, "http://c.com", "")]
    got = {r["page_id"]: r["text"] for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(20):
        want = f"Head& {i}\nFirst {i} line\nSecond <b> {i}"
        assert got[i] == want and got[100 + i] == want
    assert got[200] == got[201] == ""


def test_audit_finds_what_differs(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 7)) for i in range(700)] + [(None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    good = fixity.records(pages, per_file=300)
    from pyspark.sql import functions as F

    bad = good.withColumn("record", F.when(F.col("page_id").isin(5, 444), F.lit("?")).otherwise(F.col("record")))
    bad = bad.where("page_id IS NULL OR page_id < 698")
    trees = fixity.tree(good), fixity.tree(bad)
    got = {(r["page_id"], r["status"]) for r in fixity.audit(*trees).collect() if r["page_id"] is not None}
    want = {(5, "damaged"), (444, "damaged"), (698, "missing"), (699, "missing")}
    assert got == want
    first = next(r for r in fixity.leaves(good).collect() if r["page_id"] == 0)
    text = good.where("page_id = 0").first()["record"]
    assert bytes(first["hash"]) == hashlib.sha256(text.encode()).digest() and first["length"] == len(text.encode())
    assert fixity.audit(trees[0], trees[0]).count() == 0
    assert fixity.audit(fixity.tree(good.limit(0)), fixity.tree(good.limit(0))).count() == 0


def test_audit_finds_records_lost_and_added_in_mid_file(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"http://h/{i}", f"<p>{i}</p>") for i in range(700)] + [(20, "u", "a"), (20, "u", "b"), (20, "u", "b")]
    rows += [(None, f"n{i}", f"<p>{i}</p>") for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    added = spark.createDataFrame([(333, "http://h/333", "<p>new</p>"), (20, "u", "b")], pages.schema)
    worse = pages.withColumn("html", F.when(F.expr("page_id = 20 AND html = 'a' OR url IN ('n7', 'http://h/400')"), "?").otherwise(F.col("html")))
    worse = worse.where("NOT (page_id <=> 5 OR page_id <=> 310 OR url = 'n9')").unionByName(added)
    good, bad = (fixity.tree(fixity.records(x, per_file=300)) for x in (pages, worse))
    got = Counter((r["page_id"], r["status"]) for r in fixity.audit(good, bad).collect())
    assert got == Counter([(5, "missing"), (310, "missing"), (333, "extra"), (20, "damaged"), (20, "extra"), (400, "damaged"),
                           (None, "damaged"), (None, "missing")])


def test_row_ids_are_numbered_once(spark, docs, monkeypatch):
    def plans(module):
        seen, keep = [], module.saved

        def note(df, name):
            seen.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
            return keep(df, name)

        monkeypatch.setattr(module, "saved", note)
        return seen

    for module, run, name in ((bagminhash, bagminhash.one_of_each, "numbered"), (scoring, scoring.score, "prepared")):
        seen = plans(module)
        out = run(docs)
        seen.append(("result", out._jdf.queryExecution().optimizedPlan().toString()))
        assert [n for n, plan in seen if "monotonically_increasing_id" in plan and n != "texts"] == [name]
        assert out.count() == (len(TEXTS) if module is scoring else len({t or "" for _, t in TEXTS}))


def test_rare_language_keeps_its_model_and_any_its_own_level(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"the cat sat on mat {i % 7} and the dog ran " * 3, "en") for i in range(1500)]
    rows += [(2000 + i, f"der hund lief {i % 5} um das haus herum " * 3, "de") for i in range(60)]
    rows += [(3000 + i, f"zq xw {i % 3} vj kq " * 3, f"l{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = docs.select("doc_id")
    known, shards = kneser.train(docs, trusted, max_trusted=200)
    assert known == {"", "en", "de"}
    scored = kneser.score(docs, known, shards).cache()
    level = kneser.judge(scored, trusted).where(F.col("kn_model") == "").select("threshold").distinct().collect()
    held = scored.where((kneser._part("doc_id", "fit", 4) == 0)).collect()
    any_model = next(m for make in shards for g, m in make().items() if g == "")
    texts = {i: t.encode() for i, t, _ in rows}
    want = [(r["kn_symbols"], any_model.scores([texts[r["doc_id"]]])[0]) for r in held]
    assert np.allclose([r["kn_any_log10p"] for r in held], [lp for _, lp in want])
    mean = sum(lp for _, lp in want) / sum(n for n, _ in want)
    drawn = sorted(10 ** (-(lp + kneser.PRIOR * mean) / (n + kneser.PRIOR)) for n, lp in want)
    assert abs(level[0][0] / (kneser.SLACK * drawn[math.ceil(kneser.QUANTILE * len(drawn)) - 1]) - 1) < 1e-6


def test_wholly_bad_long_tail_host_is_blocked_at_any_size(spark):
    urls = [(f"http://shop.tail{i % 2}.com/x/{i}", 0) for i in range(12)]
    urls += [(f"http://shop.h{i % 700}.com/x/{i}", 1) for i in range(9000)] + [(f"http://www.tail0.com/x/{i}", 1) for i in range(40)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(i, q, 0) for i, (_, q) in enumerate(urls)], "doc_id long, quality long, toxic long")
    got = {r["page_id"]: (r["verdict"], r["matched"]) for r in urlrules.judge(pages, labels, []).collect()}
    assert all((got[i][0] == "block") == (q == 0) for i, (_, q) in enumerate(urls))
    assert got[1][1] == ["h=tail1"] and set(got[0][1]) == {"h=shop", "h=tail0"}


def test_article_texts_that_every_page_holds_stay(spark):
    copy = "<body><nav>menu</nav><div class=x><p>Terms</p></div><article><h1>Head</h1><p>First</p></article></body>"
    named = "<body><div class=x><p>Terms</p></div><article><p>By A. Writer</p><p>Text {i}</p></article></body>"
    plain = "<body><div class=x><p>Terms</p></div><section><div><p>By A. Writer</p></div><p>Text {i}</p></section></body>"
    rows = [(i, "http://a.com/", copy) for i in range(20)] + [(100 + i, f"http://a2.com/{i}", copy.replace("article>", "section>")) for i in range(20)]
    rows += [(200 + i, "http://b.com/", named.replace("{i}", str(i))) for i in range(20)]
    rows += [(300 + i, "http://c.com/", plain.replace("{i}", f"{i} of the site")) for i in range(20)]
    got = {r["page_id"]: r["text"] for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(20):
        assert got[i] == "Head\nFirst" and got[100 + i] == "Terms\nHead\nFirst"
        assert got[200 + i] == f"By A. Writer\nText {i}" and got[300 + i] == f"By A. Writer\nText {i} of the site"
