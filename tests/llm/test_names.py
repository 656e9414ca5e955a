"""Callers' columns with the operators' own names; rules by chance."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from changefeed.llm import bagminhash, kneser, rules, urlrules

NAMES = ["threshold", "mean", "kept", "perplexity", "score", "__w", "__uid", "uid", "key", "row", "kn_model", "failed",
         "n_words", "__m", "__t", "bytes", "__keys", "comp", "tid", "Kept", "rank", "stay", "low", "n", "u", "q"]


@pytest.fixture(scope="module")
def named(spark):
    rng = random.Random(4)
    words = ["river", "house", "green", "walks", "under", "seven", "light", "paper", "garden", "table"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(80)), "en", "s", 3) for i in range(60)]
    rows += [(100, rows[0][1], "en", None, None), (101, "§§ ## " * 60, "en", "s", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    seen = set()
    for i, name in enumerate(NAMES):
        if name.lower() not in seen:
            seen.add(name.lower())
            df = df.withColumn(name, F.concat(F.lit(f"{i}-"), F.coalesce(F.col("doc_id"), F.lit(-1)).cast("string")))
    return df


def _unchanged(got, named):
    assert got.dtypes == named.dtypes
    whole = {r["doc_id"]: tuple(r) for r in named.collect()}
    rows = got.collect()
    assert all(tuple(r) == whole[r["doc_id"]] for r in rows)
    return {r["doc_id"] for r in rows}


def test_stages_give_the_callers_columns_back(spark, named, tmp_path):
    labels = named.where("doc_id < 60").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = _unchanged(corpus_pipeline.quality_classifier(spark, named, str(tmp_path)), named)
    assert 101 not in kept and set(range(60)) <= kept
    kept = _unchanged(corpus_pipeline.quality_rules(spark, named, str(tmp_path)), named)
    assert 101 not in kept and len(kept) > 50
    kept = _unchanged(corpus_pipeline.near_dedup(spark, named, str(tmp_path)), named)
    assert 0 in kept and 100 not in kept and len(kept) == 62
    out = corpus_pipeline.packed(spark, named, str(tmp_path))
    assert out.select("doc_id").distinct().count() == 63


def test_operators_take_such_names(named):
    labels = named.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert kneser.classify(named, labels).where("kept").count() > 50
    assert rules.apply_policy(rules.ledger(named)).where("kept").count() > 50
    assert bagminhash.near_duplicates(named).count() == named.count()


@pytest.mark.parametrize("n", [1000, 10_000])
def test_random_labels_block_nothing(spark, n):
    rng = random.Random(n)
    hosts = [f"h{i}.{rng.choice(['com', 'org', 'net'])}" for i in range(40)]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['fr', 'en', 'es'])}/page{rng.randrange(30)}"
            f"?{rng.choice(['id', 'q', 'm'])}={i}" for i in range(n)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(4)
    labels = spark.createDataFrame([(i, int(rng.random() > 0.26), 0) for i in range(n)],
                                   "doc_id long, quality int, toxic int")
    assert urlrules.judge(pages, labels, []).where("verdict = 'block'").count() == 0
    bad = spark.createDataFrame([(i, int("h3." not in u and rng.random() > 0.2), 0) for i, u in enumerate(urls)],
                                "doc_id long, quality int, toxic int")
    got = urlrules.judge(pages, bad, [])
    assert got.where("url LIKE '%//h3.%' AND verdict = 'allow'").count() == 0
    assert got.where("url NOT LIKE '%//h3.%' AND verdict = 'block'").count() == 0


def test_mined_rules_have_the_counts_of_a_plain_miner(spark):
    rng = random.Random(2)
    urls = [f"http://{rng.choice(['a', 'b', 'bad'])}.net/{rng.choice(['x', 'y', 'win'])}" for _ in range(600)]
    rows = [(u, "bad" in u and "win" in u) for u in urls]
    got = {tuple(sorted(r["tokens"])): (r["support"], r["confidence"]) for r in
           urlrules.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()}
    assert ("h=bad", "p=win") in got
    for tokens, (support, confidence) in got.items():
        fit = [bad for u, bad in rows if all(f"{t[2:]}." in u if t[0] == "h" and t != "h=net" else t[2:] in u for t in tokens)]
        assert (support, confidence) == (sum(fit), sum(fit) / len(fit))
