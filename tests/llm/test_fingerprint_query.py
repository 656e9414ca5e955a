"""op5's columns against plain Python, and parts of operators no query uses."""

import hashlib
import math
import random

import public_tokenizers
import pytest

from changefeed.llm import fingerprints, packing, ppm, queries


def _shingles(text):
    words = text.split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def _likeness(a, b):
    a, b = _shingles(a), _shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprint_query_against_plain_python(spark, tmp_path):
    rng = random.Random(3)
    words = [f"w{i}é" for i in range(300)]
    texts = {i: " ".join(rng.choices(words, k=rng.randrange(200, 900))) for i in range(0, 60, 2)}
    texts |= {101: None, 103: "", 105: texts[4], 107: texts[4], 109: texts[6] + " tail of it", 111: "a"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op5_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(texts, reverse=True)
    assert set(got) == set(texts)
    for i, doc in enumerate(order):
        text = texts[doc] or ""
        after = texts[order[(i + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        row = got[doc]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        if len(text.split()) > 50:
            assert abs(row["near_edited"] - _likeness(text, edited)) < 0.2
            assert abs(row["near_next"] - _likeness(text, after)) < 0.2
        if edited == text:
            assert row["fingerprint"] == row["edited_fingerprint"] and row["near_edited"] == 1
    assert got[105]["fingerprint"] == got[107]["fingerprint"] == got[4]["fingerprint"]
    assert len({got[d]["fingerprint"] for d in range(0, 60, 2)}) == 30


def test_buckets_hold_one_length_each(spark, tmp_path):
    docs = spark.createDataFrame([(i, "one two three " * i) for i in range(12)], "doc_id long, text string")
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), max_len=16)
    packing.write_buckets(pieces, f"{tmp_path}/buckets")
    back = spark.read.parquet(f"{tmp_path}/buckets")
    assert back.count() == pieces.count()
    assert back.where("bucket <> length OR size(ids) <> length").count() == 0
    assert back.select("bucket").distinct().count() > 3


def _plain_ppm(text, order):
    """PPM with escape C and symbol exclusion, by the book."""
    counts, bits = {}, 0.0
    symbols = [0xFE] * order + list(text) + [0xFF]
    for i in range(order, len(symbols)):
        ruled_out, done = set(), False
        for k in range(order, -1, -1):
            seen = counts.get(tuple(symbols[i - k:i]), {})
            left = {x: n for x, n in seen.items() if x not in ruled_out}
            if not left:
                continue
            all_of = sum(left.values()) + len(left)
            share = left.get(symbols[i], 0) or len(left)
            bits += math.log2(all_of / share)
            if symbols[i] in left:
                done = True
                break
            ruled_out |= set(seen)
        if not done:
            bits += math.log2(256 - len(ruled_out))
        for k in range(order + 1):
            own = counts.setdefault(tuple(symbols[i - k:i]), {})
            own[symbols[i]] = own.get(symbols[i], 0) + 1
    return bits


@pytest.mark.parametrize("order", [0, 2, 4])
def test_adaptive_code_length_equals_a_plain_model(spark, order):
    texts = [b"", b"a", b"abracadabra " * 20, "été à la plage ".encode() * 5, bytes(range(200)), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, bytes binary")
    got = {r["i"]: r["bits"] for r in ppm.adaptive(df, order).collect()}
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(_plain_ppm(text or b"", order), abs=1e-6)
    assert ppm.adaptive(df.limit(0), order).count() == 0


def test_merged_parts_are_the_sketch_of_the_union(spark):
    rng = random.Random(8)
    sets = {k: [sorted(rng.sample(range(10 ** 6), rng.randrange(1, 300))) for _ in range(4)] for k in "abc"}
    parts = spark.createDataFrame([(k, sorted(x)[:64]) for k, all_of in sets.items() for x in all_of] + [("d", [])],
                                  "key string, sketch array<long>")
    got = {r["key"]: r["sketch"] for r in fingerprints.merge_parts(parts, "key", "sketch", 64).collect()}
    for k, all_of in sets.items():
        assert got[k] == sorted(set().union(*all_of))[:64]
