"""Best-fit packing against the library's ids and exhaustive search."""

import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from changefeed.llm import binslack

PATH = public_tokenizers.path("word_bpe_49k.json")


def _fullest(lengths, cap):
    """The fullest sum of a combination, by trying all."""
    return max(s for k in range(1, len(lengths) + 1) for c in itertools.combinations(lengths, k) if (s := sum(c)) <= cap)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9))
def test_each_combination_is_the_fullest(lengths):
    left = Counter(lengths)
    for times, chosen in binslack.combinations(dict(left), 12):
        for _ in range(times):
            assert sum(n * u for n, u in chosen) == _fullest(list(left.elements()), 12)
            left.subtract({n: u for n, u in chosen})
            left = +left
    assert not left


def test_places_give_each_rank_its_own_room():
    counts = {7: 1000, 5: 3, 2: 40, 1: 1, 16: 9}
    plan = binslack.combinations(counts, 16)
    where = binslack.places(plan)
    filled = defaultdict(list)
    for n, c in counts.items():
        for rank in range(c):
            row = np.searchsorted(where["key"], n << 44 | rank, "right") - 1
            far, own = divmod(rank - where["lo"][row], where["uses"][row])
            filled[int(where["first"][row] + far)].append((int(where["at"][row] + own * n), n))
    assert len(filled) == sum(t for t, _ in plan)
    for pieces in filled.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 16
    assert binslack.combinations({}, 16) == [] and not len(binslack.places([])["key"])


def test_pack_covers_each_id_once_without_gaps(spark):
    texts = [(i, "one two three four five six seven " * (i % 23), "x") for i in range(300)]
    texts += [(None, "null id", "y"), (7, None, "z"), (8, ""), (9, "long " * 5000), (9, "long " * 5000),
              (10, "a<|endoftext|>b")]
    texts = [(t + ("",))[:3] for t in texts]
    docs = spark.createDataFrame(texts, "doc_id long, text string, length string").repartition(5)
    docs = docs.withColumn("part", docs["length"]).withColumn("sequence_id", docs["doc_id"])
    rows = binslack.pack(docs, PATH, end_id=0, max_len=64).collect()
    t = Tokenizer.from_file(PATH)
    want, got = Counter(), defaultdict(list)
    for i, text, _ in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 64)):
            want[i, k, at, tuple(ids[at:at + 64])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], tuple(r["ids"])) for r in rows) == want
    for r in rows:
        assert r["length"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        got[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in got.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 64
    total = sum(r["length"] for r in rows)
    assert len(got) <= -(-total // 64) + 2  # nearly no padding
    assert binslack.pack(docs.limit(0), PATH).count() == 0
