"""Ingest vs a brute-force model of the producer rules, on generated payloads.

The model is what a strict Python producer does with one feed line:
``json.loads`` the text after ``data: ``, read ``meta`` with ``.get`` (any
error drops the line), apply the allow-list, key by domain.  A domain that is
neither text nor null cannot be sent.
"""

import json
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changefeed.plans import jobs

DOMAINS = ["en.example.org", "de.example.org", "commons.example.org"]
ALLOW = ["de.example.org", "commons.example.org"]

text = st.text(st.characters(blacklist_categories=("Cs",)), max_size=8)
scalar = st.one_of(st.none(), st.booleans(), st.integers(-10**20, 10**20),
                   st.floats(allow_infinity=True, allow_nan=True), text)
value = st.recursive(scalar, lambda kids: st.one_of(st.lists(kids, max_size=3),
                                                     st.dictionaries(text, kids, max_size=3)),
                     max_leaves=6)
domain = st.one_of(st.sampled_from(DOMAINS), st.sampled_from(DOMAINS), st.none(), st.integers(-9, 9), st.booleans(),
                   st.just({"a": 1}), st.just([]), st.sampled_from(["5", "true", "{}", "[x"]))
with_domain = st.fixed_dictionaries({"domain": domain}, optional={"site": text})
meta = st.one_of(
    with_domain, with_domain, with_domain, with_domain,
    st.fixed_dictionaries({}, optional={"site": text}),
    st.none(), st.integers(0, 9), st.lists(scalar, max_size=2), text,
    st.just('{"domain":"de.example.org"}'))
fields = {"type": text, "length": value, "extra": value}
record = st.one_of(
    st.fixed_dictionaries({"meta": meta, "id": st.integers(0, 10**6)}, optional=fields),
    st.fixed_dictionaries({"id": st.integers(0, 10**6)}, optional=fields))
top = st.one_of(record, record, record, record, record, st.lists(value, max_size=2), scalar)


@st.composite
def payloads(draw):
    obj = draw(top)
    s = json.dumps(obj, ensure_ascii=draw(st.booleans()),
                   separators=draw(st.sampled_from([(",", ":"), (", ", ": ")])))
    kind = draw(st.sampled_from(["plain"] * 12 + ["truncate", "single_quotes", "junk_after",
                                                   "junk_before", "space_after"]))
    if kind == "truncate" and len(s) > 1:
        s = s[: draw(st.integers(0, len(s) - 1))]
    elif kind == "single_quotes":
        s = s.replace('"', "'")
    elif kind == "junk_after":
        s = s + draw(st.sampled_from([" x", "]", ",", " 1", "{", "{}", ",{}", "],[{}"]))
    elif kind == "junk_before":
        s = draw(st.sampled_from(["x", "]", ","])) + s
    elif kind == "space_after":
        s = s + draw(st.sampled_from([" ", "\t", "  "]))
    prefix = draw(st.sampled_from(["data: "] * 8 + ["data:", ":ok", "event: "]))
    return prefix + s


def model(lines, allow):
    kept = Counter()
    for line in lines:
        if not line.startswith("data: "):
            continue
        payload = line[6:]
        try:
            rec = json.loads(payload)
            dom = rec.get("meta", {}).get("domain")
            if not allow or dom in allow:
                key = rec.get("meta", {}).get("domain", "default_domain")
                assert key is None or isinstance(key, str)
                kept[(payload, key if key is not None else "default_domain")] += 1
        except Exception:
            pass
    return kept


def spark_kept(lines_df, lines, allow):
    out = jobs.ingest(lines_df(lines), allow).collect()
    return Counter((bytes(r["value"]).decode("utf-8"), r["key"]) for r in out)


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(payloads(), min_size=100, max_size=200))
def test_ingest_matches_producer_model(lines_df, lines):
    assert spark_kept(lines_df, lines, None) == model(lines, None)
    assert spark_kept(lines_df, lines, ALLOW) == model(lines, ALLOW)


def _random_line(rng):
    """One feed line with controlled proportions of every outcome."""
    def scalar():
        return rng.choice([None, True, False, rng.randint(-10**20, 10**20), rng.random() * 1e6,
                           float("nan"), "".join(rng.choice('ab"\\n é€') for _ in range(rng.randint(0, 5)))])

    rec = {"id": rng.randint(0, 10**6)}
    r = rng.random()
    if r < 0.55:
        rec["meta"] = {"domain": rng.choice(DOMAINS)}
    elif r < 0.62:
        rec["meta"] = {"domain": None}
    elif r < 0.68:
        rec["meta"] = {}
    elif r < 0.74:
        rec["meta"] = rng.choice([None, 3, [1, 2], "text"])
    if rng.random() < 0.5:
        rec["length"] = {"new": rng.randint(0, 999), "old": scalar()}
    if rng.random() < 0.3:
        rec["extra"] = [scalar(), {"k": scalar()}]
    obj = rec if rng.random() < 0.9 else rng.choice([[rec], 5, "s", None, []])
    s = json.dumps(obj, ensure_ascii=rng.random() < 0.5)
    m = rng.random()
    if m < 0.06:
        s = s[: rng.randint(0, max(0, len(s) - 1))]
    elif m < 0.09:
        s = s.replace('"', "'")
    elif m < 0.12:
        s = s + rng.choice([" x", "]", ",", " 1"])
    elif m < 0.14:
        s = rng.choice(["x", ","]) + s
    elif m < 0.16:
        s = s + " \t"
    p = rng.random()
    prefix = "data: " if p < 0.9 else rng.choice(["data:", ":ok", "event: ", ""])
    return prefix + s


def test_ingest_matches_producer_model_random(lines_df):
    import random

    for seed in (1, 2, 3):
        rng = random.Random(seed)
        lines = [_random_line(rng) for _ in range(600)]
        expected_all, expected_allow = model(lines, None), model(lines, ALLOW)
        # the sample exercises every outcome
        assert sum(expected_allow.values()) > 100
        assert {k for _, k in expected_all} >= set(DOMAINS) | {"default_domain"}
        assert 200 < sum(expected_all.values()) < 540
        assert spark_kept(lines_df, lines, None) == expected_all
        assert spark_kept(lines_df, lines, ALLOW) == expected_allow
