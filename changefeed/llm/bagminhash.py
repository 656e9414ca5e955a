"""Near-duplicates by BagMinHash: weighted MinHash of shingle bags.

A text is the bag of its five-word shingles.  For every shingle hierarchical
Poisson processes run over its discretised weight (the count): one process
for each dyadic interval of the weight axis that the count reaches, thinned
at the count in the last one.  Each point falls into one of ``REGISTERS``
registers, which keep their first point; two texts agree in a register with
the probability of their weighted Jaccard similarity.  Points come in rising
order, so a process stops as soon as it is past the latest register.

Candidates share a band of registers.  Each is verified by the exact overlap
of the bags (sum of minima over sum of maxima).  First every member of a
bucket is held against the bucket's first text and the links are joined to
classes; then, where the texts met by one first text are still in more than
one class, those of different classes whose registers do not rule the
similarity out are held against each other, in blocks, until their classes
are joined.  Members of one class need no more pairs, so a group of thousands
of copies costs about as many comparisons as it has members.

Scale: equal texts are one from the start.  Only ids, 384-byte signatures and
the candidates' texts are shuffled; a large bucket is met in blocks; classes
are made by joins (large star, small star), each round saved.  Nothing about
all documents reaches the driver but counts.

Defined results: a null text is an empty one, and all empty texts are one
class; a text of one to four words has one shingle, all its words; equal
texts are one class whatever their ids; null ids are classed by text like
any other, and the class id is the smallest id in the class (null only if
all are); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import saved, text_or_empty
from changefeed.llm.scoring import words

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
#: Members of a group in one block; two blocks are met at once.
BLOCK = 1000
#: Texts whose keys are broadcast at most; more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wrapping arithmetic)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _times(a: int, b: int) -> np.uint64:
    return _U(a * b % 2**64)


@lru_cache(maxsize=1)
def _word_hashes() -> dict[str, int]:
    return {}


def _hash_words(ws: list[str]) -> np.ndarray:
    table = _word_hashes()
    if len(table) > 500_000:
        table.clear()
    for w in set(ws).difference(table):
        table[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(table.__getitem__, ws), np.uint64, len(ws))


def bag(text: str, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted, and their counts."""
    ws = words(text)
    if not ws:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = _hash_words(ws)
    n = max(1, len(h) - size + 1)
    got = np.zeros(n, np.uint64)
    for j in range(min(size, len(h))):
        got = got * _U(0x9E3779B97F4A7C15) + _mix(h[j:j + n] + _U(j + 1))
    return np.unique(_mix(got), return_counts=True)


def similarity(a, b) -> float:
    """Weighted Jaccard of two bags; two empty bags are alike."""
    (ka, na), (kb, nb) = a, b
    total = int(na.sum() + nb.sum())
    if not total:
        return 1.0
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    shared = int(np.minimum(na[ia], nb[ib]).sum())
    return shared / (total - shared)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """A row of 16-bit register values per bag (an empty bag: zeros)."""
    keys = np.concatenate([k for k, _ in bags]) if bags else np.zeros(0, np.uint64)
    weight = np.concatenate([n for _, n in bags]) if bags else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(bags)), [len(k) for k, _ in bags])
    first = np.full((len(bags), registers), np.inf)
    flat = first.reshape(-1)
    # One process per dyadic interval [base, base + length) below the weight.
    seeds, docs, base, length, weights = [], [], [], [], []
    level, low, size = 0, 0, 1
    at = np.arange(len(keys))
    while len(at):
        seeds.append(_mix(keys[at] + _times(level + 1, 0xD1B54A32D192ED03)))
        docs.append(of[at])
        weights.append(weight[at])
        base.append(np.full(len(at), float(low)))
        length.append(np.full(len(at), float(size)))
        low, size, level = low + size, max(1, low + size), level + 1
        at = at[weight[at] > low]
    if not seeds:
        return np.zeros((len(bags), registers), np.uint16)
    seed, doc, base, length, weights = map(np.concatenate, (seeds, docs, base, length, weights))
    time = np.zeros(len(seed))
    last = np.full(len(bags), np.inf)
    step = 0
    while len(seed):
        step += 1
        draw = _mix(seed + _times(step, 0x9E3779B97F4A7C15))
        time = time - np.log(((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / length
        go = time < last[doc]
        seed, doc, base, length, weights, time, draw = (x[go] for x in (seed, doc, base, length, weights, time, draw))
        if not len(seed):
            break
        place = _mix(draw ^ _U(0xA0761D6478BD642F))
        inside = base + (place >> _U(11)).astype(np.float64) * 2.0**-53 * length < weights
        register = ((place & _U(0x7FF)) * _U(registers) >> _U(11)).astype(np.int64)
        np.minimum.at(flat, doc[inside] * registers + register[inside], time[inside])
        if step < 8 or step % 4 == 0:
            some = np.unique(doc)
            last[some] = first[some].max(axis=1)
    bits = _mix(first.view(np.uint64))
    return np.where(np.isfinite(first), bits & _U(0xFFFF), _U(0)).astype(np.uint16)


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.unhex(F.md5(text)).alias("key"), text.alias("text"))


def _signed(docs: DataFrame) -> DataFrame:
    """key and signature of every distinct text with a word."""
    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo in range(0, len(texts), 1000):
                bags = [bag(t) for t in texts[lo:lo + 1000]]
                full = [i for i, (k, _) in enumerate(bags) if len(k)]
                if full:
                    rows = signatures([bags[i] for i in full])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([lo + i for i in full])),
                         pa.array([r.tobytes() for r in rows], pa.binary())], names=["key", "signature"])

    return _keyed(docs).mapInArrow(run, "key binary, signature binary").groupBy("key").agg(F.first("signature").alias("signature"))


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose bags overlap by ``least`` or more."""
    def run(batches):
        held: dict[str, tuple] = {}
        for batch in batches:
            yes = []
            ta, tb = batch.column(2), batch.column(3)
            for i in range(len(ta)):
                sides = []
                for t in (ta[i].as_py(), tb[i].as_py()):
                    got = held.get(t)
                    if got is None:
                        if len(held) > 200:
                            held.clear()
                        got = held[t] = bag(t)
                    sides.append(got)
                if similarity(*sides) >= least:
                    yes.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(yes, pa.int64())) for c in (0, 1)], names=["a", "b"])

    left = texts.select(F.col("tid").alias("b"), F.col("text").alias("tb"))
    right = texts.select(F.col("tid").alias("a"), F.col("text").alias("ta"))
    both = pairs.join(left, "b").join(right, "a").select("a", "b", "ta", "tb")
    return both.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """tid, comp (the smallest tid of its component) of every end of an edge
    (a, b); large star and small star in turn until nothing changes."""
    edges = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Each node keeps one edge to the smallest it knows; its others move there.
        small = saved(large.distinct(), "large-star")
        least = small.groupBy("u").agg(F.min("v").alias("m"))
        moved = small.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("tid"), F.col("v").alias("comp")).distinct()
    return edges.select(F.col("u").alias("tid"), F.col("v").alias("comp")).unionByName(roots)


class _Union:
    """Classes joined so far within one group."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x


def _links_of(tid, comp, own, sig, texts, lead: int, one_block: bool, least: float, floor: int):
    """Links (a, b) that join different classes of one group, by exact
    overlap; pairs whose classes are joined already are passed over."""
    n = len(tid)
    sig = np.frombuffer(b"".join(sig), np.uint16).reshape(n, REGISTERS)
    bags: dict[int, tuple] = {}
    union, out = _Union(), []

    def bag_of(i):
        got = bags.get(i)
        if got is None:
            k, c = bag(texts[i])
            got = bags[i] = (k, c, int(c.sum()))
        return got

    for lo in range(0, n, 64):
        same = (sig[lo:lo + 64, None, :] == sig[None, :, :]).sum(axis=2)
        ok = (same >= floor) & (comp[lo:lo + 64, None] != comp[None, :]) & (tid[lo:lo + 64, None] < tid[None, :])
        ok &= (tid[lo:lo + 64, None] != lead) & (tid[None, :] != lead)  # held against the lead before
        if not one_block:
            ok &= own[lo:lo + 64, None] != own[None, :]
        x, y = np.nonzero(ok)
        for k in np.argsort(-same[x, y], kind="stable").tolist():
            i, j = lo + int(x[k]), int(y[k])
            ri, rj = union.root(int(comp[i])), union.root(int(comp[j]))
            if ri == rj:
                continue
            a, b = bag_of(i), bag_of(j)
            if min(a[2], b[2]) >= least * max(a[2], b[2]) and similarity(a[:2], b[:2]) >= least:
                union.up[ri] = rj
                out.append((int(tid[i]), int(tid[j])))
    return out


def _across(members: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between different classes of one group.  members: lead, n
    (rows of the lead), tid, comp, signature, text.  A group is met in pairs
    of blocks, so that no task holds more than two blocks of one group."""
    spread = (least * (1 - least) / REGISTERS) ** 0.5
    floor = int((least - 4.5 * spread) * REGISTERS)
    cut = members.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("tid"), F.col("blocks")).cast("int"))
    met = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    met = met.select("lead", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "tid", "comp", "own", "signature", "text")

    def groups(t, final):
        """(links of the whole groups, rows of the one that may go on)."""
        lead, i, j, tid, comp, own = (t.column(c).to_numpy() for c in range(6))
        change = np.flatnonzero((lead[1:] != lead[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        edges = [0, *change.tolist(), len(lead)] if final else [0, *change.tolist()]
        found = []
        for lo, hi in zip(edges, edges[1:]):
            if hi - lo > 2:
                sig, text = (t.column(c).slice(lo, hi - lo).to_pylist() for c in (6, 7))
                found += _links_of(tid[lo:hi], comp[lo:hi], own[lo:hi], sig, text, lead[lo], i[lo] == j[lo], least, floor)
        return found, t.slice(edges[-1])

    def links(found):
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    def run(batches):
        rest = None  # rows come sorted by group; a group may lie across batches
        for batch in batches:
            t = pa.Table.from_batches([batch])
            found, rest = groups(t if rest is None else pa.concat_tables([rest, t]), False)
            yield links(found)
        if rest is not None:
            yield links(groups(rest, True)[0])

    ordered = met.repartition("lead", "i", "j").sortWithinPartitions("lead", "i", "j")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def near_classes(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(texts, classes): key, tid of every distinct text, and tid, comp of
    those that are linked to another text."""
    texts = saved(_keyed(docs).select("key").distinct().withColumn("tid", F.monotonically_increasing_id()), "texts")
    signed = saved(_signed(docs).join(texts, "key").select("tid", "signature"), "signatures")
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        F.substring(F.col("signature"), i * (2 * ROWS) + 1, F.lit(2 * ROWS)), i))
    rows = signed.select("tid", F.explode(bands).alias("band"))
    buckets = rows.groupBy("band").agg(F.min("tid").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = saved(rows.join(buckets, "band"), "members")

    stars = saved(members.where("tid <> lead").select(F.col("lead").alias("a"), F.col("tid").alias("b")).distinct(), "stars")
    needed = members.select("tid").distinct().join(texts, "tid")
    needed = saved(needed, "needed")
    keys = F.broadcast(needed) if needed.count() <= BROADCAST_KEYS else needed
    pool = saved(_keyed(docs).join(keys, "key").groupBy("tid").agg(F.first("text").alias("text")), "candidates")

    links = saved(_verified(stars, pool, least), "links")
    classes = saved(components(links), "classes")
    # Two texts of a bucket share its lead, so the leads' stars hold every
    # candidate pair; those with one class left need no more.
    group = stars.select(F.col("a").alias("lead"), F.col("b").alias("tid"))
    group = group.unionByName(group.select("lead", F.col("lead").alias("tid")).distinct())
    group = group.join(classes, "tid", "left").withColumn("comp", F.coalesce("comp", "tid"))
    mixed = (group.groupBy("lead").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("n"))
             .where("x <> y AND n > 2").select("lead", "n"))
    mixed = saved(group.join(mixed, "lead"), "mixed")
    more = saved(_across(mixed.join(signed, "tid").join(pool, "tid"), least), "more-links")
    if more.isEmpty():
        return texts, classes
    chain = classes.select(F.col("tid").alias("a"), F.col("comp").alias("b")).where("a <> b")
    return texts, saved(components(chain.unionByName(more)), "classes")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class), text_copies (rows
    with the same text) and class_texts (distinct texts) of every row."""
    light = docs.select("doc_id", F.unhex(F.md5(text_or_empty())).alias("key"))
    texts, classes = near_classes(docs, least)
    groups = light.groupBy("key").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("text_copies"))
    placed = (groups.join(texts, "key").join(classes, "tid", "left")
              .select("key", "low", "text_copies", F.coalesce("comp", "tid").alias("comp")))
    placed = saved(placed, "placed")
    ids = placed.groupBy("comp").agg(F.min("low").alias("class_id"), F.count(F.lit(1)).alias("class_texts"))
    return light.join(placed, "key").join(ids, "comp").select("doc_id", "class_id", "text_copies", "class_texts")


def one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without all but one of each class: the smallest
    doc_id stays (nulls last, then the first row)."""
    # Written once: numbered anew, a lost executor could give rows other ids.
    row = F.struct(*docs.columns).alias("row")
    numbered = saved(docs.select(row, F.monotonically_increasing_id().alias("__uid")), "numbered")
    light = numbered.select("__uid", F.col("row.doc_id").alias("doc_id"),
                            F.unhex(F.md5(text_or_empty("row.text"))).alias("key"))
    texts, classes = near_classes(docs, least)
    comp = texts.join(classes, "tid", "left").select("key", F.coalesce("comp", "tid").alias("comp"))
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__uid"))
    placed = saved(light.join(comp, "key").select("comp", "__uid", rank.alias("rank")), "ranked")
    stay = placed.groupBy("comp").agg(F.min_by("__uid", "rank").alias("stay"))
    gone = saved(placed.join(stay, "comp").where("__uid <> stay").select("__uid"), "dropped")
    if gone.count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)
    return numbered.join(gone, "__uid", "left_anti").select("row.*")
