"""Hard negatives by a GNAT-style multiway hyperplane tree.

A node's split points are rows of a bounded sample, chosen far apart; each
vector goes to the split point it is closest to (a cell bounded by
hyperplanes), two levels deep at most.  For every split point i and every
sibling cell j of a node the tree keeps the least and greatest distance
between point i and the vectors of cell j, over all vectors.  A window of
scores is a ring of distances round the anchor: score = (|q|^2 + |x|^2 -
d^2) / 2, with the least and greatest |x|^2 of the cell.  A cell is left out
when, by the triangle inequality with some split point, its distances to the
anchor cannot meet the ring.  What is left is scored exactly in whole
numbers, so the tree decides about work and never about results.

1. A bounded sample fits the tree and gives each anchor a first lower bound
   of its last positive's score.
2. Positives: cells that may hold scores above that bound.
3. Negatives: cells that meet the window of one of the anchor's positives.

Leaves are worked on in blocks: rows of a leaf are dealt over as many blocks
as it needs, anchors that visit it over blocks too, and each (leaf, rows,
anchors) block gives its own best few, which are then ranked per anchor.  So a leaf
that a third of all vectors fall into (equal vectors, say) is many small
tasks, and no pair of rows ever becomes a row of a table.

Only the tree is held by all tasks: at most ``FANOUT`` + ``FANOUT``^2 split
points and ``FANOUT`` times as many pairs of distances, whatever the input.

Defined results: rows with a null label, a null vector or a null or
non-finite component take no part; vectors of unequal length count as filled
up with zeros; a null ``vec_id`` keeps its label and is never an anchor, and
sorts after the others; repeated rows are rows of their own (an anchor's
copies are other rows); anchors without positives or negatives give no rows;
empty input gives no rows; extra columns are ignored.  Components and scores
are whole numbers; where products could pass 2^53 they are worked out with
long integers, and a score beyond 64 bits is given as the greatest or least
long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm.common import saved

#: Components of the vectors the tree is fitted on, about: rows are drawn by
#: hash with a chance that makes it the expected number.
SAMPLE_VALUES = 1 << 20
FANOUT = 16
#: A leaf is split further only above so many sampled rows.
LEAF_SAMPLE = 32
ROWS_PER_BLOCK, ANCHORS_PER_BLOCK = 4096, 4096
#: Anchors of a block that are scored at once.
ANCHORS_AT_ONCE = 256
POSITIVES = NEGATIVES = 5
_LONG = np.iinfo(np.int64)
_NO_ID = _LONG.max  # sorts last


def prepared(rows: DataFrame, scale: int = 256, classes: int = 10) -> DataFrame:
    """(uid, vec_id, label, vector) of the rows that take part: labels as
    mining reads them, components as whole numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                        F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite))
    moved = F.when(F.expr("vec_id % 7 = 0"), (F.col("label") + 1) % classes).otherwise(F.col("label"))

    def floor(x):  # floor() gives a long; doubles from 2^52 are whole
        return F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x)

    scaled = F.transform("embedding", lambda x: floor(x * float(scale)))
    return kept.select(F.monotonically_increasing_id().alias("uid"), "vec_id", moved.alias("label"),
                       scaled.alias("vector"))


def _matrix(vectors, dim: int) -> np.ndarray:
    """Lists of numbers as rows of one matrix, short ones filled up with zeros."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def _apart(points: np.ndarray, n: int) -> np.ndarray:
    """Up to n distinct points of 3 * n candidates, each the farthest from
    those before it (of all points, it would be outliers only)."""
    points = points[np.unique(np.linspace(0, len(points) - 1, 3 * n).astype(int))]
    chosen = [int(np.argmin((points * points).sum(1)))]
    near = _squared(points, points[chosen])[:, 0]
    while len(chosen) < n and near.max(initial=0) > 1e-9 * (1 + (points * points).sum(1).max()):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _squared(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


class Tree:
    """Split points, and the ranges once they are known.  A leaf's number is
    child of the root * FANOUT + child of that child (0 if it has none)."""

    def __init__(self, sample: np.ndarray, fanout: int = FANOUT):
        self.fanout = fanout
        self.nodes: dict[int, np.ndarray] = {}  # -1: the root; j: the root's child j
        if len(sample):
            self.nodes[-1] = _apart(sample, fanout)
            cell = _squared(sample, self.nodes[-1]).argmin(1)
            for j in range(len(self.nodes[-1])):
                own = sample[cell == j]
                if len(own) > LEAF_SAMPLE:
                    self.nodes[j] = _apart(own, fanout)
        self.ranges: dict[int, tuple] = {}

    def place(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector."""
        if -1 not in self.nodes:
            return np.zeros(len(x), np.int64)
        first = _squared(x, self.nodes[-1]).argmin(1)
        second = np.zeros(len(x), np.int64)
        for j, points in self.nodes.items():
            at = np.flatnonzero(first == j)
            if j >= 0 and len(at):
                second[at] = _squared(x[at], points).argmin(1)
        return first * self.fanout + second

    def measured(self, x: np.ndarray, leaf: np.ndarray):
        """(node, cell, least and greatest distance to each split point, least
        and greatest |x|^2) of the cells these vectors are in."""
        norm = (x * x).sum(1)
        for node, points in self.nodes.items():
            own = np.arange(len(x)) if node < 0 else np.flatnonzero(leaf // self.fanout == node)
            cell = leaf[own] // self.fanout if node < 0 else leaf[own] % self.fanout
            d = np.sqrt(_squared(x[own], points))
            for j in np.unique(cell):
                at = cell == j
                yield node, int(j), d[at].min(0), d[at].max(0), norm[own[at]].min(), norm[own[at]].max()

    def learn(self, rows) -> None:
        """Ranges over all vectors, from (node, cell, point, lo, hi); point -1
        has the squared norms."""
        for node, points in self.nodes.items():
            m = len(points)
            self.ranges[node] = tuple(np.full(s, v) for s, v in
                                      (((m, m), np.inf), ((m, m), -np.inf), (m, np.inf), (m, -np.inf)))
        for node, cell, point, lo, hi in rows:
            least, most, small, large = self.ranges[node]
            if point < 0:
                small[cell], large[cell] = lo, hi
            else:
                least[point, cell], most[point, cell] = lo, hi

    def _met(self, node: int, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which cells of a node may hold scores in [low, high], per anchor."""
        least, most, small, large = self.ranges[node]
        norm = (q * q).sum(1)
        d = np.sqrt(_squared(q, self.nodes[node]))[:, :, None]  # anchor, split point, cell
        nearest = np.maximum(np.maximum(d - most, least - d), 0).max(1)
        farthest = (d + most).min(1)
        slack = 1e-9 * (1 + norm[:, None] + np.where(np.isfinite(large), large, 0))
        inner = norm[:, None] + small - 2 * high[:, None]  # squared, of the ring
        outer = norm[:, None] + large - 2 * low[:, None]
        return np.isfinite(small) & (nearest ** 2 <= outer + slack) & (farthest ** 2 >= inner - slack)

    def leaves(self, q: np.ndarray, low: np.ndarray, high: np.ndarray):
        """(which anchor, leaf) of the leaves that may hold scores in the windows."""
        if -1 not in self.nodes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        top = self._met(-1, q, low, high)
        rows, out = [], []
        for j in range(top.shape[1]):
            at = np.flatnonzero(top[:, j])
            if not len(at):
                continue
            if j in self.nodes:
                i, leaf = np.nonzero(self._met(j, q[at], low[at], high[at]))
                rows.append(at[i])
                out.append(j * self.fanout + leaf)
            else:
                rows.append(at)
                out.append(np.full(len(at), j * self.fanout))
        return (np.concatenate(rows), np.concatenate(out)) if rows else (np.zeros(0, np.int64),) * 2


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact whole inner products; object numbers where 53 bits could be passed."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    out = np.empty((len(a), len(b)), object)
    for i, row in enumerate(a):
        own = [int(x) for x in row]
        out[i] = [max(_LONG.min, min(_LONG.max, sum(x * y for x, y in zip(own, r)))) for r in whole]
    return out


def _first(score: np.ndarray, ids: np.ndarray, ok: np.ndarray, n: int) -> np.ndarray:
    """Places of the first n allowed rows: higher scores first, then smaller ids."""
    at = np.flatnonzero(ok)
    if len(at) > 8 * n:  # drop what is below the n-th score
        least = np.partition(score[at], len(at) - n)[len(at) - n]
        at = at[score[at] >= least]
    return at[np.lexsort((ids[at], -score[at]))][:n]


def _visit(rows: DataFrame, visits: DataFrame, leaves: DataFrame, within, schema: str) -> DataFrame:
    """Every visiting anchor held against every row of its leaf, block by
    block.  ``visits`` has leaf and what ``within`` needs of an anchor."""
    sizes = leaves.join(visits.groupBy("leaf").agg(F.count("*").alias("n_visits")), "leaf").select(
        "leaf", F.ceil(F.col("n_rows") / ROWS_PER_BLOCK).cast("int").alias("row_blocks"),
        F.ceil(F.col("n_visits") / ANCHORS_PER_BLOCK).cast("int").alias("anchor_blocks"))
    sizes = F.broadcast(sizes)  # a row a leaf: FANOUT^2 at most

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = (rows.join(sizes, "leaf")
            .withColumn("rb", F.pmod(F.xxhash64("uid"), F.col("row_blocks")).cast("int"))
            .withColumn("ab", every("anchor_blocks")).drop("row_blocks", "anchor_blocks"))
    right = (visits.join(sizes, "leaf")
             .withColumn("ab", F.pmod(F.xxhash64("uid"), F.col("anchor_blocks")).cast("int"))
             .withColumn("rb", every("row_blocks")).drop("row_blocks", "anchor_blocks"))
    keys = ["leaf", "rb", "ab"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(within, schema)


def mine(rows: DataFrame, anchor_every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[int, int] = (80, 100), fanout: int = FANOUT) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank
    int (from 1), negative_id, positive_score, negative_score.  ``window``:
    percent of the positive's score between which a negative's lies.
    ``rows`` as :func:`prepared` gives them."""
    spark = rows.sparkSession
    rows = saved(rows, "gnat-rows")  # once: row ids are of these very rows
    n_rows, dim = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = max(dim or 0, 1)

    # A bounded sample, drawn by hash: the fit, and first bounds of the positives.
    share = int((1 << 30) * min(1.0, SAMPLE_VALUES / width / max(n_rows, 1)))
    sample = (rows.where(F.pmod(F.xxhash64("uid"), F.lit(1 << 30)) < share)
              .select("uid", "label", "vector").toArrow())
    sample_x = _matrix(sample.column("vector").to_pylist(), width)
    sample_uid, sample_label = (sample.column(c).to_numpy() for c in ("uid", "label"))
    tree = Tree(sample_x, fanout)

    def placed(batches):
        for batch in batches:
            x = _matrix(batch.column("vector").to_pylist(), width)
            yield batch.append_column("leaf", pa.array(tree.place(x), pa.int32()))

    rows = saved(rows.mapInArrow(placed, "uid long, vec_id long, label long, vector array<double>, leaf int"),
                 "gnat-leaves")

    def measured(batches):
        held: dict[tuple, list] = {}
        for batch in batches:
            x = _matrix(batch.column("vector").to_pylist(), width)
            for node, cell, lo, hi, small, large in tree.measured(x, batch.column("leaf").to_numpy().astype(np.int64)):
                lo, hi = np.append(lo, small), np.append(hi, large)
                old = held.get((node, cell))
                held[node, cell] = [lo, hi] if old is None else [np.minimum(old[0], lo), np.maximum(old[1], hi)]
        out = [(node, cell, i if i < len(lo) - 1 else -1, float(lo[i]), float(hi[i]))
               for (node, cell), (lo, hi) in held.items() for i in range(len(lo))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int32()] * 3 + [pa.float64()] * 2)],
                                             names=["node", "cell", "point", "lo", "hi"])

    ranges = (rows.select("vector", "leaf").mapInArrow(measured, "node int, cell int, point int, lo double, hi double")
              .groupBy("node", "cell", "point").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    tree.learn([tuple(r) for r in ranges.collect()])  # at most (FANOUT + 1) * FANOUT * (FANOUT + 1) rows
    leaves = saved(rows.groupBy("leaf").agg(F.count("*").alias("n_rows")), "gnat-sizes")

    anchors = (rows.where(F.expr(f"vec_id % {int(anchor_every)} = 0"))
               .select("uid", F.col("vec_id").alias("anchor_id"), "label", "vector"))

    def towards_positives(batches):
        for batch in batches:
            q = _matrix(batch.column("vector").to_pylist(), width)
            uid, label = (batch.column(c).to_numpy() for c in ("uid", "label"))
            low = np.full(len(q), -np.inf)
            if len(sample_x):
                found = scores(q, sample_x)
                for i in range(len(q)):
                    own = np.sort(found[i][(sample_label == label[i]) & (sample_uid != uid[i])])
                    if len(own) >= positives:
                        low[i] = own[-positives]
            # Without a bound of its own an anchor looks everywhere.
            i, leaf = tree.leaves(q, np.maximum(low, -1e300), np.full(len(q), 1e300))
            taken = batch.take(pa.array(i, pa.int64()))
            yield taken.append_column("leaf", pa.array(leaf, pa.int32()))

    base = "uid long, anchor_id long, label long, vector array<double>"
    visits = saved(anchors.mapInArrow(towards_positives, f"{base}, leaf int"), "gnat-visits")

    def best_positives(own: pd.DataFrame, who: pd.DataFrame) -> pd.DataFrame:
        out = []
        for anchor, found, ids, uids, labels in _scored(own, who, width):
            ok = (labels == anchor.label) & (uids != anchor.uid)
            out += [(anchor.uid, uids[k], _id(ids[k]), int(found[k])) for k in _first(found, ids, ok, positives)]
        return _frame(out, ["uid", "other", "positive_id", "positive_score"], ["positive_id"])

    best = _visit(rows, visits, leaves, best_positives,
                  "uid long, other long, positive_id long, positive_score long")
    order = [F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last(), F.col("other")]
    best = (best.withColumn("k", F.row_number().over(Window.partitionBy("uid").orderBy(*order)))
            .where(F.col("k") <= positives))
    pairs = saved(best.select("uid", "k", "positive_id", "positive_score"), "gnat-positives")

    low_pct, high_pct = window
    wanted = (pairs.groupBy("uid").agg(F.sort_array(F.collect_list("positive_score")).alias("targets"))
              .join(anchors, "uid"))

    def towards_negatives(batches):
        for batch in batches:
            targets = batch.column("targets").to_pylist()
            at = np.repeat(np.arange(len(targets)), [len(t) for t in targets])
            p = np.array([x for t in targets for x in t], float)
            q = _matrix(batch.column("vector").to_pylist(), width)
            slack = 1 + 1e-9 * np.abs(p)
            i, leaf = tree.leaves(q[at], p * low_pct / 100 - slack, p * high_pct / 100 + slack)
            both = np.unique(np.stack([at[i], leaf]), axis=1)
            taken = batch.take(pa.array(both[0], pa.int64()))
            yield taken.append_column("leaf", pa.array(both[1], pa.int32()))

    seen = saved(wanted.select("uid", "anchor_id", "label", "vector", "targets").mapInArrow(
        towards_negatives, f"{base}, targets array<long>, leaf int"), "gnat-windows")

    def best_negatives(own: pd.DataFrame, who: pd.DataFrame) -> pd.DataFrame:
        out = []
        for anchor, found, ids, uids, labels in _scored(own, who, width):
            for p in sorted({int(t) for t in anchor.targets}):
                lo, hi = -(-low_pct * p // 100), high_pct * p // 100
                ok = (labels != anchor.label) & (found >= lo) & (found <= hi)
                out += [(anchor.uid, p, uids[k], _id(ids[k]), int(found[k])) for k in _first(found, ids, ok, negatives)]
        return _frame(out, ["uid", "positive_score", "other", "negative_id", "negative_score"], ["negative_id"])

    hard = _visit(rows, seen, leaves, best_negatives,
                  "uid long, positive_score long, other long, negative_id long, negative_score long")
    order = [F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last(), F.col("other")]
    hard = (hard.withColumn("rank", F.row_number().over(Window.partitionBy("uid", "positive_score").orderBy(*order)))
            .where(F.col("rank") <= negatives))
    named = anchors.select("uid", "anchor_id")
    return (pairs.join(hard, ["uid", "positive_score"]).join(named, "uid")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _scored(own: pd.DataFrame, who: pd.DataFrame, width: int):
    """Each anchor of a block with the rows' scores, ids, uids and labels."""
    if not len(own) or not len(who):
        return
    x = _matrix(own["vector"], width)
    ids, uids, labels = _ids(own["vec_id"]), own["uid"].to_numpy(), own["label"].to_numpy()
    for lo in range(0, len(who), ANCHORS_AT_ONCE):
        part = who.iloc[lo:lo + ANCHORS_AT_ONCE]
        found = scores(_matrix(part["vector"], width), x)
        for i, anchor in enumerate(part.drop(columns="vector").itertuples(index=False)):
            yield anchor, found[i], ids, uids, labels


def _ids(column: pd.Series) -> np.ndarray:
    """Ids as longs, null as the greatest one."""
    return np.array([_NO_ID if pd.isna(x) else int(x) for x in column], np.int64)


def _id(x) -> int | None:
    return None if x == _NO_ID else int(x)


def _frame(rows: list[tuple], names: list[str], nullable: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    return out.astype({c: "Int64" if c in nullable else "int64" for c in names})
