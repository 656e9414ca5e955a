"""Prediction by partial matching over byte contexts.

The trie holds, for every context of up to ``order`` bytes, the symbols that
followed it.  A symbol is coded in its longest context that was seen: either
it was seen there, or an escape leads to the context one byte shorter, where
the symbols of the longer one are excluded.  The escape estimate is the
number of distinct symbols (method C): with n of T symbols counted and q
distinct, symbol n / (T + q), escape q / (T + q); after an exclusion both are
taken over what is left.  Below order 0 all bytes left are alike.

``pretrained`` scores texts with a trie learnt from a corpus; ``adaptive_bits``
codes one text from nothing, learning as it goes.

Scale: grams are counted with map-side sums.  The trie is cut into shards by
the last two context bytes; a shard has a bounded number of grams and is the
only thing a worker holds, and one narrow pass over the texts is made for
each shard, so any corpus can be learnt.  No text moves between tasks.

Defined results: a null or empty text is the end mark alone; an empty corpus
gives all 256 symbols alike; repeated rows score alike; extra columns are
carried through; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changefeed.llm import grams
from changefeed.llm.common import saved, small

ORDER = 5
#: Grams in one shard, about; a pair of context bytes is never parted.
SHARD_GRAMS = 3_000_000


def _log10(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(x > 0, np.log10(np.maximum(x, 1e-300)), 0.0)


class Trie:
    """Log10 tables of the grams of some contexts (a shard), for all orders."""

    def __init__(self, order: int, top: tuple[np.ndarray, np.ndarray], low: tuple[np.ndarray, np.ndarray]):
        """``top``: grams of the highest order; ``low``: all grams of order 1."""
        self.order = order
        levels: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * (order + 1)
        levels[order] = top
        for k in range(order - 1, 1, -1):
            levels[k] = grams.summed(levels[k + 1][0] & grams.mask(k), levels[k + 1][1])
        if order >= 1:
            levels[1] = low
            levels[0] = grams.summed(low[0] & grams.mask(0), low[1])
        self.keys = [k for k, _ in levels]
        self.log_n = [_log10(n.astype(float)) for _, n in levels]
        self.contexts, self.log_total, self.log_escape = [], [], []
        self.log_left, self.log_escape_left = [None], [None]
        stats = []
        for k in range(order + 1):
            keys, n = levels[k]
            ctx, q = grams.summed(keys >> np.uint64(8), np.ones(len(keys), np.int64))
            _, total = grams.summed(keys >> np.uint64(8), n)
            stats.append((ctx, q, total))
            self.contexts.append(ctx)
            self.log_total.append(_log10((total + q).astype(float)))
            self.log_escape.append(_log10(q.astype(float)) - self.log_total[-1])
        for k in range(1, order + 1):
            # What is left one order lower without this context's symbols.
            keys = levels[k][0]
            ctx, q, _ = stats[k]
            at, _ = grams.find(self.keys[k - 1], keys & grams.mask(k - 1))
            below, there = grams.find(stats[k - 1][0], ctx & (grams.mask(k - 1) >> np.uint64(8)))
            if not len(ctx):
                self.log_left.append(np.zeros(0))
                self.log_escape_left.append(np.zeros(0))
                continue
            _, gone = grams.summed(keys >> np.uint64(8), levels[k - 1][1][at])
            q_left = stats[k - 1][1][below] - q
            left = stats[k - 1][2][below] - gone + q_left
            self.log_left.append(_log10(left.astype(float)))
            # Nothing left: the escape is certain.
            self.log_escape_left.append(np.where(q_left > 0, _log10(q_left.astype(float)) - self.log_left[-1], 0.0))
        self.top = grams.Table(self.keys[order])
        at, _ = grams.find(self.contexts[order], self.keys[order] >> np.uint64(8))
        self.top_log = self.log_n[order] - self.log_total[order][at] if len(at) else np.zeros(0)
        self.log_rest = -math.log10(max(1, 256 - len(self.keys[0])))

    def log10p(self, keys: np.ndarray) -> np.ndarray:
        """Log10 probability of each gram's symbol in its context."""
        # The highest order: every key, without any exclusion.
        at, hit = self.top.find(keys)
        out = np.where(hit, self.top_log[at], 0.0) if len(self.top_log) else np.zeros(len(keys))
        todo = np.flatnonzero(~hit)
        came = self._escape(self.order, keys, todo, np.full(len(todo), -1), out)
        for k in range(self.order - 1, -1, -1):
            own = keys[todo] & grams.mask(k)
            at, hit = grams.find(self.keys[k], own)
            if hit.any():
                node, _ = grams.find(self.contexts[k], own[hit] >> np.uint64(8))
                total = self._left(self.log_total, self.log_left, k, node, came[hit])
                out[todo[hit]] += self.log_n[k][at[hit]] - total
            todo, came = todo[~hit], came[~hit]
            came = self._escape(k, keys, todo, came, out)
        out[todo] += self.log_rest
        return out

    def _left(self, plain, left, k: int, node: np.ndarray, came: np.ndarray) -> np.ndarray:
        """Order k's table at the nodes; where a longer context was left, that
        context's table of what it leaves."""
        got = plain[k][node]
        if k < self.order and len(left[k + 1]):
            got = np.where(came >= 0, left[k + 1][came], got)
        return got

    def _escape(self, k: int, keys, todo, came, out) -> np.ndarray:
        """Add order k's escapes where its context was seen; the contexts."""
        node, seen = grams.find(self.contexts[k], (keys[todo] & grams.mask(k)) >> np.uint64(8))
        if seen.any():
            out[todo[seen]] += self._left(self.log_escape, self.log_escape_left, k, node[seen], came[seen])
        return np.where(seen, node, -1)


class Shard:
    """A trie for the contexts that end in some pairs of bytes."""

    def __init__(self, trie: Trie, pairs: np.ndarray | None):
        self.trie, self.pairs = trie, pairs  # pairs: 65536 flags; None: all

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts))
        for keys, of in grams.slices(texts, self.trie.order):
            if self.pairs is not None:
                own = self.pairs[(keys >> np.uint64(8) & np.uint64(0xFFFF)).astype(np.int64)]
                keys, of = keys[own], of[own]
            if len(keys):
                out += np.bincount(of, self.trie.log10p(keys), len(texts))
        return out


def train(corpus: DataFrame, order: int = ORDER, text: str = "bytes",
          shard_grams: int = SHARD_GRAMS) -> "list[callable]":
    """Learn from a binary column.  Returns the shards' makers, so that the
    driver holds one shard at a time."""
    if order < 2:
        raise ValueError("order must be at least 2")
    top = saved(grams.counted(corpus, order, text=text), "ppm-grams")
    pair = F.expr("cast(shiftright(gram, 8) & 65535 as int)")
    sizes = top.groupBy(pair.alias("pair")).agg(F.count(F.lit(1)).alias("grams")).orderBy("pair").collect()  # 65,536 at most
    low = grams.to_arrays(top.groupBy(F.expr("gram & 65535").alias("gram")).agg(F.sum("n").alias("n")))  # 65,536 at most
    bins: list[list[int]] = [[]]
    room = shard_grams
    for row in sizes:
        if bins[-1] and row["grams"] > room:
            bins.append([])
            room = shard_grams
        bins[-1].append(row["pair"])
        room -= row["grams"]

    def maker(pairs: list[int], first: bool):
        def make() -> Shard:
            if len(bins) == 1:
                return Shard(Trie(order, grams.to_arrays(top), low), None)
            part = top.where(pair.isin(pairs)) if len(pairs) < 500 else top.where(pair.between(pairs[0], pairs[-1]))
            flags = np.zeros(1 << 16, bool)
            flags[pairs] = True
            if first:  # contexts never seen go with the first shard
                seen = np.zeros(1 << 16, bool)
                seen[[row["pair"] for row in sizes]] = True
                flags |= ~seen
            return Shard(Trie(order, grams.to_arrays(part), low), flags)
        return make

    return [maker(pairs, i == 0) for i, pairs in enumerate(bins)]


def pretrained(df: DataFrame, shards, text: str = "bytes", to: str = "score") -> DataFrame:
    """Add ``to`` (double): log10 probability of each text under the trie,
    one narrow pass per shard."""
    schema = T.StructType([*df.schema.fields, T.StructField(to, T.DoubleType())])
    where = df.schema.names.index(text)
    sc = df.sparkSession.sparkContext
    for i, make in enumerate(shards):
        held = sc.broadcast(make())

        def run(batches, held=held, first=i == 0):
            shard = held.value
            for batch in small(batches):
                got = shard.scores([x or b"" for x in batch.column(where).to_pylist()])
                columns = batch.columns if first else batch.columns[:-1]
                if not first:
                    got = got + batch.column(batch.num_columns - 1).to_numpy()
                yield pa.RecordBatch.from_arrays([*columns, pa.array(got)], names=schema.names)

        df = df.mapInArrow(run, schema)
    return df


def adaptive_bits(text: bytes, order: int = ORDER) -> float:
    """Code length in bits of one text, learnt as it is read (updates in
    every context of the path)."""
    counts: dict[bytes, dict[int, int]] = {}
    data = bytes([grams.START]) * order + text + bytes([grams.END])
    bits = 0.0
    for i in range(order, len(data)):
        symbol, excluded = data[i], {}
        for k in range(order, -1, -1):
            seen = counts.get(data[i - k:i])
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in excluded}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if symbol in left:
                bits -= math.log2(left[symbol] / total)
                break
            bits -= math.log2(len(left) / total)
            excluded = seen
        else:
            bits += math.log2(256 - len(excluded))
        for k in range(order + 1):
            node = counts.setdefault(data[i - k:i], {})
            node[symbol] = node.get(symbol, 0) + 1
    return bits


def adaptive(df: DataFrame, order: int = ORDER, text: str = "bytes", to: str = "bits") -> DataFrame:
    """Add ``to`` (double): the adaptive code length of each text."""
    schema = T.StructType([*df.schema.fields, T.StructField(to, T.DoubleType())])
    where = df.schema.names.index(text)

    def run(batches):
        for batch in batches:
            got = [adaptive_bits(x or b"", order) for x in batch.column(where).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], names=schema.names)

    return df.mapInArrow(run, schema)
