"""Byte n-grams of whole texts, counted and looked up in arrays.

A text is its UTF-8 bytes with ``order`` start marks before and one end mark
after (two values that UTF-8 never has), so every symbol has a full context.
A gram of order k, k context bytes and a symbol, is one unsigned integer with
the symbol in its lowest byte; without its leading bytes it is the gram of a
lower order, and without its lowest byte its context.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = 0xFE, 0xFF
#: Bytes worked on at once; the arrays of a step are some dozens of times as large.
SLICE = 1 << 18
#: Grams a task gathers before it adds up equal ones.
GATHERED = 1 << 21
#: Rows of counts handed back at once.
OUT_ROWS = 50_000


def mask(order: int) -> np.uint64:
    """Keeps the lowest ``order`` + 1 bytes."""
    return np.uint64((1 << 8 * (order + 1)) - 1)


def slices(texts: list[bytes], order: int, most: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, which text each is of) for all symbols of the texts, in order,
    about ``most`` at a time; a long text is worked on in overlapping parts."""
    rows: list[bytes] = []
    of: list[tuple[int, int]] = []
    size = 0

    def flush():
        data = np.frombuffer(b"".join(rows), np.uint8)
        keys = np.zeros(len(data), np.uint64)
        for j in range(order, -1, -1):
            keys[order:] = keys[order:] << np.uint64(8) | data[order - j:len(data) - j]
        sizes = np.array([n for _, n in of])
        starts = np.cumsum(sizes + order) - sizes
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return keys[at], np.repeat(np.array([i for i, _ in of]), sizes)

    for i, text in enumerate(texts):
        data = bytes([START]) * order + text + bytes([END])
        for lo in range(0, len(data) - order, most):
            part = data[lo:lo + most + order]
            rows.append(part)
            of.append((i, len(part) - order))
            size += len(part)
            if size >= most:
                yield flush()
                rows, of, size = [], [], 0
    if rows:
        yield flush()


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in a sorted array, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, table[at] == keys


class Table:
    """Places of sorted distinct keys, looked up through an open hash table
    (a binary search would touch many more cache lines per key)."""

    EMPTY = np.uint64(2**64 - 1)
    SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        bits = max(8, int(2 * len(keys)).bit_length())
        self.shift, self.wrap = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, self.EMPTY)
        self.places = np.zeros(1 << bits, np.int32)
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.slots[at] == self.EMPTY
            won, first = np.unique(at[free], return_index=True)
            chosen = left[free][first]
            self.slots[won], self.places[won] = keys[chosen], chosen
            lost = self.slots[at] != keys[left]
            left, at = left[lost], (at[lost] + 1) & self.wrap

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys * self.SPREAD >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of each key."""
        at = self._home(keys)
        got = self.slots[at]
        hit = got == keys
        place = self.places[at]
        left = np.flatnonzero(~hit & (got != self.EMPTY))
        at = at[left]
        while len(left):
            at = (at + 1) & self.wrap
            got = self.slots[at]
            same = got == keys[left]
            place[left[same]] = self.places[at[same]]
            hit[left[same]] = True
            go = ~same & (got != self.EMPTY)
            left, at = left[go], at[go]
        return place, hit


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their counts added up."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(counts, first) if len(first) else counts)


def counted(df: DataFrame, order: int, group: str | None = None, text: str = "bytes") -> DataFrame:
    """Grams of the top order over all rows: (group,) gram long, n long.
    ``text`` is a binary column.  Each task adds up what it has read before
    anything is shuffled."""
    cols = ([group] if group else []) + [text]
    names = ([group] if group else []) + ["gram", "n"]
    schema = (f"{group} string, " if group else "") + "gram long, n long"

    def added(held):
        return {g: [summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))]
                for g, parts in held.items()}

    def out(held):
        for g, [(k, n)] in added(held).items():
            for lo in range(0, len(k), OUT_ROWS):
                part = [pa.array(x[lo:lo + OUT_ROWS].astype(np.int64)) for x in (k, n)]
                if group:
                    part.insert(0, pa.repeat(pa.scalar(g, pa.string()), len(part[0])))
                yield pa.RecordBatch.from_arrays(part, names=names)

    def run(batches):
        held: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            raws = [x or b"" for x in batch.column(len(cols) - 1).to_pylist()]
            groups = batch.column(0).to_pylist() if group else [None] * len(raws)
            for g in dict.fromkeys(groups):
                for keys, _ in slices([r for r, own in zip(raws, groups) if own == g], order):
                    held.setdefault(g, []).append(np.unique(keys, return_counts=True))
            if sum(len(k) for parts in held.values() for k, _ in parts) > GATHERED:
                held = added(held)
                if sum(len(k) for parts in held.values() for k, _ in parts) > GATHERED // 2:
                    yield from out(held)
                    held = {}
        yield from out(held)

    keys = ([group] if group else []) + ["gram"]
    return df.select(*cols).mapInArrow(run, schema).groupBy(*keys).agg(F.sum("n").alias("n"))


def to_arrays(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(gram, n) rows on the driver, sorted; for tables of a checked size."""
    t = rows.select("gram", "n").toArrow()
    keys = t.column("gram").to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    return keys[order], t.column("n").to_numpy().astype(np.int64)[order]
