"""Best-fit packing by minimum bin slack.

Documents (ids and one end id) longer than a sequence are cut into full
pieces and a rest; pieces are then put into as few sequences as the rule
finds.  One sequence at a time is filled: a subset-sum table over the lengths
still there, kept as bit sets, gives the fullest combination that fits, which
is then taken out.  Of equally full combinations the one with the longest
pieces is taken, as short ones are easier to place later.  A combination that
is the fullest stays so while it can be made again, since taking pieces out
adds no new one; so it is taken as many times as the counts allow at once.

The rule needs only how many pieces there are of each length: at most
``max_len`` numbers however large the corpus, and at most about
``max_len * ln(max_len)`` different combinations (each time at least one
length can no longer be used as often as before).  These numbers alone reach
the driver; pieces never do.  Spark counts the lengths, and each piece finds
its place by its rank among the pieces of its length: its rank within the task
that made it, plus the counts of the tasks before.  Nothing is grouped by
length or source, so one length that a third of all pieces have costs nothing
extra.

Defined results: null or empty text is the end id alone (one piece of length
1); repeated rows and repeated doc_ids are packed each on their own; a null
doc_id stays null; extra columns, whatever their names, are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm.common import saved
from changefeed.llm.packing import _chunks, word_encoder

MAX_LEN = 2048
#: A rank within a length takes so many bits of a key.
_RANK_BITS = 44


def _with_copies(reach: int, length: int, count: int, full: int, cap: int) -> int:
    """The reachable sums with up to ``count`` more pieces of ``length``."""
    left, step = min(count, cap // length), 1
    while left:
        take = min(step, left)
        reach |= (reach << take * length) & full
        left -= take
        step *= 2
    return reach


def combinations(counts: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, list[tuple[int, int]]]]:
    """(times, [(length, pieces of it), longest first]) until nothing is left."""
    left = {n: c for n, c in counts.items() if c}
    lengths = sorted(left)
    full = (1 << max_len + 1) - 1
    reach = [1]  # reach[i]: sums of pieces of lengths[:i]
    out = []
    while lengths:
        for n in lengths[len(reach) - 1:]:
            reach.append(_with_copies(reach[-1], n, left[n], full, max_len))
        rest, chosen = reach[-1].bit_length() - 1, []
        for i in range(len(lengths) - 1, -1, -1):
            if not rest:
                break
            n = lengths[i]
            uses = min(left[n], rest // n)
            while not reach[i] >> rest - uses * n & 1:
                uses -= 1
            if uses:
                chosen.append((n, uses))
                rest -= uses * n
        times = min(left[n] // uses for n, uses in chosen)
        out.append((times, chosen))
        changed = None
        for n, uses in chosen:
            before, left[n] = left[n], left[n] - times * uses
            if min(before, max_len // n) != min(left[n], max_len // n):
                changed = n
        if changed is not None:  # the shortest length whose sums are others now
            del reach[lengths.index(changed) + 1:]
            lengths = [n for n in lengths if left[n]]
    return out


def places(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """For each run of ranks of a length that goes into one combination: its
    key (length and first rank), pieces a sequence, first sequence, offset."""
    taken: dict[int, int] = {}
    rows, first = [], 0
    for times, chosen in plan:
        at = 0
        for n, uses in chosen:
            lo = taken.get(n, 0)
            rows.append((n << _RANK_BITS | lo, lo, uses, first, at))
            taken[n] = lo + times * uses
            at += n * uses
        first += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("key", "lo", "uses", "first", "at"), table.T.copy()))


def _pieces(docs: DataFrame, tokenizer_path: str, end_id: int, max_len: int, with_ids: bool) -> DataFrame:
    """One row per piece, with the task that made it and the piece's rank
    among the task's pieces of its length."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, part int, nth long"
              + ", ids array<int>" * with_ids)

    def run(batches):
        encoder = word_encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), [0] * (max_len + 1)
        for batch in batches:
            keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in _chunks(texts):
                rows, numbers, starts, lengths, sums, nths, ids = [], [], [], [], [], [], []
                for i, raw in enumerate(encoder.encode(texts[lo:hi]), lo):
                    raw += end
                    for number, at in enumerate(range(0, len(raw) // 4, max_len)):
                        own = raw[4 * at:4 * (at + max_len)]
                        n = len(own) // 4
                        rows.append(i)
                        numbers.append(number)
                        starts.append(at)
                        lengths.append(n)
                        sums.append(zlib.crc32(own))
                        nths.append(seen[n])
                        seen[n] += 1
                        if with_ids:
                            ids.append(np.frombuffer(own, "<u4").astype(np.int32))
                long = pa.int64()
                out = [keys.take(pa.array(rows, long)), pa.array(numbers, pa.int32()),
                       *(pa.array(x, long) for x in (starts, lengths, sums)),
                       pa.array([part] * len(rows), pa.int32()), pa.array(nths, long)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                if with_ids:
                    out.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)
        encoder.forget()

    return docs.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, max_len: int = MAX_LEN,
         doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset, and the ids (array of int) if ``with_ids``."""
    if max_len < 1:
        raise ValueError("max_len must be positive")
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    # Written once: ranks and counts below are of these very rows.
    pieces = saved(_pieces(named, tokenizer_path, end_id, max_len, with_ids), "pieces")
    counts = saved(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-lengths")
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = places(combinations(total, max_len))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (pieces.join(bases, ["part", "length"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []),
                      (F.col("base") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))

    def run(batches):
        for batch in batches:
            n, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "sequence_id"))
            row = np.searchsorted(where["key"], n << _RANK_BITS | rank, "right") - 1
            far, own = np.divmod(rank - where["lo"][row], where["uses"][row])
            names = batch.schema.names
            columns = dict(zip(names, batch.columns), sequence_id=pa.array(where["first"][row] + far),
                           offset=pa.array(where["at"][row] + own * n))
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return ranked.mapInArrow(run, ranked.schema)
