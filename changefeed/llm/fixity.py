"""Merkle fixity audit of WARC archives.

``records`` lays pages out as WARC records: ``per_file`` ids to a file, in
id order, each with its byte offset; ``read_warc`` reads records and their offsets from
archive files.  ``tree`` hashes every record and then
ranges of ``fanout`` neighbours, level by level, to one root per file; a node
covers one range of offsets, and its hash the order of its records on disk, their
offsets in the range and their lengths.  ``audit`` compares the roots of two replicas
and goes down only into branches whose hashes differ, to the damaged records.

A leaf's branch is taken from its id alone, never from its neighbours, and offsets
are hashed from the start of the range, so a
record missing or added in mid-file changes no other branch.  Records of one place
are told apart by their hash: equal ones cancel out between the replicas, and
what is left of each is paired in order.

Records are hashed where they are read; what moves is a hash, a length and an
id per record, exact copies added up first.  A file has a bounded number of
places by construction (rows without an id are dealt to the places of
``NULL_PARTS`` parts by their url), trees are saved to the shared folder, and
the audit's joins read one level at a time with the (few) open branches.

Defined results: null html is an empty payload and a null url an empty
target; rows with null ids share one file and are paired by their url;
repeated rows are records of their own, in order of their hash; a record that
one replica lacks is ``missing`` (or ``extra``); a sound record in a differing branch that
stands at another rank among the file's sound records is ``moved``; a stretch of an archive that is not a
record by its own length is read as one without an id up to the next record; ``idx`` is the place in the
file, shared by records of one id; equal replicas give no rows, as do empty
tables; extra columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changefeed.llm.common import saved

PER_FILE = 2000
FANOUT = 16
#: Parts of the file of rows without an id.
NULL_PARTS = 4096
#: The pages carry no time of their own; the record form asks for one.
DATE = "1970-01-01T00:00:00Z"


def record_text(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC record as text, with the blank lines that end it."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def _seats(recs: DataFrame, per_file: int) -> DataFrame:
    """With file, part, idx (place in the file's part) and target (tells rows
    without an id apart), from page_id and url."""
    none = F.col("page_id").isNull()
    target = F.when(none, F.xxhash64(F.coalesce(F.col("url").cast("string"), F.lit(""))))
    dealt = F.pmod(target, F.lit(per_file * NULL_PARTS))
    file = F.expr(f"page_id div {per_file}").cast("long")
    return recs.select(file.alias("file"),
                       F.when(none, F.floor(dealt / per_file)).otherwise(0).cast("long").alias("part"),
                       F.when(none, dealt % per_file).otherwise(F.col("page_id") - file * per_file).cast("long").alias("idx"),
                       target.alias("target"), "page_id", "record", *(c for c in ("start",) if c in recs.columns))


def records(pages: DataFrame, per_file: int = PER_FILE) -> DataFrame:
    """file, part, idx, target, page_id and record (text) of every page."""
    return _seats(pages.select("page_id", "url", record_text(F.col("page_id"), F.col("url"), F.col("html")).alias("record")), per_file)


def write_warc(recs: DataFrame, path: str) -> None:
    """Write the records as WARC files, one folder per archive file and part."""
    end = "\r\n\r\n"
    body = F.expr("left(record, length(record) - 4)")  # the writer adds the end again
    (recs.repartition("file", "part").sortWithinPartitions("file", "part", "idx", "target")
     .select("file", "part", body.alias("record")).write.partitionBy("file", "part").option("lineSep", end).text(path))


_HEADER = re.compile(rb"WARC/1\.\d\r\n(?:[^\r\n]+\r\n)+\r\n")
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)[ \t]*\r\n", re.I)
_ID = re.compile(rb"\r\nwarc-record-id:[ \t]*<urn:page:(-?\d+)>", re.I)
_TARGET = re.compile(rb"\r\nwarc-target-uri:[ \t]*([^\r\n]*)", re.I)
_NEXT = b"\r\n\r\nWARC/1."


def framed(data: bytes):
    """(start, end, page_id, url) of an archive's records.  Where a length does
    not lead to the end of a record, the stretch up to the next start is one
    whose id and target are null."""
    at = 0
    while at < len(data):
        head = _HEADER.match(data, at)
        size = _LENGTH.search(head[0]) if head else None
        end = head.end() + int(size[1]) + 4 if size else -1
        sound = size and data[end - 4:end] == b"\r\n\r\n" and (
            end == len(data) or data.startswith(b"WARC/1.", end) or data.find(_NEXT, at, end) < 0)
        if sound:
            page, url = _ID.search(head[0]), _TARGET.search(head[0])
            yield at, end, int(page[1]) if page else None, url[1].decode("utf-8", "replace") if url else None
        else:
            end = data.find(_NEXT, at)
            end = len(data) if end < 0 else end + 4
            yield at, end, None, None
        at = end


def read_warc(spark: SparkSession, path: str, per_file: int = PER_FILE) -> DataFrame:
    """The records (bytes) of archive files (``.warc``, not compressed, or
    ``write_warc``'s) with their places and ``start``, the offset in their
    file.  An archive is read as one piece, so it must fit a worker (a gigabyte at most)."""
    def run(batches):
        for batch in batches:
            for raw in batch.column(0):
                data = raw.as_py()
                rows = list(framed(data))
                for lo in range(0, len(rows), 1000):
                    part = rows[lo:lo + 1000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[2] for r in part], pa.int64()), pa.array([r[3] for r in part], pa.string()),
                         pa.array([data[r[0]:r[1]] for r in part], pa.binary()), pa.array([r[0] for r in part], pa.int64())],
                        names=["page_id", "url", "record", "start"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{warc,txt}").load(path)
    return _seats(files.select("content").mapInArrow(run, "page_id long, url string, record binary, start long"), per_file)


#: What tells a place from all others.
_PLACE = ("file", "part", "idx", "target")


def leaves(recs: DataFrame) -> DataFrame:
    """file, part, idx, target, start (offset in the part of the file), length,
    hash, copies (equal records) and page_id.

    Without a ``start`` of their own, records stand in the order of ``seat``, if
    given, else of ``idx``."""
    own, seat = "start" in recs.columns, "seat" if "seat" in recs.columns else "idx"
    hashed = recs.select(*_PLACE, "page_id", F.octet_length("record").cast("long").alias("length"),
                         F.unhex(F.sha2(F.col("record").cast("binary"), 256)).alias("hash"),
                         F.col("start" if own else seat).cast("long").alias("at"))
    each = hashed.groupBy(*_PLACE, "page_id", "length", "hash").agg(F.count(F.lit(1)).alias("copies"), F.min("at").alias("at"))
    order = Window.partitionBy("file", "part").orderBy("at", "target", "hash")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.coalesce(F.sum(F.col("length") * F.col("copies")).over(before), F.lit(0))
    return each.select(*_PLACE, (F.col("at") if own else size).cast("long").alias("start"),
                       "length", "hash", "copies", "page_id")


def tree(recs: DataFrame, fanout: int = FANOUT, name: str = "tree") -> list[DataFrame]:
    """Saved levels from the leaves to the roots (one row per file's part)."""
    levels = [saved(leaves(recs), f"{name}-0")]
    most = levels[0].agg(F.max(F.abs("idx"))).first()[0]
    width = (most if most is not None else 0) + 1
    while width > 1:
        below = levels[-1]
        first = len(levels) == 1
        size = F.col("length") * F.col("copies") if first else F.col("length")
        kid = ["start", "idx", *(["target", "hash", "copies"] if first else ["hash"]), "length"]
        kids = F.array_sort(F.collect_list(F.struct(*(F.coalesce(c, F.lit(0)).alias(c) if c == "target" else c for c in kid))))
        text = lambda c: F.concat_ws(":", (c["start"] - F.col("start")).cast("string"),
                                     *(F.hex(c[k]) if k == "hash" else c[k].cast("string") for k in kid[1:]))
        joined = F.concat_ws(",", F.transform(F.col("kids"), text))
        up = (below.groupBy("file", "part", F.expr(f"idx div {fanout}").alias("up"))
              .agg(kids.alias("kids"), F.min("start").alias("start"), F.sum(size).cast("long").alias("length"))
              .select("file", "part", F.col("up").alias("idx"), "start", "length",
                      F.unhex(F.sha2(joined.cast("binary"), 256)).alias("hash")))
        levels.append(saved(up, f"{name}-{len(levels)}"))
        width = -(-width // fanout)
    return levels


def _same(*columns: str):
    on = F.lit(True)
    for c in columns:
        on = on & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return on


def _either(*columns: str) -> list[Column]:
    return [F.when(F.col("l.hash").isNull(), F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")).alias(c) for c in columns]


def _surplus(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """The records of one replica that the other does not hold, one row each
    and numbered (nth) within their place."""
    other = theirs.select(*_PLACE, "hash", F.col("copies").alias("matched"))
    left = mine.alias("l").join(other.alias("r"), _same(*_PLACE, "hash"), "left")
    held = F.coalesce("r.matched", F.lit(0))
    more = left.where(F.col("l.copies") > held).select(
        *(F.col(f"l.{c}") for c in (*_PLACE, "page_id", "length", "hash", "start")),
        F.explode(F.sequence(held, F.col("l.copies") - 1)).alias("copy"))
    nth = F.row_number().over(Window.partitionBy(*_PLACE).orderBy("hash", "copy"))
    return more.withColumns({"start": F.col("start") + F.col("copy") * F.col("length"), "nth": nth}).drop("copy")


def _moved(good: DataFrame, other: DataFrame, open_: DataFrame | None, inside) -> DataFrame:
    """The records that both replicas hold, at different ranks among these in
    their file, in open branches."""
    if open_ is not None:
        files = open_.select(F.col("o_file").alias("f"), F.col("o_part").alias("p")).distinct()
        same = F.col("file").eqNullSafe(F.col("f")) & (F.col("part") == F.col("p"))
        good, other = (x.join(files, same, "left_semi") for x in (good, other))
    both = good.alias("l").join(other.alias("r"), _same(*_PLACE, "hash")).select(
        *(F.col(f"l.{c}").alias(c) for c in ("file", "part", "idx", "start", "length", "page_id", "hash")),
        *(F.row_number().over(Window.partitionBy("l.file", "l.part").orderBy(f"{x}.start", "l.idx", "l.target", "l.hash")).alias(f"{x}_rank")
          for x in "lr"))
    moved = both.where("l_rank <> r_rank")
    return moved if open_ is None else moved.join(open_, inside, "left_semi")


def audit(good: list[DataFrame], other: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Damaged records: file, idx, start, length, page_id, status (damaged,
    missing, extra or moved), expected and found (hex hashes).

    Trees of unequal height are compared from the lower one's top level."""
    open_ = None
    inside = (F.col("file").eqNullSafe(F.col("o_file")) & (F.col("part") == F.col("o_part"))
              & (F.expr(f"idx div {fanout}") == F.col("o_idx")))
    for n in range(min(len(good), len(other)) - 1, -1, -1):
        a, b = good[n], other[n]
        if open_ is not None:
            a, b = (x.join(open_, inside, "left_semi") for x in (a, b))
        if n:
            differ = a.alias("l").join(b.alias("r"), _same("file", "part", "idx"), "full_outer")
            differ = differ.where(~F.col("l.hash").eqNullSafe(F.col("r.hash"))).select(*_either("file", "part", "idx"))
            open_ = saved(differ.select(*(F.col(c).alias(f"o_{c}") for c in ("file", "part", "idx"))), f"open-{n}")
    l, r = _surplus(a, b).alias("l"), _surplus(b, a).alias("r")
    found = l.join(r, _same(*_PLACE, "nth"), "full_outer")
    status = F.when(F.col("r.hash").isNull(), "missing").when(F.col("l.hash").isNull(), "extra").otherwise("damaged")
    changed = found.select(*_either("file", "idx", "start", "length", "page_id"), status.alias("status"),
                           F.lower(F.hex("l.hash")).alias("expected"), F.lower(F.hex("r.hash")).alias("found"))
    hex_ = F.lower(F.hex("hash"))
    return changed.unionByName(_moved(good[0], other[0], open_, inside).select(
        "file", "idx", "start", "length", "page_id", F.lit("moved").alias("status"), hex_.alias("expected"), hex_.alias("found")))
