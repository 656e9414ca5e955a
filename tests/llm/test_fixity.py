"""Archives on disk: written, read with their offsets, damaged and audited."""

import glob
from collections import Counter

import pytest

from changefeed.llm import fixity


@pytest.fixture
def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>é {i}</p>\r\n\r\n" * (i % 5)) for i in range(100)]
    return spark.createDataFrame(rows + [(None, "http://n", "x"), (None, None, None)], "page_id long, url string, html string")


def _files(path):
    return [open(f, "rb").read() for f in sorted(glob.glob(f"{path}/file=*/part=*/*.txt"))]


def _audit(spark, pages, path, change):
    """The audit of a written archive against a copy whose file of id 0 has its list of records changed."""
    fixity.write_warc(fixity.records(pages, per_file=60), str(path / "a"))
    (path / "b").mkdir()
    for n, data in enumerate(_files(path / "a")):
        if b"urn:page:0>" in data:
            parts = [data[s:e] for s, e, *_ in fixity.framed(data)]
            change(parts)
            data = b"".join(parts)
        (path / "b" / f"{n}.warc").write_bytes(data)
    trees = (fixity.tree(fixity.read_warc(spark, str(path / x), per_file=60)) for x in "ab")
    return Counter((r["page_id"], r["status"]) for r in fixity.audit(*trees).collect())


def test_archives_read_as_written(spark, pages, tmp_path):
    recs = fixity.records(pages, per_file=60)
    fixity.write_warc(recs, str(tmp_path / "a"))
    read = fixity.read_warc(spark, str(tmp_path / "a"), per_file=60)
    want = {(r["page_id"], r["file"], r["part"], r["idx"], r["target"], r["record"].encode()) for r in recs.collect()}
    got = read.collect()
    assert {(r["page_id"], r["file"], r["part"], r["idx"], r["target"], bytes(r["record"])) for r in got} == want
    assert len(got) == 102
    whole = _files(tmp_path / "a")
    for r in got:
        assert any(data[r["start"]:r["start"] + len(r["record"])] == bytes(r["record"]) for data in whole)
        assert b"\r\nWARC-Date: " in bytes(r["record"])
    laid, disk = (fixity.tree(x) for x in (recs, read))
    assert fixity.audit(laid, disk).count() == 0
    assert [bytes(r["hash"]) for r in laid[-1].orderBy("file", "part").collect()] == [
        bytes(r["hash"]) for r in disk[-1].orderBy("file", "part").collect()]


@pytest.mark.parametrize("i, j", [(17, 18), (3, 50), (0, 59)])
def test_exchanged_records_are_found(spark, pages, tmp_path, i, j):
    def change(parts):
        parts[i], parts[j] = parts[j], parts[i]

    assert _audit(spark, pages, tmp_path, change) == Counter([(i, "moved"), (j, "moved")])


def test_broken_framing_is_found_and_left_again(spark, pages, tmp_path):
    def change(parts):
        parts[20] = parts[20].replace(b"Content-Length: 0", b"Content-Length: 7")
        parts[33] = parts[33].replace(b"WARC/1.0", b"WARK/1.0")
        parts[59] = parts[59][:-30]

    got = _audit(spark, pages, tmp_path, change)
    assert got == Counter([(20, "missing"), (33, "missing"), (59, "missing")] + [(None, "extra")] * 3)


@pytest.mark.parametrize("data", [b"", b"\r\n\r\n", b"WARC/1.0\r\n", b"x" * 1000, b"WARC/1.0\r\nContent-Length: 99\r\n\r\nab",
                                  b"\r\n\r\nWARC/1." * 500])
def test_any_bytes_are_framed_whole(data):
    spans = [(s, e) for s, e, *_ in fixity.framed(data)]
    assert b"".join(data[s:e] for s, e in spans) == data and all(s < e for s, e in spans)
