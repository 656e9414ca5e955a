"""Packing by power-of-two decomposition.

Each document's ids (with one end id) are cut into pieces whose lengths are
powers of two: as many of ``max_len`` as fit, then the binary digits of the
rest, longest first.  A sequence is one piece, so no sequence crosses
documents and none needs padding; sequences of one length form a bucket
(``bucket`` = the length), and a trainer draws each batch from one bucket.

The pass is narrow: no shuffle and no group, so a hot source costs nothing
extra.  ``sequence_id`` is the row's place in the partitioned output
(partition number and place in it), unique, and the same again for the same
input splits.

Tokenizing: white space only separates words for this tokenizer (it is
normalised to one space and dropped, and no rule reaches across it), so the
ids of a text are the ids of its words joined.  Words seen lately come from
a per-worker table of bounded size; the missing words of a batch are encoded
in a few calls, without any loss.

Defined results: null or empty text is the end id alone (one piece of length
1); repeated rows and repeated doc_ids are packed each on their own; a null
doc_id stays null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import gc
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LEN = 4096
#: Distinct words a worker keeps with their ids, about, beyond those of the texts at hand.
CACHE_WORDS = 1_000_000

_ASCII_WORDS = re.compile(r"[^ \t-\r]+")
#: White space to Python's split() but perhaps not to the tokenizer.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")


def split_words(text: str) -> list[str]:
    """Runs of characters other than ASCII white space."""
    if _ODD_SPACE.search(text):
        return _ASCII_WORDS.findall(text)
    return text.split()


def piece_lengths(n: int, max_len: int = MAX_LEN) -> list[int]:
    """``n`` as powers of two up to ``max_len`` (itself one), longest first."""
    full, rest = divmod(n, max_len)
    return [max_len] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class _Recent:
    """A table of bounded size that keeps what was used lately: when the new
    half is full it becomes the old one, and what is found there moves up."""

    def __init__(self, most: int):
        self.half = max(1, most // 2)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, keys: set[str]) -> set[str]:
        """Keys in neither half; those in the old one are moved up."""
        left = keys.difference(self.new)
        if len(self.new) + len(left) > self.half:
            self.old, self.new = self.new, {}
            left = keys
        out = left.difference(self.old)
        old = self.old
        self.new.update([(k, old[k]) for k in left.difference(out)])
        return out


class WordEncoder:
    """Texts to little-endian unsigned 32-bit ids, through tables of words.

    A word of Latin letters with marks after it is looked up as the letters
    in lower case and the marks: the tokenizer lower-cases, and parts them.
    """

    # Letters that are single characters in lower case too, and composed.
    _LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e"
    _TAILED = re.compile(rf"([{_LATIN}]+)([^A-Za-z0-9'\x00-\x20\x7f-\U0010ffff]*)")
    _LETTERS = re.compile(rf"[{_LATIN}]+")

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)  # special tokens in a text get their own ids
        zero = self.tokenizer.encode("0", add_special_tokens=False).ids
        self.zero = zero[0] if len(zero) == 1 else -1
        # Lower-case Latin letters need no normaliser and are one unit each,
        # closed by an id that ends a word.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.cache_words = cache_words
        self.forget()

    def forget(self) -> None:
        """Empty the table: a worker waits for its next task without it."""
        self.known = _Recent(self.cache_words)

    def _encode_units(self, units: list[str]) -> None:
        # The digit 0 is always one unit with one id, which nothing else
        # has: words without it share a call, parted by it.
        known = self.known.new
        letters = self._LETTERS.fullmatch
        plain = [u for u in units if u.islower() and (u.isalpha() if u.isascii() else letters(u))]
        for lo in range(0, len(plain), 4000):
            part = plain[lo:lo + 4000]
            enc = self.letters.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            ids = np.array(enc.ids, "<u4")
            stops = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(stops) == len(part):
                raw = ids.tobytes()
                known.update(zip(part, [raw[at:stop] for at, stop in zip([0, *stops], stops)]))
        mixed = [u for u in units if u not in known]
        for lo in range(0, len(mixed), 4000):
            joined = [u for u in mixed[lo:lo + 4000] if "0" not in u]
            if not joined:
                continue
            enc = self.tokenizer.encode_batch_fast([" 0 ".join(joined)], add_special_tokens=False)[0]
            ids = np.array(enc.ids, "<u4")
            stops = np.flatnonzero(ids == self.zero)
            if len(stops) == len(joined) - 1:
                raw, at = ids.tobytes(), 0
                for unit, stop in zip(joined, [*stops.tolist(), len(ids)]):
                    known[unit] = raw[4 * at:4 * stop]
                    at = stop + 1
        rest = [u for u in units if u not in known]
        for unit, enc in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            known[unit] = np.array(enc.ids, "<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        """Words that the table has not; their letters and marks are entries
        of the same table."""
        known, match = self.known.new, self._TAILED.fullmatch
        cut, units = [], set()
        for w in words:
            if w.isalpha() and w.islower() or not (m := match(w)):
                units.add(w)
            else:
                core, tail = m[1].lower(), m[2]
                cut.append((w, core, tail))
                units.add(core)
                units.add(tail)
        units.discard("")
        units.difference_update(known)
        old = self.known.old
        for u in units.intersection(old):
            known[u] = old[u]
        self._encode_units(list(units.difference(known)))
        for w, core, tail in cut:
            known[w] = known[core] + known[tail] if tail else known[core]

    def encode(self, texts: list[str]) -> list[bytes]:
        collects = gc.isenabled()
        gc.disable()  # millions of small objects and no cycle: a collection only costs time
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        lists = [split_words(t) for t in texts]
        distinct: set[str] = set()
        for words in lists:
            distinct.update(words)
        self._learn(self.known.missing(distinct))
        get = self.known.new.__getitem__
        return [b"".join(map(get, words)) for words in lists]


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _chunks(texts: list[str], most: int = 4_000_000):
    """Places of texts in runs of about ``most`` characters."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    yield start, len(texts)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, max_len: int = MAX_LEN,
         doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, bucket, ids (array of int, if
    ``with_ids``), ids_crc32, doc_tokens, sequence_id, offset."""
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = (f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"
              + ", ids array<int>" * with_ids)

    def run(batches):
        encoder = word_encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in _chunks(texts):
                rows, starts, lengths, sums, totals, ids = [], [], [], [], [], []
                for i, raw in enumerate(encoder.encode(texts[lo:hi]), lo):
                    raw += end
                    n, at = len(raw) // 4, 0
                    for length in piece_lengths(n, max_len):
                        part = raw[4 * at:4 * (at + length)]
                        rows.append(i)
                        starts.append(at)
                        lengths.append(length)
                        sums.append(zlib.crc32(part))
                        totals.append(n)
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                        at += length
                long = pa.int64()
                out = [keys.take(pa.array(rows, long)), *(pa.array(x, long) for x in (starts, lengths, sums, totals))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    out.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)
        encoder.forget()

    pieces = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
    return (pieces.withColumn("bucket", F.col("length"))
            .withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the sequences in one folder per length."""
    pieces.write.partitionBy("bucket").parquet(path)
