"""Byte-level BPE encoding and decoding with a local rank file.

``encode`` adds the ids of each whole text, ``decode`` the raw bytes of an id
list.  Both are narrow: no shuffle, one Arrow batch in memory at a time, and
nothing but the vocabulary is held by a worker, so a lost executor only
re-runs its own splits.

Long texts are handed to the tokenizer in parts.  A part ends only between a
visible character and a following space or newline; no match of the split
pattern contains white space after a visible character, so the parts' ids
joined are the ids of the whole.

Defined results: null or empty text has no ids and decodes to no bytes;
repeated rows are encoded alike, each on its own; extra columns are carried
through (a clashing output name is refused); an empty table gives an empty
table.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from changefeed.llm.common import small

#: Characters given to the tokenizer at once, about.
PART_CHARS = 1 << 16
_CUT = re.compile(r"(?:[!-~]|[^\W_])(?=[ \n])")


@functools.lru_cache(maxsize=4)
def encoding(rank_path: str, pattern: str):
    """The tokenizer of a rank file, built once per worker."""
    import tiktoken

    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, part_chars: int = PART_CHARS) -> Iterator[str]:
    """Cut a text where no match of the pattern can lie across the cut."""
    start = 0
    while len(text) - start > part_chars:
        m = _CUT.search(text, start + part_chars - 1)
        if m is None:
            break
        yield text[start:m.end()]
        start = m.end()
    yield text[start:]


def encode_text(enc, text: str, part_chars: int = PART_CHARS) -> list[int]:
    if len(text) <= part_chars:
        return enc.encode_ordinary(text)
    return [i for part in safe_parts(text, part_chars) for i in enc.encode_ordinary(part)]


def _with_column(df: DataFrame, name: str, dtype: T.DataType) -> T.StructType:
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the input already has a column {name!r}")
    return T.StructType([*df.schema.fields, T.StructField(name, dtype)])


def encode(df: DataFrame, rank_path: str, pattern: str, text: str = "text",
           ids: str = "token_ids", part_chars: int = PART_CHARS) -> DataFrame:
    """Add ``ids`` (array of int): the tokens of each whole text."""
    schema = _with_column(df, ids, T.ArrayType(T.IntegerType(), False))

    def run(batches):
        enc = encoding(rank_path, pattern)
        for batch in small(batches):
            texts = batch.column(batch.schema.get_field_index(text))
            got = pa.array([encode_text(enc, t.as_py() or "", part_chars) for t in texts],
                           pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, ids])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, rank_path: str, pattern: str, ids: str = "token_ids",
           to: str = "decoded") -> DataFrame:
    """Add ``to`` (binary): the raw bytes of the ids; they need not be UTF-8."""
    schema = _with_column(df, to, T.BinaryType())

    def run(batches):
        enc = encoding(rank_path, pattern)
        for batch in small(batches):
            lists = batch.column(batch.schema.get_field_index(ids))
            got = pa.array([enc.decode_bytes(x.values.to_pylist() if x.is_valid else [])
                            for x in lists], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, to])

    return df.mapInArrow(run, schema)
