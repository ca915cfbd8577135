"""Byte-level BPE by the tiktoken library with a local rank file: texts to ids, ids to bytes.

A text's ids are those of its matches of the pattern, each merged on its own. The
library's pattern matching keeps a stack entry per character of a white-space run
and fails beyond a million of them, so a long text is first cut where a match ends
whatever surrounds it:

* between a character that is no white space and one that is: no match holds the
  first before the second, and matching looks ahead only out of white space;
* between a letter and a punctuation mark, for texts with few spaces;
* before the last character of a white-space run (after it at the end of the text):
  the run up to there is one match, and a very long one is merged as such.

A stretch without any of these is one match of letters, digits or signs, or short,
and is encoded whole.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts up to this many characters go to the library as they are; longer ones in pieces of about as many.
PIECE_CHARS = 65_536
#: White-space runs from this length are matched here.
LONG_RUN = 4_096
#: About this many characters or ids leave a task's Python at once.
OUT_VALUES = 1 << 20

# Hiragana, katakana and Han letters, and their punctuation marks (comma, full stop, exclamation, ...).
_LETTERS = "-".join(map(chr, (0x3041, 0x3096))) + "-".join(map(chr, (0x30A1, 0x30FA))) + "-".join(map(chr, (0x4E00, 0x9FFF)))
_MARKS = "".join(map(chr, (0x3001, 0x3002, 0xFF01, 0xFF0C, 0xFF1A, 0xFF1B, 0xFF1F)))
# Unicode White_Space, which is what the pattern's \s means.
_SPACE = r"\t-\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_RUN = re.compile(f"[{_SPACE}]{{{LONG_RUN},}}")
_SAFE = re.compile(rf"[^{_SPACE}](?=[{_SPACE}])|[A-Za-z{_LETTERS}](?=[!-/:-@\[-`{{-~{_MARKS}])")


def _cut(text: str, begin: int, end: int) -> Iterator[str]:
    """text[begin:end] in pieces of about ``PIECE_CHARS`` that start and end between matches."""
    while end - begin > PIECE_CHARS:
        found = _SAFE.search(text, begin + PIECE_CHARS, end)
        if not found:
            break
        yield text[begin : found.end()]
        begin = found.end()
    yield text[begin:end]


def safe_pieces(text: str) -> Iterator[tuple[str, bool]]:
    """The text as (piece, whether it is one match); ids of the pieces in order are the text's."""
    begin = 0
    if len(text) > PIECE_CHARS:
        for run in _RUN.finditer(text):
            # A run before other characters leaves its last one to them.
            stop = run.end() if run.end() == len(text) else run.end() - 1
            yield from ((p, False) for p in _cut(text, begin, run.start()))
            yield text[run.start() : stop], True
            begin = stop
    yield from ((p, False) for p in _cut(text, begin, len(text)))


class Codec:
    """The library's encoding of a rank file, and one that takes a text as a single match."""

    def __init__(self, rank_file: str, pattern: str):
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.by_pattern = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.as_one = tiktoken.Encoding("ranks-whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        parts = [(self.as_one if one else self.by_pattern).encode_ordinary(p) for p, one in safe_pieces(text) if p]
        return np.array(parts[0] if len(parts) == 1 else [i for p in parts for i in p], dtype=np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return self.by_pattern.decode_bytes(ids)


@lru_cache(maxsize=4)
def codec(rank_file: str, pattern: str) -> Codec:
    """Kept between the tasks of a Python worker."""
    return Codec(rank_file, pattern)


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``OUT_VALUES`` in all; a larger row is alone."""
    ends = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - sizes[a] + OUT_VALUES, side="right")))
        yield a, b
        a = b


def _encode(rank_file: str, pattern: str):
    def run(batches):
        c = codec(rank_file, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _groups(np.array([len(t or "") for t in texts], dtype=np.int64)):
                ids = [c.encode(t or "") for t in texts[a:b]]
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), column], names=["doc_id", "ids"])

    return run


def encode_documents(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row, by its whole text.

    A null or empty text has no ids. Every row is a document: repeated or null
    doc_ids each keep their row. Other columns are not read; an empty table gives
    no rows. The rank file (a base64 token and its rank a line) must be readable at
    the same path on every executor; no string is special.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return text.mapInArrow(_encode(rank_file, pattern), "doc_id long, ids array<int>")


def _decode(rank_file: str, pattern: str, at: int):
    def run(batches):
        c = codec(rank_file, pattern)
        for batch in batches:
            column = batch.column(at)
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in _groups(sizes):
                raw = [c.decode(ids or []) for ids in column.slice(a, b - a).to_pylist()]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=[*part.schema.names, "decoded"])

    return run


def decode_ids(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """All columns and ``decoded``, the bytes of ``ids`` (a column of that name is replaced).

    Bytes, not text: ids that end inside a character decode to its first bytes.
    Null ids decode to no bytes; an id outside the rank file is an error.
    """
    kept = encoded.drop("decoded")
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())])
    return kept.mapInArrow(_decode(rank_file, pattern, kept.columns.index("ids")), schema)


def round_trip_digest(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids, one space between) and decoded_sha256 of every row."""
    both = decode_ids(encode_documents(docs, rank_file, pattern), rank_file, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
