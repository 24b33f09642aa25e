"""Byte-level BPE from a rank file, with the tiktoken library, and raw-byte decoding.

``encode`` gives the ids of whole texts, each match of the pattern merged by itself, no
special tokens; ``decode`` gives the bytes that ids stand for, never replaced or
repaired, so a slice of ids that ends inside a character decodes as well.

Long texts are cut before the library's pattern runs, which keeps a fixed stack
for white space (a run of about a million characters overflows it). Cuts lie only where
no match can lie across:

* before white space that follows anything else, and between ASCII letters, digits
  and other signs (but not after an apostrophe, which may lead a contraction);
* a long run of white space is one match but for its last character, which may
  belong to what follows; the run is merged as one piece and needs no pattern.

Defined results: a null text is an empty one (no ids); rows with equal or null ids stay as
they are; an empty table gives no rows; other columns are not read. Ids beyond the
ranks raise a ValueError.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.shared_files import ship_package

#: Characters between cuts, and of a run of white space that is merged apart.
CHUNK = 1 << 16
#: Bytes of one batch handed back to Spark.
BATCH_BYTES = 8 << 20

SAFE = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})"
                     r"|(?<=[A-Za-z])(?=[0-9!-/:-@\[-`{-~])"
                     r"|(?<=[0-9])(?=[A-Za-z!-/:-@\[-`{-~])"
                     r"|(?<=[!-&(-/:-@\[-`{-~])(?=[A-Za-z0-9])")

_CODECS: dict[tuple[str, str], RankBpe] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file (a line holds the base64 of the bytes and the id)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class RankBpe:
    def __init__(self, path: str, pattern: str, chunk: int = CHUNK):
        import tiktoken

        self._chunk = chunk
        self._long_space = regex.compile(r"\p{White_Space}{%d,}+" % chunk)
        self._library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path),
                                          special_tokens={})

    def _parts(self, text: str) -> Iterator[str | bytes]:
        """Parts of a long text in order: strings for the pattern, bytes that are one match."""
        at = 0
        for run in self._long_space.finditer(text):
            yield from self._cut(text, at, run.start())
            at = run.end() - (run.end() < len(text))
            if at > run.start():
                yield text[run.start():at].encode()
        yield from self._cut(text, at, len(text))

    def _cut(self, text: str, at: int, end: int) -> Iterator[str]:
        while end - at > self._chunk:
            m = SAFE.search(text, at + self._chunk, end)
            if m is None:
                break
            yield text[at:m.start()]
            at = m.start()
        if at < end:
            yield text[at:end]

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= self._chunk:
            return np.array(self._library.encode_ordinary(text), "<u4")
        ids = [self._library._encode_single_piece(p) if isinstance(p, bytes)
               else self._library.encode_ordinary(p) for p in self._parts(text)]
        return np.concatenate([np.array(x, "<u4") for x in ids])

    def decode(self, ids: np.ndarray) -> bytes:
        try:
            return self._library.decode_bytes(ids.tolist())
        except KeyError as e:
            raise ValueError(f"not an id of the rank file: {e}") from None


def codec(path: str, pattern: str) -> RankBpe:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = RankBpe(path, pattern)
    return _CODECS[path, pattern]


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``BATCH_BYTES``; binary columns count."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 16 + sum(len(x) for x in row if isinstance(x, bytes))
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of ``docs`` (doc_id, text): ids as little-endian unsigned 32-bit integers."""
    ship_package(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        rows = ((k, c.encode(t or "").tobytes()) for b in batches
                for k, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True))
        return _batches(rows, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded) of rows (doc_id, ids): the bytes the ids stand for."""
    ship_package(encoded.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        rows = ((k, x, c.decode(np.frombuffer(x or b"", "<u4"))) for b in batches
                for k, x in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist(), strict=True))
        return _batches(rows, schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
