"""Token-id files with bit-plane shuffling.

``write_token_ids`` range-sorts documents by id, encodes whole texts, and writes one
file per partition. Inside a file the ids lie in fixed-size blocks; a block is
transposed into bit planes (or byte planes), each plane is compressed with
zstandard, and a chunk index (offset, ids, crc32, size of each plane) and a document
index follow. ``read_token_ids`` reads the files back, one task per file, a
block at a time.

File layout (all integers little-endian)::

    b"HGTP1\\n"
    chunk 0: plane 0, plane 1, ...      zstandard frames; an empty frame is a plane of zeros
    chunk 1: ...
    chunk index     Arrow IPC stream: offset, n_ids, crc32, plane_bytes
    document index  Arrow IPC stream: doc_id, n_ids, in file order
    footer          JSON: planes, block_ids, n_ids, where the two indexes lie
    length of the footer (u32), b"HGTP1\\n"

Defined results: a null text is an empty one (it has its end id only); a null id
sorts first and stays null; rows with equal ids are kept, ordered by their text; an
empty table gives an empty manifest and no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourglass.llm.shared_files import committed_output, open_input, qualified, ship_package
from hourglass.llm.word_codes import REMEMBERED_WORDS, WHITE_SPACE, rounds, split_words

MAGIC = b"HGTP1\n"
BLOCK_IDS = 1 << 18
MANIFEST_SCHEMA = ("shard int, file string, n_docs long, n_ids long, n_bytes long, "
                   "first_doc_id long, last_doc_id long")

_ENCODERS: dict[str, ByteBpe] = {}


class ByteBpe:
    """Byte-level BPE of a tokenizers file, by distinct words.

    The pre-tokenizer never joins a character that is not white space with white
    space after it, so a text may be cut there. Texts where every white-space
    character stands alone between two others are cut at spaces and line ends by
    Arrow; the rest go to the library whole, as do all texts of a tokenizer of
    another form. Distinct words are encoded many to a string: each begins with
    its space or line end, and no other token of a word does, so the ids that
    begin with one say where words begin.
    """

    IRREGULAR = f"[{WHITE_SPACE}][{WHITE_SPACE}]|^[{WHITE_SPACE}]|[{WHITE_SPACE}]$"
    WORDS_A_STRING = 100

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        cut = json.loads(self._library.pre_tokenizer.__getstate__()) if self._library.pre_tokenizer else {}
        added = self._library.get_added_tokens_decoder().values()
        self.by_words = (self._library.normalizer is None and cut.get("type") == "ByteLevel"
                         and not cut.get("add_prefix_space") and cut.get("use_regex", True)
                         and not any(t.lstrip or t.rstrip or t.single_word or t.content.split() != [t.content]
                                     for t in added))
        vocabulary = self._library.get_vocab(with_added_tokens=False)
        self._leads = np.zeros(max(vocabulary.values()) + 1 + 1000, bool)
        self._leads[[i for t, i in vocabulary.items() if t[0] in "\u0120\u010a"]] = True
        self._newline = self._ids(["\n"])[0]
        self._words = pa.array([], pa.string())           # known words, their ids, where each word's begin
        self._codes, self._at = np.empty(0, "<u4"), np.zeros(1, np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self._library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words in a row, and the number of each word's."""
        cuts = np.append(np.arange(0, len(words), self.WORDS_A_STRING), len(words)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words), " ")
        joined = pc.replace_substring(pc.binary_join_element_wise(pa.scalar(""), joined, " "), " \n", "\n")
        ids = self._ids(joined.to_pylist())
        flat = np.concatenate(ids) if ids else np.empty(0, "<u4")
        begins = np.flatnonzero(self._leads[np.minimum(flat, len(self._leads) - 1)])
        if len(begins) == len(words):
            return flat, np.diff(begins, append=len(flat))
        ids = self._ids([w if w[:1] == "\n" else " " + w for w in words.to_pylist()])
        return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)

    def _flat(self, words: pa.Array, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``words`` in a row, and the texts' id offsets."""
        coded = words.dictionary_encode()
        distinct, index = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        place = pc.fill_null(pc.index_in(distinct, self._words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(place < 0)
        codes, at = self._codes, self._at
        if len(new):
            fresh = distinct.take(pa.array(new))
            flat, lengths = self._encode_words(fresh)
            place[new] = len(self._words) + np.arange(len(new))
            codes = np.concatenate((codes, flat))
            at = np.concatenate((at, at[-1] + np.cumsum(lengths)))
            if len(self._words) + len(new) <= REMEMBERED_WORDS:
                self._words = pa.concat_arrays([self._words, fresh])
                self._codes, self._at = codes, at
        index = place[index]
        per_word = (at[1:] - at[:-1])[index]
        ends = np.concatenate(([0], np.cumsum(per_word)))
        return codes[np.repeat(at[:-1][index] - ends[:-1], per_word) + np.arange(ends[-1])], ends[offsets]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, as the library's ``encode`` gives them."""
        texts = pc.fill_null(texts, "")
        for a, b in rounds(texts):
            part = texts.slice(a, b - a)
            odd = (pc.match_substring_regex(part, self.IRREGULAR).to_numpy(zero_copy_only=False)
                   if self.by_words else np.ones(len(part), bool))
            # A line end leads its word: the first word gets one too, whose id goes again.
            plain = pc.binary_join_element_wise(pa.scalar("\n"), part, "")
            plain = pc.replace_substring(plain, "\n", " \n")
            plain = pc.utf8_slice_codeunits(plain, 1)
            plain = pc.if_else(pa.array(odd), "\n", plain)
            flat, at = self._flat(*split_words(plain))
            for i in range(b - a):
                if odd[i]:
                    yield self._ids([part[i].as_py()])[0]
                else:
                    yield flat[at[i] + len(self._newline):at[i + 1]]


def byte_bpe(path: str) -> ByteBpe:
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBpe(path)
    return _ENCODERS[path]


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """Little-endian planes of 32-bit ids: 32 of bits (8 ids to a byte) or 4 of bytes."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    out = []
    for k in range(4):
        column = np.ascontiguousarray(raw[:, k])
        out += [np.packbits((column >> j) & 1, bitorder="little").tobytes() for j in range(8)]
    return out


def from_planes(planes_of: list[bytes], n: int, planes: str) -> np.ndarray:
    """The ids of planes; an empty plane is all zeros."""
    raw = np.zeros((n, 4), np.uint8)
    for k, plane in enumerate(planes_of):
        if not plane:
            continue
        values = np.frombuffer(plane, np.uint8)
        if planes == "byte":
            raw[:, k] = values
        else:
            raw[:, k >> 3] |= np.unpackbits(values, count=n, bitorder="little") << (k & 7)
    return raw.view("<u4").ravel()


def _table_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


class PlaneWriter:
    """One file; ids come document by document, a block is held at a time."""

    def __init__(self, out, planes: str, block_ids: int, level: int):
        self._out, self._planes, self._block = out, planes, block_ids
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._held: list[np.ndarray] = []
        self._n_held = 0
        self.n_ids = 0
        self._chunks: list[tuple] = []
        self._docs: list[tuple] = []
        self._at = len(MAGIC)
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._docs.append((doc_id, len(ids)))
        self._held.append(ids)
        self._n_held += len(ids)
        self.n_ids += len(ids)
        if self._n_held >= self._block:
            ids = np.concatenate(self._held)
            whole = len(ids) // self._block * self._block
            for k in range(0, whole, self._block):
                self._chunk(ids[k:k + self._block])
            self._held, self._n_held = [ids[whole:]], len(ids) - whole

    def _chunk(self, ids: np.ndarray) -> None:
        frames = [self._zstd.compress(p) if p.strip(b"\0") else b""
                  for p in to_planes(ids, self._planes)]
        self._out.write(b"".join(frames))
        crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
        self._chunks.append((self._at, len(ids), crc, [len(f) for f in frames]))
        self._at += sum(map(len, frames))

    def close(self) -> int:
        if self._n_held:
            self._chunk(np.concatenate(self._held))
        at, n, crc, sizes = zip(*self._chunks, strict=True) if self._chunks else ((), (), (), ())
        index = _table_bytes(pa.table({
            "offset": pa.array(at, pa.int64()), "n_ids": pa.array(n, pa.int32()),
            "crc32": pa.array(crc, pa.uint32()),
            "plane_bytes": pa.array(sizes, pa.list_(pa.int32()))}))
        ids, n = zip(*self._docs, strict=True) if self._docs else ((), ())
        docs = _table_bytes(pa.table({"doc_id": pa.array(ids, pa.int64()),
                                      "n_ids": pa.array(n, pa.int64())}))
        footer = json.dumps({"planes": self._planes, "block_ids": self._block,
                             "n_ids": self.n_ids, "index": [self._at, len(index)],
                             "docs": [self._at + len(index), len(docs)]}).encode()
        end = index + docs + footer + struct.pack("<I", len(footer)) + MAGIC
        self._out.write(end)
        return self._at + len(end)


def read_file(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of a file in its order, a block in memory at a time."""
    with open_input(path) as f:
        size = f.size()
        tail = f.read_at(4 + len(MAGIC), size - 4 - len(MAGIC))
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} is not a whole token file")
        n = struct.unpack("<I", tail[:4])[0]
        footer = json.loads(f.read_at(n, size - 4 - len(MAGIC) - n))
        load = lambda k: pa.ipc.open_stream(f.read_at(footer[k][1], footer[k][0])).read_all()
        zstd = zstandard.ZstdDecompressor()
        chunks = iter(load("index").to_pylist())
        rest = np.empty(0, "<u4")
        docs = load("docs")
        for doc_id, want in zip(docs["doc_id"].to_pylist(), docs["n_ids"].to_pylist(), strict=True):
            parts, have = [rest], len(rest)
            while have < want:
                c = next(chunks)
                raw, frames, at = f.read_at(sum(c["plane_bytes"]), c["offset"]), [], 0
                for k in c["plane_bytes"]:
                    frames.append(zstd.decompress(raw[at:at + k]) if k else b"")
                    at += k
                ids = from_planes(frames, c["n_ids"], footer["planes"])
                if zlib.crc32(ids.tobytes()) != c["crc32"]:
                    raise ValueError(f"{path}: chunk at {c['offset']} is damaged")
                parts.append(ids)
                have += len(ids)
            ids = np.concatenate(parts) if len(parts) > 1 else rest
            rest = ids[want:]
            yield doc_id, ids[:want]


def write_token_ids(docs: DataFrame, out_dir: str, tokenizer: str, end_id: int = 2,
                    planes: str = "bit", block_ids: int = BLOCK_IDS, level: int = 3) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files under ``out_dir``, in ascending
    doc_id order over files and inside them; returns the manifest (one row a file),
    which is also written there as Parquet."""
    spark = docs.sparkSession
    ship_package(spark)
    out_dir = qualified(spark, out_dir)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard = task.partitionId()
        encoder, end = byte_bpe(tokenizer), np.array([end_id], "<u4")
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        name, n_docs, ids = f"tokens-{shard:06d}.hgtp", 0, []
        with committed_output(f"{out_dir}/{name}", str(task.taskAttemptId())) as out:
            writer = PlaneWriter(out, planes, block_ids, level)
            while first is not None:
                keys = first.column("doc_id").to_pylist()
                ids = [ids[0] if ids else keys[0], keys[-1]]
                for doc_id, found in zip(keys, encoder.encode(first.column("text")), strict=True):
                    writer.add(doc_id, np.concatenate((found, end)))
                n_docs += len(keys)
                first = next(batches, None)
            n_bytes = writer.close()
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "file": [name], "n_docs": [n_docs],
            "n_ids": [writer.n_ids], "n_bytes": [n_bytes],
            "first_doc_id": pa.array([ids[0]], pa.int64()),
            "last_doc_id": pa.array([ids[1]], pa.int64())})

    # The text's hash only splits rows of one id; the sort settles their order.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(n, "doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    ordered.mapInArrow(write, MANIFEST_SCHEMA).write.mode("overwrite") \
        .parquet(f"{out_dir}/manifest.parquet")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{out_dir}/manifest.parquet")


def read_token_ids(spark: SparkSession, out_dir: str) -> DataFrame:
    """(doc_id, start, ids) of the files under ``out_dir``: ids as little-endian
    unsigned 32-bit integers, start = ids of all documents before."""
    ship_package(spark)
    out_dir = qualified(spark, out_dir)
    manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{out_dir}/manifest.parquet")
    # One row a file, so the running total is small however many ids there are.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("shard", "file",
                            F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(),
                                   batch.column("start").to_pylist(), strict=True):
                rows, held = [], 0
                for doc_id, ids in read_file(f"{out_dir}/{name}"):
                    rows.append((doc_id, start, ids.tobytes()))
                    start += len(ids)
                    held += ids.nbytes
                    if held > 8 << 20:
                        yield _rows(rows)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (files.repartitionByRange(n, "shard")
            .mapInArrow(read, "doc_id long, start long, ids binary"))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    ids, starts, tokens = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()),
                                       "start": pa.array(starts, pa.int64()),
                                       "ids": pa.array(tokens, pa.binary())})
