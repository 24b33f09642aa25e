"""Offset-preserving SentencePiece encoding, and decoding.

A text is normalised by longest-prefix match through the model's compiled
character map (a double-array trie over UTF-8 bytes). Every normalised byte records
the source byte it comes from, so a piece, which covers a run of normalised bytes,
projects to a span of bytes of the original text. Ids come from the sentencepiece
library.

Defined results: a null text is an empty one (begin and end ids only); null ids and
repeated rows are kept; a text of any length is encoded whole; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.shared_files import ship_package
from hourglass.llm.word_codes import WordCodes, rounds, split_words

SPACE = "▁".encode()
REPLACEMENT = "�".encode()


def proto_fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, raw[at:at + size]
        at += size


class CharacterMap:
    """Longest-prefix rules of a compiled map: u32 size of the trie, its 32-bit units,
    then the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self._units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self._texts = blob[4 + size:]
        root = self._base(0) if self._units else 0
        starts = [b for b in range(256)
                  if self._units and root ^ b < len(self._units) and self._labelled(root ^ b, b)]
        #: One byte that no rule starts with and that is not a space.
        self.first_bytes = frozenset(starts)

    def _base(self, node: int) -> int:
        unit = self._units[node]
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _labelled(self, node: int, byte: int) -> bool:
        return self._units[node] & 0x800000FF == byte

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest rule at a place and the bytes it takes."""
        units, found = self._units, None
        if not units:
            return None
        node = self._base(0)
        for end in range(at, len(text)):
            node ^= text[end]
            if node >= len(units) or not self._labelled(node, text[end]):
                break
            leaf = units[node] >> 8 & 1
            node ^= self._base(node)
            if leaf:
                found = (units[node] & 0x7FFFFFFF, end + 1 - at)
        if found is None:
            return None
        k, taken = found
        return self._texts[k:self._texts.index(b"\0", k)], taken


class Normalizer:
    """Normalised bytes of a text and, for each of them, the source byte it is from."""

    def __init__(self, spec: bytes):
        fields = dict(proto_fields(spec))
        self.map = CharacterMap(fields.get(2, b""))
        self.dummy_prefix = bool(fields.get(3, 1))
        self.remove_extra = bool(fields.get(4, 1))
        self.escape = bool(fields.get(5, 1))
        special = bytes(sorted(self.map.first_bytes | {32}))
        self._plain = re.compile(b"[^" + re.escape(special) + b"]+")

    @property
    def identity(self) -> bool:
        """Only spaces change."""
        return not self.map.first_bytes and not self.remove_extra and self.escape

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        if self.identity and text:
            source = np.frombuffer(text, np.uint8)
            align = np.repeat(np.arange(len(text), dtype=np.int64), np.where(source == 32, 3, 1))
            out = text.replace(b" ", SPACE)
            if self.dummy_prefix:
                out, align = SPACE + out, np.concatenate((np.zeros(3, np.int64), align))
            return out, np.append(align, len(text))
        return self._walk(text)

    def _next(self, text: bytes, at: int) -> tuple[bytes, int]:
        if rule := self.map.longest(text, at):
            return rule
        lead = text[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return text[at:at + n], n

    def _walk(self, text: bytes) -> tuple[bytes, np.ndarray]:
        space = SPACE if self.escape else b" "
        at, out, align = 0, bytearray(), []
        if self.remove_extra:
            while at < len(text):
                piece, n = self._next(text, at)
                if piece != b" ":
                    break
                at += n
        if at == len(text):
            return b"", np.array([0], np.int64)   # nothing is left to put a prefix to
        if self.dummy_prefix:
            out += space
            align += [at] * len(space)
        after_space = self.remove_extra
        while at < len(text):
            if run := self._plain.match(text, at):
                # Bytes that start no rule stand for themselves, but the run may end inside
                # a character whose first bytes do not start one either: harmless, as a rule
                # starts at a character and its first byte ends the run.
                out += run[0]
                align += range(at, run.end())
                at, after_space = run.end(), False
                continue
            piece, n = self._next(text, at)
            kept = piece.lstrip(b" ") if after_space else piece
            put = kept.replace(b" ", space)
            out += put
            align += [at] * len(put)
            if piece:
                after_space = self.remove_extra and piece.endswith(b" ")
            at += n
        end = len(text)
        if self.remove_extra:
            while out.endswith(space):
                del out[-len(space):]
                end = align[len(out)]
                del align[len(out):]
        align.append(end)
        return bytes(out), np.array(align, np.int64)


class Codec:
    """Encoding with source offsets, and decoding, by one model file."""

    WHOLE = "[ \\n][ \\n]|^[ \\n]|[ \\n]$|▁"

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = list(proto_fields(self.library.serialized_model_proto()))
        self.normalizer = Normalizer(next(v for k, v in model if k == 3))
        trainer = dict(proto_fields(next((v for k, v in model if k == 2), b"")))
        pieces = [dict(proto_fields(v)) for k, v in model if k == 1]
        texts = [p[1] for p in pieces]
        kinds = [p.get(3, 1) for p in pieces]   # 1 normal, 2 unknown, 3 control, 4 user, 6 byte
        #: Normalised bytes that each id covers.
        self.covers = np.array([0 if k == 3 else 1 if k == 6 else len(t)
                                for t, k in zip(texts, kinds, strict=True)], np.int64)
        self.byte_fallback = 6 in kinds
        self.space = self.library.piece_to_id("▁")
        # Words may be encoded alone if merging never crosses a space or a line end.
        self.by_words = (trainer.get(3) == 2 and self.byte_fallback and self.normalizer.identity
                         and self.normalizer.dummy_prefix and 4 not in kinds
                         and not any(SPACE in t.lstrip(SPACE) or b"\n" in t for t in texts))
        self._words = WordCodes(self._encode_words, 1)

    def _encode_words(self, words: list[str]) -> list[tuple[bytes]]:
        out = []
        for w, ids in zip(words, self.library.encode(words, num_threads=1), strict=True):
            # The dummy prefix stands for the space before a word; a line end has none.
            out.append((np.array(ids[1:] if w[:1] == "\n" else ids, "<u4").tobytes(),))
        return out

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, as the library encodes it whole."""
        texts = pc.fill_null(texts, "")
        for a, b in rounds(texts):
            part = texts.slice(a, b - a)
            if not self.by_words:
                yield from (np.array(x, "<u4") for x in
                            self.library.encode(part.to_pylist(), num_threads=1))
                continue
            whole = pc.or_(pc.match_substring_regex(part, self.WHOLE), pc.equal(part, ""))
            whole = whole.to_numpy(zero_copy_only=False)
            plain = pc.if_else(pa.array(whole), "x", pc.replace_substring(part, "\n", " \n"))
            (flat,), at = self._words(*split_words(plain))
            for i in range(b - a):
                if whole[i]:
                    yield np.array(self.library.encode(part[i].as_py()), "<u4")
                else:
                    yield flat[at[i]:at[i + 1]]

    def starts(self, text: bytes, ids: np.ndarray) -> np.ndarray:
        """The source byte at which each id's span starts; it ends at the next start."""
        normal, align = self.normalizer(text)
        sizes = self.covers[ids]
        if not self.byte_fallback:   # an unknown piece covers what the library put in it
            found = self.library.encode(text.decode(), return_type="proto").pieces
            sizes = np.array([len(p.piece.encode()) for p in found], np.int64)
        at = np.cumsum(sizes) - sizes
        if len(ids) and at[-1] + sizes[-1] != len(normal):
            raise ValueError("the pieces do not cover the normalised text")
        return align[at]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.library.decode([x.tolist() for x in ids], num_threads=1) if ids else []


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_decode(docs: DataFrame, model: str, bos: bool = True, eos: bool = True) -> DataFrame:
    """(doc_id, ids, starts, decoded) of ``docs`` (doc_id, text).

    ids and starts are little-endian unsigned 32-bit integers; starts[k] is the byte of
    the UTF-8 text at which the span of ids[k] starts (it ends at the next one, the last
    at the text's end; begin and end ids have empty spans). ``decoded`` is the library's
    decoding of ids.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        first = [own.library.bos_id()] if bos else []
        last = [own.library.eos_id()] if eos else []
        for batch in batches:
            keys, texts = batch.column("doc_id"), pc.fill_null(batch.column("text"), "")
            for a, b in rounds(texts, 4 << 20):
                part, ids, starts = texts.slice(a, b - a), [], []
                for text, found in zip(part.cast(pa.binary()).to_pylist(), own.ids(part), strict=True):
                    at = own.starts(text, found)
                    ids.append(np.concatenate((first, found, last)).astype("<u4"))
                    starts.append(np.concatenate(([0] * len(first), at, [len(text)] * len(last)))
                                  .astype("<u4").tobytes())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": keys.slice(a, b - a),
                    "ids": pa.array([x.tobytes() for x in ids], pa.binary()),
                    "starts": pa.array(starts, pa.binary()),
                    "decoded": pa.array(own.decode(ids), pa.string())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids binary, starts binary, decoded string")
