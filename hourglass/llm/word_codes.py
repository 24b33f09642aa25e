"""Tokenizing through distinct words.

Both tokenizers here cut a text at white space before merging, so the ids of a
text are the ids of its white-space-led words in a row. A batch of texts is
split and dictionary-encoded by Arrow, each distinct word is encoded by the
tokenizer library once per batch (or taken from a bounded memory of words seen
before), and numpy lays the words' ids out again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a worker remembers between batches; beyond that, only for the batch.
REMEMBERED_WORDS = 600_000
#: Text bytes of one round of splitting, so that memory does not follow batch sizes.
ROUND_BYTES = 12 << 20

# Code points with the Unicode property White_Space.
WHITE_SPACE = r"\x{09}-\x{0D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


class WordCodes:
    """``encode_words(words)`` gives, for each word, one bytes object per field
    (ids, and whatever else is kept per token), all little-endian uint32."""

    def __init__(self, encode_words: Callable[[list[str]], list[tuple[bytes, ...]]], fields: int):
        self._encode = encode_words
        self._fields = fields
        self._known: dict[str, tuple[bytes, ...]] = {}

    def __call__(self, words: pa.Array, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """``words`` in a row with the texts' word offsets -> one flat array per
        field and the texts' token offsets."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        index = coded.indices.to_numpy(zero_copy_only=False)
        known = self._known
        codes = [known.get(w) for w in distinct]
        new = [i for i, c in enumerate(codes) if c is None]
        if new:
            fresh = [distinct[i] for i in new]
            for i, w, c in zip(new, fresh, self._encode(fresh), strict=True):
                codes[i] = c
                if len(known) < REMEMBERED_WORDS:
                    known[w] = c
        lengths = np.fromiter((len(c[0]) >> 2 for c in codes), np.int64, len(codes))
        starts = np.concatenate(([0], np.cumsum(lengths)))
        per_word = lengths[index]
        ends = np.concatenate(([0], np.cumsum(per_word)))
        at = np.repeat(starts[:-1][index] - ends[:-1], per_word) + np.arange(ends[-1])
        flat = [np.frombuffer(b"".join([c[f] for c in codes]), "<u4")[at] if len(at)
                else np.empty(0, "<u4") for f in range(self._fields)]
        return flat, ends[offsets]


def rounds(texts: pa.Array, most: int = ROUND_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text; one row may be longer."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield at, i
            at, total = i, 0
        total += int(n)
    if at < len(sizes):
        yield at, len(sizes)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of texts whose line ends were led by a space: flat words, offsets."""
    lists = pc.split_pattern(texts, " ")
    off = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten(), off - off[0]
