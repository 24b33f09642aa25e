"""Quality classifier: a byte-level convolutional network in numpy.

The bytes of a whole text are embedded and convolved with learned filters. Overlapping
chunks (``CHUNK`` bytes, one every ``HOP``) cover the text; each filter is max-pooled inside
each chunk. The pooled values of all chunks are combined by their mean and their maximum
over the text, and a logistic unit gives one probability.

Training takes a bounded sample of labelled texts (``SAMPLE_DOCUMENTS`` rows), and of each
every chunk, as scoring does.
Ids, languages, sources and labels are never inputs of a score.

Defined results: a null or empty text has no chunks and scores by the bias alone; null ids
and repeated rows are kept; an empty table gives no rows; without labelled rows, or with
labels of one kind only, the network keeps its starting filters and scores the labelled share of
quality 1 (one half without labels); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from hourglass.llm.shared_files import ship_package

EMBED, WIDTH, STRIDE, FILTERS = 4, 8, 2, 16
CHUNK, HOP = 256, 128
SAMPLE_DOCUMENTS = 3000
EPOCHS, BATCH, RATE, DECAY = 14, 48, 0.008, 1e-4
#: A small sample is gone through more often.
LEAST_STEPS = 600
SHORT_SHARE = 0.25
THRESHOLD = 0.7
#: Chunks of training texts convolved at once.
TRAIN_CHUNKS = 4096
#: Bytes convolved at once.
ROUND = 1 << 17


@dataclass
class Network:
    embed: np.ndarray      # (256, EMBED)
    filters: np.ndarray    # (WIDTH * EMBED, FILTERS)
    bias: np.ndarray       # (FILTERS,)
    mix: np.ndarray        # (2 * FILTERS,)
    offset: np.ndarray     # (1,)

    @classmethod
    def start(cls, seed: int = 0) -> Network:
        own = np.random.default_rng(seed)
        embed = own.normal(0, 1, (256, EMBED))
        filters = own.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS))
        parts = embed, filters, np.zeros(FILTERS), own.normal(0, 0.01, 2 * FILTERS), np.zeros(1)
        return cls(*(p.astype(np.float32) for p in parts))

    def windows(self, codes: np.ndarray) -> np.ndarray:
        """(places, WIDTH * EMBED): the embedded bytes under a filter at every STRIDE-th byte."""
        flat = self.embed.take(codes, 0).ravel()
        step = flat.strides[0]
        return np.lib.stride_tricks.as_strided(
            flat, ((len(codes) - WIDTH) // STRIDE + 1, WIDTH * EMBED), (STRIDE * EMBED * step, step), writeable=False)

    def convolve(self, codes: np.ndarray) -> np.ndarray:
        """The filters' values without their bias, which can wait until after the maximum."""
        return np.ascontiguousarray(self.windows(codes)) @ self.filters

    def score(self, texts: list[bytes]) -> np.ndarray:
        """The probability of quality 1 of each whole text."""
        features = np.zeros((len(texts), 2 * FILTERS), np.float32)
        counts = np.array([n_chunks(len(t)) for t in texts])
        full = np.flatnonzero(counts)
        if len(full):
            pooled = self._pooled([texts[i] for i in full])
            at = np.concatenate(([0], np.cumsum(counts[full])))
            features[full, :FILTERS] = np.add.reduceat(pooled, at[:-1], 0) / counts[full][:, None]
            features[full, FILTERS:] = np.maximum.reduceat(pooled, at[:-1], 0)
        z = features @ self.mix + self.offset
        return 1 / (1 + np.exp(-np.clip(z.astype(float), -30, 30)))

    def _pooled(self, texts: list[bytes]) -> np.ndarray:
        """Rectified chunk maxima of each filter, text after text; no text is empty.

        A hop's maximum is taken once; a chunk's is that of its hops.
        """
        hops, owner, codes, starts, kept, held = [], [], [], [], [], 0

        def run() -> None:
            maps = self.convolve(np.frombuffer(b"".join([*codes, b"\0" * WIDTH]), np.uint8))
            hops.append(np.maximum.reduceat(maps, np.array(starts), 0)[np.array(kept)])
            for x in (codes, starts, kept):
                x.clear()

        for k, text in enumerate(texts):
            for at in range(0, len(text), ROUND):
                size = min(ROUND, len(text) - at)
                places = -(-size // STRIDE)
                piece = text[at:at + size + WIDTH]
                codes.append(piece + b"\0" * (places * STRIDE + WIDTH - len(piece)))
                own = list(range(held, held + places, HOP // STRIDE))
                starts += [*own, held + places]   # then the places that reach into the next piece
                kept += [True] * len(own) + [False]
                owner += [k] * len(own)
                held += places + WIDTH // STRIDE
                if held >= ROUND // STRIDE:
                    run()
                    held = 0
        if codes:
            run()
        maxima, of = np.maximum(np.concatenate(hops) + self.bias, 0), np.array(owner)
        # Chunk i of a text covers hops i and i + 1; a text of one hop has one chunk.
        joined = np.maximum(maxima[:-1], maxima[1:])
        same = of[:-1] == of[1:]
        single = np.flatnonzero(np.bincount(of, minlength=len(texts)) == 1)
        rows = np.concatenate((np.flatnonzero(same), np.searchsorted(of, single)))
        values = np.concatenate((joined[same], maxima[np.searchsorted(of, single)]))
        return values[np.argsort(rows, kind="stable")]


def n_chunks(size: int) -> int:
    return 0 if size == 0 else max(1, -(-size // HOP) - 1)


def chunks_of(text: bytes) -> list[bytes]:
    """All chunks of a text, each with the bytes that its last places reach into."""
    return [text[i * HOP:i * HOP + CHUNK + WIDTH] for i in range(n_chunks(len(text)))]


def train(samples: list[list[bytes]], labels: list[int], seed: int = 0, epochs: int = EPOCHS) -> Network:
    """Fit a network to texts given as lists of chunks, by Adam on the logistic loss."""
    net, own = Network.start(seed), np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    share = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or share in (0.0, 1.0):
        net.mix[:] = 0
        net.offset[:] = np.log((share + 1e-3) / (1 - share + 1e-3))
        return net
    parts = [net.embed, net.filters, net.bias, net.mix, net.offset]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    usable, step = [i for i, s in enumerate(samples) if s], 0
    rounds = -(-len(usable) // BATCH)
    for _ in range(max(epochs, -(-LEAST_STEPS // max(rounds, 1))) if usable else 0):
        order = own.permutation(usable)
        for at in range(0, len(order), BATCH):
            picked = order[at:at + BATCH]
            gradients = _gradients(net, [_shortened(samples[i], own) for i in picked], y[picked])
            step += 1
            for p, g, m, v in zip(parts, gradients, first, second, strict=True):
                g = g + DECAY * p
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                p -= (RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def _shortened(chunks: list[bytes], own: np.random.Generator) -> list[bytes]:
    """Now and then a piece of one chunk in place of the text, so that short texts are learned too."""
    if own.random() >= SHORT_SHARE:
        return chunks
    chunk = chunks[own.integers(len(chunks))]
    return [chunk[:int(own.integers(12, 160))]]


def _peaks(net: Network, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's greatest value in each chunk, and the bytes it was found over."""
    sizes = np.array([-(-min(len(c), CHUNK) // STRIDE) for c in chunks])    # places
    flat = np.frombuffer(b"".join(c + b"\0" * (n * STRIDE + WIDTH - len(c)) for c, n in zip(chunks, sizes, strict=True)), np.uint8)
    begin = np.concatenate(([0], np.cumsum(sizes + WIDTH // STRIDE)))[:-1]
    maps = net.convolve(flat) + net.bias
    place = np.stack([maps[b:b + k].argmax(0) + b for b, k in zip(begin, sizes, strict=True)])
    return np.take_along_axis(maps, place, 0), flat[STRIDE * place[:, :, None] + np.arange(WIDTH)]


def _gradients(net: Network, samples: list[list[bytes]], y: np.ndarray) -> list[np.ndarray]:
    """Over all chunks of the texts, ``TRAIN_CHUNKS`` at a time."""
    chunks = [c for s in samples for c in s]
    found = [_peaks(net, chunks[k:k + TRAIN_CHUNKS]) for k in range(0, len(chunks), TRAIN_CHUNKS)]
    peak = np.concatenate([p for p, _ in found])
    pooled = np.maximum(peak, 0)
    counts = np.array([len(s) for s in samples])
    at = np.concatenate(([0], np.cumsum(counts)))
    mean = np.add.reduceat(pooled, at[:-1], 0) / counts[:, None]
    top = np.maximum.reduceat(pooled, at[:-1], 0)
    features = np.concatenate((mean, top), 1)
    p = 1 / (1 + np.exp(-np.clip(features @ net.mix + net.offset, -30, 30)))
    dz = ((p - y) / len(y)).astype(np.float32)
    d_features = dz[:, None] * net.mix
    of = np.repeat(np.arange(len(samples)), counts)
    is_top = pooled == top[of]
    d_peak = ((d_features[of, :FILTERS] / counts[of][:, None]) + d_features[of, FILTERS:] * is_top) * (peak > 0)
    # Only the place of each chunk's maximum passes a gradient on.
    d_filters, d_embed, done = np.zeros_like(net.filters), np.zeros_like(net.embed), 0
    for _, codes in found:
        own = d_peak[done:done + len(codes)]
        done += len(codes)
        for f in range(FILTERS):
            used = np.flatnonzero(own[:, f])
            read, weight = codes[used, f], own[used, f:f + 1]
            d_filters[:, f] += (net.embed[read].reshape(len(used), WIDTH * EMBED) * weight).sum(0)
            d_read = (weight * net.filters[:, f]).reshape(-1, EMBED)
            for e in range(EMBED):
                d_embed[:, e] += np.bincount(read.ravel(), d_read[:, e], 256)
    return [d_embed, d_filters, d_peak.sum(0), features.T @ dz, dz.sum(keepdims=True)]


def sampled(docs: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> list[tuple[list[bytes], int]]:
    """(chunks, quality) of at most ``sample_documents`` labelled texts that are not held out.

    Labels are chosen evenly by the hash of their id, the least hashes first; all of a smaller table.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .select("doc_id", "quality")
    every = max(1, -(-known.count() // sample_documents))
    order = [F.xxhash64("doc_id", F.lit(1)), "doc_id", "quality"]
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).orderBy(*order).limit(sample_documents)
    some = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")   # at most that many ids

    rows = some.orderBy(*order, F.xxhash64("text"), "text").limit(2 * sample_documents).collect()
    return [(chunks_of((r.text or "").encode()), r.quality) for r in rows]


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id's text mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> Network:
    samples = sampled(docs, labels, sample_documents)
    return train([s for s, _ in samples], [q for _, q in samples])


def keep_good(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the network does not reject, columns as they are."""
    scored = score(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text"), net)
    return scored.where(F.col("score") >= threshold).select("row.*")


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with one more column, ``score``, which replaces one of that name."""
    ship_package(docs.sparkSession)
    rest = docs.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            scores = np.empty(len(texts))
            for at in range(0, len(texts), 256):
                scores[at:at + 256] = net.score(texts[at:at + 256])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "score"])

    return rest.mapInArrow(run, StructType([*rest.schema.fields, StructField("score", DoubleType())]))
