"""Byte network: pooling against plain loops, gradients against differences, held-out accuracy."""

import dataclasses
import zlib

import numpy as np
import pytest

from hourglass.llm import quality_cnn as C, queries


def brute_score(net, text):
    n = C.n_chunks(len(text))
    features = np.zeros(2 * C.FILTERS)
    if n:
        padded = text + bytes(C.CHUNK + C.WIDTH)
        pooled = []
        for i in range(n):
            places = range(i * C.HOP, min(i * C.HOP + C.CHUNK, len(text)), C.STRIDE)
            maps = [net.embed[list(padded[p:p + C.WIDTH])].ravel() @ net.filters + net.bias for p in places]
            pooled.append(np.maximum(np.max(maps, 0), 0))
        features = np.concatenate((np.mean(pooled, 0), np.max(pooled, 0)))
    return 1 / (1 + np.exp(-(features @ net.mix + net.offset[0])))


@pytest.mark.parametrize("round_bytes", [C.ROUND, 512])
def test_score_is_the_plain_network(monkeypatch, round_bytes):
    monkeypatch.setattr(C, "ROUND", round_bytes)
    net, own = C.Network.start(3), np.random.default_rng(1)
    net.mix[:] = own.normal(0, 1, len(net.mix))
    net.bias[:] = own.normal(0, 1, C.FILTERS)
    texts = [own.integers(0, 256, n, np.uint8).tobytes() for n in (0, 1, 7, 128, 129, 255, 256, 257, 300, 0, 511, 512, 513, 1025, 4000)]
    assert np.allclose(net.score(texts), [brute_score(net, t) for t in texts], atol=1e-4)
    assert np.allclose(net.score(texts[::-1])[::-1], net.score(texts), atol=1e-5)


def test_gradients(monkeypatch):
    own = np.random.default_rng(2)
    net = C.Network(*(p.astype(np.float64) for p in dataclasses.astuple(C.Network.start(1))))
    net.mix[:] = own.normal(0, 1, len(net.mix))
    texts = [own.integers(97, 123, n, np.uint8).tobytes() for n in (40, 700, 3)]
    samples, y = [C.chunks_of(t) for t in texts], np.array([1.0, 0.0, 1.0])
    monkeypatch.setattr(C, "TRAIN_CHUNKS", 3)       # chunks of one text in several rounds

    def loss():
        p = np.array([brute_score(net, t) for t in texts])
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for part, g in zip((net.embed, net.filters, net.bias, net.mix, net.offset), C._gradients(net, samples, y), strict=True):
        for k in np.argsort(-np.abs(g.ravel()))[:4]:
            old = part.flat[k]
            part.flat[k] = old + 1e-5
            up = loss()
            part.flat[k] = old - 1e-5
            down = loss()
            part.flat[k] = old
            assert abs((up - down) / 2e-5 - g.flat[k]) < 1e-4 + 1e-2 * abs(g.flat[k])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op6_quality_cnn"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in rows)
    apart = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in apart) >= 0.93 * len(apart)
    clean = [r for r in apart if r.quality == 1]
    assert sum(r.predicted for r in clean) >= 0.95 * len(clean)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.5, 9), (None, "", 0.1, 9), (2, "word " * 90000, 0.2, None), (2, "é", None, 1)],
                                 "doc_id long, text string, score double, chunks int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    net = C.fit(docs, none)
    got = C.score(docs, net)
    assert got.columns == ["doc_id", "text", "chunks", "score"]
    assert [round(r.score, 6) for r in got.collect()] == [0.5] * 4
    one = C.fit(docs, spark.createDataFrame([(1, 1), (None, 0), (3, 7), (2, None)], "doc_id long, quality int"))
    assert all(0 <= r.score <= 1 for r in C.score(docs, one).collect())
    assert C.score(docs.limit(0), net).count() == 0


def test_junk_between_clean_ends_of_long_texts_is_learned():
    """Labels that only the middle of long texts tells: every chunk is learned from."""
    own = np.random.default_rng(5)
    words = ["house", "river", "people", "market", "winter", "letter", "garden", "street"]
    clean = lambda n: " ".join(own.choice(words, n)).encode()
    junk = lambda n: " ".join("".join(own.choice(list("#$%&*!"), 6)) for _ in range(n)).encode()
    texts = [clean(200) + (junk(60) if k % 2 else clean(60)) + clean(400) for k in range(60)]
    labels = [1 - k % 2 for k in range(60)]
    net = C.train([C.chunks_of(t) for t in texts[:40]], labels[:40])
    assert ((net.score(texts[40:]) >= C.THRESHOLD) == np.array(labels[40:], bool)).mean() >= 0.95


def test_a_column_named_score_stays(spark):
    docs = spark.createDataFrame([(1, "some text", 7.5, None), (2, None, None, 3)], "doc_id long, text string, score double, row int")
    net = C.Network.start()
    net.offset[:] = 5
    assert sorted(C.keep_good(docs, net).collect()) == sorted(docs.collect())
    assert C.keep_good(docs, net).columns == docs.columns
