"""SimHash: fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from hourglass.llm import queries, simhash as S
from hourglass.llm.components import components
from hourglass.session import work_dir


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """{row: smallest id reachable} for (doc_id, fingerprint) rows."""
    name = list(range(len(rows)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                name[root(i)] = root(j)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[root(i)] = min(ids.get(root(i), r[0]), r[0])
    return [(r[0], f"{r[1]:016x}", ids.get(root(i))) for i, r in enumerate(rows)]


def near_prints(n, seed=1):
    own = random.Random(seed)
    out = [0, 0, (1 << 64) - 1, 1 << 63]
    for _ in range(n):
        x = own.choice(out) if own.random() < 0.7 else own.getrandbits(64)
        for b in own.sample(range(64), own.randint(0, 6)):
            x ^= 1 << b
        out.append(x)
    return out


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_pairs(radius):
    prints = np.array(near_prints(400), "<u8")
    q, b = S.within(prints[:130], S.bit_planes(prints), len(prints), radius)
    want = {(i, j) for i in range(130) for j in range(len(prints)) if int(prints[i] ^ prints[j]).bit_count() <= radius}
    assert set(zip(q.tolist(), b.tolist(), strict=True)) == want


@pytest.mark.parametrize("n", [10, 1 << 25, 1 << 40])
def test_near_pairs_agree_on_a_choice(n):
    own = random.Random(2)
    for _ in range(300):
        x = own.getrandbits(64)
        y = x
        for b in own.sample(range(64), 4):
            y ^= 1 << b
        assert any(all(x >> f & ((1 << k) - 1) == y >> f & ((1 << k) - 1) for f, k in c) for c in S.block_choices(n, 4))


@pytest.mark.parametrize("tile", [2048, 7])
def test_links_give_all_components(spark, tile):
    prints = sorted(set(near_prints(500, 4)))
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fingerprint long")
    folder = work_dir(spark, "simhash")
    found = components(S.links(df, 4, folder, tile), folder + "/c").collect()
    got = {}
    for r in found:
        got.setdefault(r.component, set()).add(r.node & (2**64 - 1))
    want = {}
    for d, _, c in brute_components(list(enumerate(prints))):
        want.setdefault(c, set()).add(prints[d])
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def test_components_of_a_long_chain(spark):
    n = 300
    order = random.Random(1).sample(range(n), n)
    df = spark.createDataFrame(list(zip(order, order[1:], strict=False)) + [(1000, 1001), (1001, 1000)], "a long, b long")
    got = {r.node: r.component for r in components(df, work_dir(spark, "chain")).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}
    assert components(df.limit(0), work_dir(spark, "none")).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, brute_print(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES["op5_simhash"](spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows))


def test_edges(spark):
    long = " ".join(f"w{i % 977}" for i in range(60000))
    texts = [(5, None), (3, ""), (None, " \t"), (7, "One two\x0bTHREE"), (8, "one Two three"), (8, "other words are here now"), (9, long),
             (2, long), (None, "alone with no id at all"), (1, "É é A a\x85b"), (4, "É é a A\x85b")]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in texts], "doc_id long, text string, n int, fingerprint string")
    got = S.near_duplicates(docs, work_dir(spark, "simhash")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_components([(i, brute_print(t)) for i, t in texts]), key=str)
    assert S.near_duplicates(docs.limit(0), work_dir(spark, "simhash")).count() == 0
