"""Decontamination against sliding every window of every document over every item."""

import random
import re
from collections import Counter

import pytest

from hourglass.llm import decontaminate as D, queries


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(w, k):
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]


def brute(docs, items, least=0.8):
    """Pairs with a window of the item's size of the least similarity."""
    out = set()
    for d, t in docs:
        w = words(t)
        for i, q in items:
            qw = words(q)
            if not qw:
                continue
            k = min(5, len(qw))
            own, s = Counter(shingles(qw, k)), shingles(w, k)
            m = sum(own.values())
            for a in range(max(len(s) - m, 0) + 1):
                window = Counter(s[a:a + m])
                common = sum((own & window).values())
                if common and common / (m + sum(window.values()) - common) >= least:
                    out.add((d, i))
                    break
    return out


def best(t, q):
    """The similarity of the document's window that is most like the item."""
    qw, w = words(q), words(t)
    k = min(5, len(qw))
    own, s = Counter(shingles(qw, k)), shingles(w, k)
    m, top = sum(own.values()), 0.0
    for a in range(max(len(s) - m, 0) + 1):
        window = Counter(s[a:a + m])
        common = sum((own & window).values())
        top = max(top, common / (m + sum(window.values()) - common))
    return top


def planted(seed):
    own = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["été", "ß", "日本"]
    text = lambda n: own.choices(vocabulary, k=n)
    items = [(i, text(own.choice([3, 6, 12, 30, 45]))) for i in range(30)]
    docs = []
    for d in range(150):
        body = text(own.randint(0, 80))
        for _ in range(own.randint(0, 2)):
            q = list(own.choice(items)[1])
            for _ in range(own.choice([0, 0, 1, 2])):
                at = own.randrange(len(q))
                kind = own.random()
                q[at:at + 1] = [own.choice(vocabulary)] if kind < 0.4 else [] if kind < 0.6 and len(q) > 1 else [q[at], "inserted"]
            body = body[:len(body) // 2] + q * own.choice([1, 1, 2]) + body[len(body) // 2:]
        docs.append((d, " ".join(own.choice([x, x.upper(), x + "."]) for x in body)))
    return docs, [(i, " ".join(q)) for i, q in items]


@pytest.mark.parametrize("slice_bytes", [D.SLICE_BYTES, 60000])
def test_planted(spark, slice_bytes):
    docs, items = planted(3)
    got = D.find_leaks(spark.createDataFrame([(*r, "z", 1.0) for r in docs], "doc_id long, text string, item_id string, similarity double"),
                       spark.createDataFrame(items, "item_id long, text string"), slice_bytes=slice_bytes).collect()
    want = brute(docs, items)
    found = {(r.doc_id, r.item_id) for r in got}
    assert len(found) == len(got) and found <= want
    assert len(want) > 40 and len(want - found) <= 0.02 * len(want)      # beyond the radius
    assert all(r.similarity >= 0.8 and r.distance <= D.RADIUS for r in got)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = lambda name: list(map(tuple, spark.read.parquet(f"{sf}/{name}.parquet").select(
        "doc_id" if name == "documents" else "item_id", "text").collect()))
    docs, items = rows("documents"), rows("benchmark")
    grams = {g for _, q in items for g in shingles(words(q), 5)}
    near = [(d, t) for d, t in docs if grams & set(shingles(words(t), 5))]
    got = queries.QUERIES["op3_decontaminate"](spark, sf).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(near, items) and got


def test_edges(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (None, item), (None, item), (4, item), (4, item + " x"), (5, "pad " * 40000 + item.upper()),
                                  (6, item[:-4]), (7, "one two three four")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, " ,"), (None, item + " and some other words to fill it")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.start_word) for r in D.find_leaks(docs, bench).collect()), key=str)
    assert got == sorted([(None, 1, 0), (4, 1, 0), (5, 1, 40000), (6, 1, 0)], key=str)
    assert D.find_leaks(docs, bench.limit(0)).count() == 0 and D.find_leaks(docs.limit(0), bench).count() == 0
    left = D.without_leaks(docs, D.find_leaks(docs, bench))
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "2", "3", "7", "None", "None"]


def test_best_window_inside_a_run(spark):
    y = " ".join(f"y{i}" for i in range(10))
    many = lambda w, n: " ".join([w] * n)
    docs = [(1, f"{many('a', 40)} {y} {many('a', 40)}"), (2, f"{many('a', 40)} {y} {many('b', 40)}"), (3, many("a", 500)),
            (4, f"{many('a', 7)} {y} {many('a', 40)}"), (5, f"{many('a', 40)} {y}"), (6, f"x {many('a', 5)} {y} {many('b', 5)}")]
    # The shingles of the second item are distinct, its words are not.
    items = [(1, f"{many('a', 10)} {y} {many('a', 10)}"), (2, f"{many('a', 5)} {y} {many('b', 5)}"), (3, many("a", 20))]
    got = {(r.doc_id, r.item_id): r for r in D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                                          spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == brute(docs, items)
    assert (got[1, 1].similarity, got[1, 1].start_word) == (1.0, 24) and (got[2, 2].similarity, got[2, 2].start_word) == (1.0, 35)
    assert (got[3, 3].similarity, got[3, 3].start_word) == (1.0, 0) and (got[6, 2].similarity, got[6, 2].start_word) == (1.0, 1)


def test_repeated_words(spark):
    own = random.Random(7)
    docs = [(d, " ".join(own.choices("ab", weights=(5, 1), k=own.randint(1, 120)))) for d in range(80)]
    items = [(i, " ".join(own.choices("ab", weights=(5, 1), k=own.randint(5, 25)))) for i in range(25)]
    got = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), radius=63)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute(docs, items)


def test_simhash_is_the_bitwise_majority(spark):
    own = random.Random(2)
    rows = [[own.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (1, 2, 7, 40, 90)] + [[7, 7, 7, 7, 1, 1, 1], []]
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(r,) for r in rows], "a array<bigint>")
    want = [sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in r) > len(r)) for r in rows]
    assert [r.s % (1 << 64) for r in df.select(D.simhash(F.col("a")).alias("s")).collect()] == want


def test_agreeing_block(spark):
    own = random.Random(1)
    rows = []
    for _ in range(200):
        a = own.getrandbits(64)
        b = a
        for k in own.sample(range(64), D.RADIUS):
            b ^= 1 << k
        rows.append((a - (a >> 63 << 64), b - (b >> 63 << 64)))
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "a long, b long")
    same = [x == y for x, y in zip(D.blocks_of(F.col("a"), D.RADIUS), D.blocks_of(F.col("b"), D.RADIUS), strict=True)]
    assert df.where(F.greatest(*(s.cast("int") for s in same)) == 1).count() == 200


def test_candidates_grow_with_windows_not_with_items(spark):
    """Items of one size, each with some windows of its own: no window meets another's item."""
    from pyspark.sql import functions as F
    own = random.Random(4)
    vocabulary = [f"w{k}" for k in range(3000)]
    counts = []
    for n in (40, 400):
        items = [(i, " ".join(own.choices(vocabulary, k=30))) for i in range(n)]
        docs = [(d, " ".join(own.choices(vocabulary, k=20)) + " " + items[d % 40][1] + " " + items[(d * 7) % 40][1]) for d in range(60)]
        frame = D.items_of(spark.createDataFrame(items, "item_id long, text string"), 5)
        cut = D.windows(spark.createDataFrame(docs, "doc_id long, text string"), frame, 5, 0.8)
        pairs = D.candidates(cut, frame, D.RADIUS).select("doc_id", "item_id", "start").distinct().count()
        counts.append((pairs, cut.count()))
    assert counts[0] == counts[1] and counts[1][0] <= counts[1][1] <= 0.05 * 400 * 60


def test_recall_at_the_least_similarity(spark):
    """Windows of similarity 0.80 to 0.85 lie within the radius."""
    own = random.Random(12)
    vocabulary = [f"w{k}" for k in range(5000)]
    items, docs = [], []
    for i in range(300):
        text = own.choices(vocabulary, k=own.randint(60, 120))
        items.append((i, " ".join(text)))
        for k in own.sample(range(5, len(text) - 5), max(1, round(len(text) * 0.02))):
            text[k] = "changed"
        docs.append((i, "before it " + " ".join(text) + " and after"))
    want = {(d, i): x for d, t in docs for i, q in items[d:d + 1] if (x := best(t, q)) >= 0.8}
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                                      spark.createDataFrame(items, "item_id long, text string")).collect()}
    close = {p for p, x in want.items() if x < 0.85}
    assert len(close) > 40 and len(close & got) >= 0.99 * len(close) and len(want.keys() & got) >= 0.99 * len(want)
