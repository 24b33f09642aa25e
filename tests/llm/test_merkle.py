"""Merkle manifests against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from hourglass.llm import merkle as K
from hourglass.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, n=None):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"] if n is None else n, r["text"]]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(digests):
    """The top and, per leaf, its siblings level by level as (digest or None, is the leaf second)."""
    proofs, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, p in enumerate(proofs):
            k = at[i] ^ 1
            p.append((digests[k] if k < len(digests) else None, at[i] & 1))
            at[i] >>= 1
        digests = [h(*digests[k:k + 2]) for k in range(0, len(digests), 2)]
    return digests[0], proofs


def folded(d, proof):
    for s, second in proof:
        d = h(d) if s is None else h(s, d) if second else h(d, s)
    return d


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = tree([x[2] for x in groups[g]])
    root, tops = tree([trees[g][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for (_, _, d, r), proof in zip(groups[g], trees[g][1]):
            whole = proof + tops[k]
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None
            again = folded(leaf(r, r["n_chars"] + 1) if hit else d, whole)
            out.append((r["doc_id"], d, trees[g][0], root, h(*[s for s, _ in whole if s]), again, again == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(spark, sf_dir, rows):
    got = [tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_merkle"](spark, sf_dir).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows)))
    return got


def write(spark, workdir, rows):
    spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(5).write.parquet(f"{workdir}/documents.parquet")


@pytest.mark.parametrize("sizes", [[1], [2], [3], [33, 1], [70, 32, 5, 0, 1]])
def test_sizes(spark, workdir, sizes):
    rows = [dict(doc_id=k * 7 + i * 1000, text=f"t{k} é", lang=f"l{i}", source="s", n_chars=k)
            for i, n in enumerate(sizes) for k in range(n)]
    write(spark, workdir, rows)
    got = check(spark, workdir, rows)
    assert {r[6] for r in got if zlib.crc32(str(r[0]).encode()) % 7} <= {True}
    assert {r[6] for r in got if zlib.crc32(str(r[0]).encode()) % 7 == 0} <= {False}


def test_nulls_ties_repeats_long_and_clashing(spark, workdir):
    rows = [dict(doc_id=k if k % 5 else None, text=None if k % 3 else "x" * 40_000, lang=[None, "", "é", "z", "A"][k % 5],
                 source=None if k % 4 else "", n_chars=None if k % 2 else k) for k in range(40)]
    rows += rows[:7] + [dict(r, text="other") for r in rows[:9]]
    write(spark, workdir, rows)
    check(spark, workdir, rows)
    # columns named like those the operator uses change nothing
    docs = spark.read.parquet(f"{workdir}/documents.parquet")
    clash = docs.withColumns({c: F.lit(9) for c in ("g", "i", "n", "key", "leaf", "siblings", "carried")})
    run = lambda d: sorted(K.prove(d, F.col("doc_id"), F.col("lang"), K.leaf_digest(F.col("doc_id"), F.col("text")))
                           .select("leaf", "root").collect(), key=str)
    assert run(clash) == run(docs)


def test_empty_table(spark, workdir):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{workdir}/documents.parquet")
    assert QUERIES["op12_merkle"](spark, workdir).collect() == []


def test_long_joins_and_test_table(spark, monkeypatch):
    """The rounds' joins by shuffle, over the test table; any flipped leaf is found."""
    monkeypatch.setattr(K, "BROADCAST_BYTES", 0)
    sf = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = check(spark, sf, rows)
    assert len(got) == len(rows) and any(not r[6] for r in got)
