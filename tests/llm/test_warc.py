"""WARC: rows against SQL, exact payload round trip, equal bytes on a rerun, edge cases."""

import gzip

import pytest

from hourglass.llm import queries, warc as W
from hourglass.llm.joins import join_measured
from hourglass.session import work_dir

BIG = "<p>ö</p>" * 40
SCHEMA = "page_id long, url string, html string, digest string, payload int"
ROWS = [(5, "http://a/ \r\nx: y%41", BIG, "d", 1), (2, "http://b/é", BIG, "d", 1), (9, None, BIG, None, None), (2, "http://b/é", BIG, "e", 2),
        (3, "http://c/", "short", "d", 1), (4, "http://c/", "short", "d", 1), (6, "u", None, "d", 1), (7, "", "", "d", 1),
        (None, "http://n/", BIG, "d", 1), (8, "http://l/", "\r\n\r\nWARC/1.1\r\n" * 60000, "d", 1)]


def test_query_against_sql(spark, oracle, rows_of):
    sf = "/root/testdata/sf0.01"
    assert rows_of(queries.QUERIES["op10_warc"](spark, sf)) == oracle(queries.ORACLES["op10_warc"], sf)


@pytest.mark.parametrize("most", [1 << 25, 0])
def test_edges(spark, monkeypatch, most):
    monkeypatch.setattr(W, "join_measured", lambda *a: join_measured(*a, most=most))
    out = work_dir(spark, "warc")
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    manifest = W.write_warc(pages, out, roll_bytes=600).collect()
    assert sum(m.n_records for m in manifest) == len(ROWS)
    got = W.read_warc(spark, out).collect()
    assert sorted(((r.page_id, r.url) for r in got), key=str) == sorted(((r[0], r[1]) for r in ROWS), key=str)
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in got if r.payload_digest ==
                    next(x.payload_digest for x in got if x.page_id == 5)), key=str)
    assert kinds == sorted([(2, "response", None), (2, "revisit", 2), (5, "revisit", 2), (9, "revisit", 2), (None, "revisit", 2)], key=str)
    assert all(r.record_type == "response" for r in got if r.page_id in (3, 4, 6, 7, 8))
    texts = {r[0]: (r[2] or "").encode() for r in ROWS}
    for r in got:
        assert r.payload_bytes == len(texts[r.page_id])
        assert r.payload == (None if r.record_type == "revisit" else texts[r.page_id])


def test_same_rows_give_the_same_bytes(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    runs = []
    for k, df in enumerate((pages, pages.repartition(5))):
        out = tmp_path / str(k)
        W.write_warc(df, f"file:{out}", roll_bytes=600)
        files = sorted(out.glob("*.warc.gz"))
        assert len(files) > 2 and not list(out.glob("_temporary*"))
        runs.append(b"".join(p.read_bytes() for p in files))
    assert runs[0] == runs[1]
    assert gzip.decompress(runs[0]).count(b"WARC-Record-ID") == len(ROWS)


def test_same_bytes_beyond_any_sample(spark, tmp_path):
    """More rows a partition than Spark samples for ranges, with null and hot ids; dealt anew each run."""
    from pyspark.sql import functions as F
    n = 40_000
    pages = spark.range(n, numPartitions=4).select(
        F.when(F.col("id") % 97 == 0, None).when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * F.col("id")).alias("page_id"),
        F.lit("u").alias("url"), F.repeat(F.sha2((F.col("id") % 33_000).cast("string"), 256), 3).alias("html"))
    runs = []
    for k, df in enumerate((pages, pages.repartition(9), pages)):
        out = tmp_path / str(k)
        manifest = W.write_warc(df, f"file:{out}").collect()
        assert sum(m.n_records for m in manifest) == n and max(m.n_records for m in manifest) < n // 4
        runs.append({p.name: p.read_bytes() for p in out.glob("*.warc.gz")})
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) > 5


def test_cuts_hold_a_share_each(spark):
    import random

    from pyspark.sql import functions as F

    from hourglass.llm import cuts as C
    own = random.Random(3)
    keys = [own.choice([5, -2**63, 2**63 - 1, own.randint(-2**62, 2**62), own.randint(0, 500)]) for _ in range(4000)]
    rows = spark.createDataFrame([(k, own.randint(0, 90), i) for i, k in enumerate(keys)],
                                 "key long, n_bytes long, i int").repartition(3)
    found = C.range_cuts(rows, 25)
    assert found == sorted(found) and 20 <= len(found) <= 120
    dealt = rows.withColumn("s", C.shard_of(F.col("key"), F.sha2(F.concat_ws(":", "key", "n_bytes", "i"), 256), found))
    sums = [r.n for r in dealt.groupBy("s").agg(F.sum("n_bytes").alias("n")).collect()]
    total = sum(sums)
    assert max(sums) <= 1.6 * total / 25
    import bisect
    pairs = [(k, 0) for k in keys[:300]]
    got = [r.p for r in spark.createDataFrame(pairs, "key long, part long").select(
        C.shard_of(F.col("key"), F.lit("00000000"), found).alias("p")).collect()]
    assert got == [bisect.bisect_right(found, p) for p in pairs]
    assert C.range_cuts(rows.limit(0), 5) == []


def test_addresses_are_those_of_spark(spark, tmp_path):
    """A path without a scheme lies on the default filesystem, for tasks too."""
    from hourglass.llm.shared_files import qualified, resolve
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    try:
        conf.set("fs.defaultFS", "viewfs://store/")
        conf.set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}")
        assert qualified(spark, "/in/a") == "viewfs://store/in/a"
    finally:
        conf.set("fs.defaultFS", before)
    assert resolve(qualified(spark, str(tmp_path)))[1] == str(tmp_path)


def test_empty_and_damaged(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    out = work_dir(spark, "warc")
    assert W.write_warc(pages.limit(0), out).count() == 0 and W.read_warc(spark, out).count() == 0
    raw = W.record(1, "http://a/", b"payload", "0" * 64, None, False, W.DATE)
    with pytest.raises(ValueError, match="does not match"):
        W.parse_record(raw)
    (tmp_path / "x").write_bytes(W.gzip_member(raw, 6)[:-9])
    with pytest.raises(ValueError, match="ends inside"):
        list(W.read_members(str(tmp_path / "x")))
