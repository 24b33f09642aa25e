from pyspark.sql import functions as F

from hourglass.functions import (
    bucketed_key_string, deserialize_long, gender, granularity_buckets, hour_bucket,
    key_bucket, key_granularity, key_url, normalize_url, person_id,
    serialize_long,
)
from hourglass.functions import urls


def one(spark, col, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("r")).first()["r"]


URL_CASES = [
    ("http://blog.d1.org?article=1", "http://blog.d1.org"),
    ("http://blog.domain_10.org/a/b", "http://blog.domain_10.org/a/b"),   # underscore host
    ("HTTP://Example.COM/Path", "http://Example.COM/Path"),                 # protocol lowered, host kept
    ("http://example.com:8080/x?y=1#z", "http://example.com/x"),            # port, query, fragment
    ("https://user:pw@example.com/p", "https://example.com/p"),             # user info
    ("http://a@b@example.com/p?x=@", "http:///p"),                          # two "@": no host
    ("http://a@example.com/p@q?x=@", "http://example.com/p@q"),
    ("\t http://example.com/a\r\n", "http://example.com/a"),                # control characters around it
    ("URL:http://example.com/a", "http://example.com/a"),                   # "url:" in front
    ("http://example.com:2147483647/p", "http://example.com/p"),
    ("http://example.com:0002147483647/p", "http://example.com/p"),
    ("http://example.com:2147483648/p", "http://example.com:2147483648/p"),  # port beyond 32 bits: unchanged
    ("http://example.com:99999999999/p", "http://example.com:99999999999/p"),
    ("http://example.com/a b/c", "http://example.com/a b/c"),               # blank in path
    ("http://example.com#frag?x", "http://example.com"),
    ("http://example.com:/p", "http://example.com/p"),                      # empty port
    ("http://[::1]:80/p", "http://[::1]/p"),                                # IPv6 host
    ("http://example.com:8x/p", "http://example.com:8x/p"),                 # bad port: unchanged
    ("gopher://example.com/p", "gopher://example.com/p"),                   # unknown scheme: unchanged
    ("example.com/p", "example.com/p"),                                     # no scheme: unchanged
    ("bad url 17", "bad url 17"),
    ("  http://example.com/a?b  ", "http://example.com/a"),                 # surrounding blanks
    ("http://example.com/a?b\nc", "http://example.com/a"),                  # line break in query
]


def test_normalize_url_cases(spark):
    df = spark.createDataFrame(URL_CASES, "raw string, want string")
    got = df.select("want", normalize_url("raw").alias("got")).collect()
    for r in got:
        assert r["got"] == r["want"]
    assert one(spark, normalize_url(F.col("v")), None) is None


def test_plain_urls_are_normalized_without_patterns(spark):
    """the cut at "?" and "#" is taken for plain URLs only, and is what the patterns give."""
    starts = ["http://", "https://", "HTTP://", "ftp://", " http://", "url:http://", "http:/", "https:"]
    hosts = ["", "a.b", "a.b:80", "u@a.b", "u@v@a.b", "[::1]", "[a?b]", "[a/b]", "é", "a b"]
    rests = ["", "/", "/p", "/p:q", "/p@q", "?x=:@", "/p?x=[y]#z", "#z?x", "/é", "/p?x=é",
             " ", "/p ", "/p\u2028", "/p \u2028", "/p?x\n", "/p\nq"]
    raw = [(s + h + r,) for s in starts for h in hosts for r in rests] + [("",), (None,), ("bad url 1",)]
    u = F.col("raw")
    got = spark.createDataFrame(raw, "raw string").select(
        u, normalize_url(u).alias("got"), urls._by_patterns(u).alias("want"), urls._is_plain(u).alias("plain")).collect()
    assert [(r["raw"], r["got"]) for r in got] == [(r["raw"], r["want"]) for r in got]
    plain = {r["raw"] for r in got if r["plain"]}
    assert {"http://a.b/p?x=[y]#z", "https://a.b#z?x", "http://a.b?x=:@", "http://é/"} <= plain
    assert not plain & {"HTTP://a.b", "http://a.b:80/", "http://u@a.b/p", "http://[a?b]/p", "http://a.b/p "}


def test_hour_bucket_truncates_toward_zero(spark):
    df = spark.createDataFrame([(7201,), (3599,), (-1,), (-3601,)], "s long")
    got = [r[0] for r in df.select(hour_bucket("s")).collect()]
    assert got == [2, 0, 0, -1]


def test_granularities_epoch_month_is_28_days(spark):
    h = 473688  # 2024-01-15 00:00 UTC
    rows = spark.createDataFrame([(h,)], "h long").select(
        F.inline(granularity_buckets("h"))).collect()
    got = {r["granularity"]: r["bucket"] for r in rows}
    assert got == {"h": h, "d": h // 24, "w": h // 24 // 7, "m": h // 24 // 28}


def test_key_value_roundtrip(spark):
    df = spark.createDataFrame([("http://a.org/x", "d", 19737, 5), ("http://a.org/x/y", "h", -3, -2)],
                               "url string, g string, b long, n long")
    kv = df.select(
        F.encode(bucketed_key_string("url", "g", "b"), "UTF-8").alias("key"),
        serialize_long("n").alias("value"),
        F.col("url"), F.col("g"), F.col("b"), F.col("n"))
    rows = kv.select(key_url("key").alias("u"), key_granularity("key").alias("g2"),
                     key_bucket("key").alias("b2"), deserialize_long("value").alias("n2"),
                     F.hex("value").alias("hx"), "url", "g", "b", "n").collect()
    for r in rows:
        assert (r.u, r.g2, r.b2, r.n2) == (r.url, r.g, r.b, r.n)
    assert rows[0].hx == "0000000000000005"
    assert rows[1].hx == "FFFFFFFFFFFFFFFE"


def test_person_id_and_gender(spark):
    assert one(spark, person_id(F.col("v")), "cookie_7").asDict() == {"cookie": "cookie_7",
                                                                       "user_id": None}
    assert one(spark, person_id(F.col("v")), "42").asDict() == {"cookie": None, "user_id": 42}
    assert one(spark, person_id(F.col("v")), "user-9") is None
    assert one(spark, gender(F.col("v")), "MALE") == "MALE"
    assert one(spark, gender(F.col("v")), "male") == "FEMALE"
    assert one(spark, gender(F.col("v")), "whatever") == "FEMALE"


def test_query_hour(spark):
    from hourglass.operators.serving import query_hour
    assert query_hour("15.01.2024|00") == 473688
    assert query_hour("15.01.2024|13") == 473701
    assert query_hour("15.01.2024|12") == 473700
    assert query_hour("15.01.2024|12", legacy_12h=True) == 473688
