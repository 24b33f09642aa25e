"""Property checks: each hypothesis example is a whole batch of rows checked
in one DataFrame, so a few examples cover many values."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourglass.functions import (
    bucketed_key, deserialize_long, granularity_buckets, hour_bucket, key_bucket,
    key_granularity, key_url, serialize_long,
)


def tdiv(a: int, b: int) -> int:
    q = abs(a) // b
    return q if a >= 0 else -q


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-(2 ** 40), max_value=2 ** 40), min_size=1, max_size=200))
def test_buckets_truncate_toward_zero(spark, secs):
    df = spark.createDataFrame([(s,) for s in secs], "s long")
    rows = df.select("s", hour_bucket("s").alias("h")).select(
        "s", "h", F.inline(granularity_buckets("h"))).collect()
    for r in rows:
        h = tdiv(r.s, 3600)
        want = {"h": h, "d": tdiv(h, 24), "w": tdiv(tdiv(h, 24), 7), "m": tdiv(tdiv(h, 24), 28)}
        assert r.h == h and r.bucket == want[r.granularity]


urls = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), min_size=0, max_size=40)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(urls, st.sampled_from("hdwm"),
                          st.integers(min_value=-(2 ** 40), max_value=2 ** 40),
                          st.integers(min_value=-(2 ** 63), max_value=2 ** 63 - 1)),
                min_size=1, max_size=100))
def test_key_value_round_trip(spark, rows):
    df = spark.createDataFrame(rows, "url string, g string, b long, n long")
    kv = df.select("url", "g", "b", "n", bucketed_key("url", "g", "b").alias("key"),
                   serialize_long("n").alias("value"))
    for r in kv.select("url", "g", "b", "n", key_url("key").alias("u2"),
                       key_granularity("key").alias("g2"), key_bucket("key").alias("b2"),
                       deserialize_long("value").alias("n2"), "value").collect():
        assert (r.u2, r.g2, r.b2, r.n2) == (r.url, r.g, r.b, r.n)
        assert bytes(r.value) == r.n.to_bytes(8, "big", signed=True)


text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), min_size=1, max_size=20)
person_ids = st.one_of(text.map(lambda t: "cookie" + t),
                       st.integers(min_value=-(2 ** 62), max_value=2 ** 62).map(str))
messages = st.one_of(
    st.tuples(st.just("pageview"), st.integers(-(2 ** 31), 2 ** 31 - 1), person_ids, text),
    st.tuples(st.just("page"), st.integers(-(2 ** 31), 2 ** 31 - 1), text, st.integers(0, 2 ** 31 - 1)),
    st.tuples(st.just("equiv"), st.integers(-(2 ** 31), 2 ** 31 - 1), person_ids, person_ids),
)


def as_json(m):
    kind, secs, a, b = m
    base = {"messagetype": kind, "pedigree": str(secs)}
    if kind == "pageview":
        base.update(personid=a, pageid=b)
    elif kind == "page":
        base.update(url=a, pageview=str(b))
    else:
        base.update(personid1=a, personid2=b)
    return base


def pid(s):
    return (s, None) if s.startswith("cookie") else (None, int(s))


@settings(max_examples=10, deadline=None)
@given(st.lists(messages, min_size=1, max_size=60), st.integers(1, 5))
def test_decode_round_trip(spark, msgs, per_envelope):
    import json
    from hourglass.operators import decode
    docs, i = [], 0
    while i < len(msgs):   # alternate single lines and trailing-comma envelopes
        chunk = msgs[i:i + per_envelope]
        if (i // per_envelope) % 2:
            docs.append('{"messagetype":"messages","messages":['
                        + ",".join(json.dumps(as_json(m)) for m in chunk) + ",]}")
        else:
            docs.extend(json.dumps(as_json(m)) for m in chunk)
        i += per_envelope
    facts, bad = decode.decode_facts(spark.createDataFrame([(d,) for d in docs], "value string"))
    assert bad.count() == 0
    got = []
    for r in facts.collect():
        if r.dataunit_id == 4:
            p = r.page_view
            got.append(("pageview", r.true_as_of_secs, (p.person.cookie, p.person.user_id),
                        p.page.url))
        elif r.dataunit_id == 2:
            got.append(("page", r.true_as_of_secs, r.page_property.id.url,
                        r.page_property.property.page_views))
        else:
            e = r.equiv
            got.append(("equiv", r.true_as_of_secs, (e.id1.cookie, e.id1.user_id),
                        (e.id2.cookie, e.id2.user_id)))
    want = []
    for kind, secs, a, b in msgs:
        if kind == "pageview":
            want.append((kind, secs, pid(a), b))
        elif kind == "page":
            want.append((kind, secs, a, b))
        else:
            want.append((kind, secs, pid(a), pid(b)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
