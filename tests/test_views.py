import json

from pyspark.sql import functions as F

from hourglass.operators import decode, views
from hourglass.plans import inspect
from hourglass.sources import facts as FS


def pv_lines(spark, rows):
    docs = [json.dumps({"messagetype": "pageview", "pedigree": str(s), "personid": p,
                        "pageid": u}) for (u, s, p) in rows]
    return spark.createDataFrame([(d,) for d in docs], "value string")


ROWS = [
    ("http://a.org/x?q=1", 3600 * 10 + 5, "1"),
    ("http://a.org/x#f", 3600 * 10 + 5, "2"),          # same second, same normalized url
    ("http://a.org:81/x", 3600 * 11, "cookie_3"),
    ("http://b.org/", 3600 * 24 * 30, "4"),
    ("not a url", 7, "5"),                             # kept unchanged by the batch path
]


def test_view_counts_every_fact_and_rolls_up(spark):
    facts = decode.to_facts(decode.parse_messages(pv_lines(spark, ROWS)))
    v = {(r.url, r.granularity, r.bucket): r.total_pageviews
         for r in views.batch_view(facts).collect()}
    assert v[("http://a.org/x", "h", 10)] == 2       # no de-duplication
    assert v[("http://a.org/x", "h", 11)] == 1
    assert v[("http://a.org/x", "d", 0)] == 3
    assert v[("http://b.org/", "m", 30 // 28)] == 1
    assert v[("not a url", "h", 0)] == 1
    totals = {}
    for (u, g, b), n in v.items():
        totals[g] = totals.get(g, 0) + n
    assert set(totals.values()) == {len(ROWS)}


def test_normalize_flag(spark):
    facts = decode.to_facts(decode.parse_messages(pv_lines(spark, ROWS)))
    raw = views.hourly_counts(facts, normalize=False)
    assert raw.where(F.col("url") == "http://a.org/x?q=1").count() == 1


def test_plan_two_exchanges_no_python(spark):
    facts = decode.to_facts(decode.parse_messages(pv_lines(spark, ROWS)))
    v = views.batch_view(facts)
    assert inspect.count_nodes(v, "Exchange") == 2
    assert inspect.count_nodes(v, "HashAggregate") == 4   # partial + final, twice
    assert not inspect.uses_python(v)


def test_partitioned_read_prunes_to_page_views(spark, workdir):
    facts = decode.to_facts(decode.parse_messages(pv_lines(spark, ROWS)))
    FS.write_facts(facts, f"{workdir}/master")
    src = FS.read_facts(spark, f"{workdir}/master")
    v = views.batch_view(src)
    pf = inspect.partition_filters(v)
    assert any("dataunit_id" in p and "= 4" in p for p in pf), pf
    # column pruning: the scan reads page_view fields and the timestamp only
    rs = " ".join(inspect.read_schemas(v))
    assert "person_property" not in rs and "equiv" not in rs
    assert v.count() == views.batch_view(facts).count()


def test_merge_views_is_additive(spark):
    facts = decode.to_facts(decode.parse_messages(pv_lines(spark, ROWS)))
    a = facts.where("true_as_of_secs < 40000")
    b = facts.where("true_as_of_secs >= 40000")
    merged = views.merge_views(views.batch_view(a), views.batch_view(b))
    full = views.batch_view(facts)
    assert sorted(merged.collect()) == sorted(full.collect())


def test_key_value_round_trip(spark):
    facts = decode.to_facts(decode.parse_messages(pv_lines(spark, ROWS)))
    v = views.batch_view(facts)
    back = views.from_key_value(views.to_key_value(v))
    assert sorted(back.collect()) == sorted(v.collect())
    k = views.to_key_value(v.where("url = 'http://a.org/x' and granularity = 'h' and bucket = 10"))
    r = k.first()
    assert bytes(r.key).decode() == "http://a.org/x/h-10"
    assert bytes(r.value) == (2).to_bytes(8, "big")
