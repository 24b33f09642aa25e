import json

from pyspark.sql import functions as F

from hourglass.operators import decode


def lines(spark, *docs):
    return spark.createDataFrame([(d,) for d in docs], "value string")


PV = {"messagetype": "pageview", "pedigree": "1391212801", "personid": "2",
      "pageid": "http://blog.d3.org"}
PAGE = {"messagetype": "page", "pedigree": "1391212800", "url": "http://blog.d1.org?article=1",
        "pageview": "2"}
PERSON = {"messagetype": "person", "pedigree": "1391212800", "personid": "cookie_1",
          "gendertype": "MALE", "fullname": "A B", "city": "X", "state": "Y", "country": "Z"}
EQUIV = {"messagetype": "equiv", "pedigree": "1391212800", "personid1": "1",
         "personid2": "cookie_1"}


def envelope(*msgs, trailing_comma=True):
    body = ",".join(json.dumps(m) for m in msgs)
    return '{"messagetype": "messages","messages":[' + body + (",]}" if trailing_comma else "]}")


def test_envelope_with_trailing_comma_is_flattened(spark):
    p = decode.parse_messages(lines(spark, envelope(PV, PAGE, PERSON, EQUIV), json.dumps(PV)))
    rows = p.orderBy("line_hash", "pos").collect()
    assert len(rows) == 5
    assert all(r.reason is None for r in rows)
    assert sorted(r.messagetype for r in rows) == ["equiv", "page", "pageview", "pageview", "person"]


def test_facts_one_per_message_three_per_person(spark):
    facts, bad = decode.decode_facts(lines(spark, envelope(PV, PAGE, PERSON, EQUIV)))
    counts = {(r.dataunit_id, r.value_id): r["count"]
              for r in facts.groupBy("dataunit_id", "value_id").count().collect()}
    assert counts == {(4, 0): 1, (2, 1): 1, (1, 1): 1, (1, 2): 1, (1, 3): 1, (3, 0): 1}
    assert bad.count() == 0
    person = {r.value_id: r.person_property.property for r in
              facts.where("dataunit_id = 1").collect()}
    assert person[1].full_name == "A B" and person[1].gender is None
    assert person[2].gender == "MALE" and person[2].location is None
    assert person[3].location.asDict() == {"city": "X", "state": "Y", "country": "Z"}


def test_last_property_only_keeps_full_name(spark):
    facts, _ = decode.decode_facts(lines(spark, json.dumps(PERSON)), last_property_only=True)
    rows = facts.collect()
    assert len(rows) == 1 and rows[0].value_id == 1
    assert rows[0].person_property.property.full_name == "A B"


def test_quarantine_reasons_and_envelope_survives(spark):
    docs = [
        "not json at all",
        json.dumps({"pedigree": "1"}),
        json.dumps({"messagetype": "click", "pedigree": "1"}),
        json.dumps({**PV, "pedigree": "soon"}),
        json.dumps({**PV, "personid": "user-1"}),
        json.dumps({**PAGE, "pageview": "many"}),
        json.dumps({k: v for k, v in PERSON.items() if k != "gendertype"}),
        json.dumps({"messagetype": "messages", "messages": "oops"}),
        envelope(PV, {**PV, "personid": "x"}, PAGE),
    ]
    p = decode.parse_messages(lines(spark, *docs))
    reasons = sorted(r.reason for r in p.where("reason is not null").collect())
    assert reasons == sorted(["not_json", "missing_messagetype", "unknown_messagetype",
                              "bad_pedigree", "bad_personid", "bad_pageview",
                              "missing_gendertype", "bad_envelope", "bad_personid"])
    # the two good messages of the mixed envelope still decode
    assert p.where("reason is null").count() == 2


def test_bad_url_batch_keeps_speed_quarantines(spark):
    doc = json.dumps({**PV, "pageid": "not a url"})
    batch = decode.parse_messages(lines(spark, doc))
    speed = decode.parse_messages(lines(spark, doc), strict_urls=True)
    assert batch.first().reason is None
    assert speed.first().reason == "bad_url"
    facts = decode.to_facts(batch)
    assert facts.first().page_view.page.url == "not a url"


def test_gender_anything_else_is_female_raw_kept_for_speed(spark):
    doc = json.dumps({**PERSON, "gendertype": "unknown"})
    p = decode.parse_messages(lines(spark, doc))
    f = decode.to_facts(p).where("value_id = 2").first()
    assert f.person_property.property.gender == "FEMALE"
    rt = decode.realtime_rows(p)["persons"].first()
    assert rt.gendertype == "unknown"


def test_nonce_differs_by_position_and_delivery(spark):
    env = envelope(PV, PV)
    df = spark.createDataFrame([(env, 0), (env, 1)], "value string, offset int")
    facts, _ = decode.decode_facts(df, coordinate_cols=("offset",))
    nonces = [r.page_view.nonce for r in facts.collect()]
    assert len(nonces) == 4 and len(set(nonces)) == 4


def test_numbers_as_json_numbers_are_accepted(spark):
    doc = '{"messagetype":"pageview","pedigree":1391212801,"personid":2,"pageid":"http://a.org/"}'
    f = decode.to_facts(decode.parse_messages(lines(spark, doc))).first()
    assert f.true_as_of_secs == 1391212801
    assert f.page_view.person.user_id == 2


def test_empty_envelope_yields_nothing(spark):
    p = decode.parse_messages(lines(spark, '{"messagetype":"messages","messages":[]}'))
    assert p.count() == 0


def test_new_data_carries_quarantine_in_partition_zero(spark):
    p = decode.parse_messages(lines(spark, json.dumps(PV), "garbage"))
    nd = decode.to_new_data(p)
    got = {(r.dataunit_id, r.reason) for r in nd.collect()}
    assert got == {(4, None), (0, "not_json")}
    assert F is not None


def test_large_envelope_decodes_every_message(spark):
    msgs = [{**PV, "pedigree": str(1391212800 + i), "personid": str(i)} for i in range(20000)]
    p = decode.parse_messages(lines(spark, envelope(*msgs)))
    facts = decode.to_facts(p)
    assert facts.count() == 20000
    assert facts.select("page_view.nonce").distinct().count() == 20000


def test_posexplode_carries_no_envelope_copies(spark):
    from hourglass.plans import inspect
    plan = inspect.plan_text(decode.to_new_data(decode.parse_messages(
        lines(spark, envelope(PV, PAGE)))), "formatted")
    args = [l for l in plan.splitlines() if l.startswith("Arguments: posexplode(")]
    assert args, plan
    carried = args[0].split("), [", 1)[1]
    # only small per-line values ride along with each message
    assert "_p#" not in carried and "_items#" not in carried, carried
    # and every line is parsed exactly once
    assert plan.split("\n\n\n", 1)[1].count("from_json(") == 1
