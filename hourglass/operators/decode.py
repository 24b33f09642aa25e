"""Queue messages -> typed facts, quarantine rows and realtime rows.

One pass, all JVM-side: the trailing comma some producers leave before ``]``
is removed, the line is parsed once with ``from_json`` into a struct holding
every message field, envelopes are flattened with ``posexplode``, and each
message is routed by ``messagetype`` with ``when`` columns (no per-type
re-scan). A message that cannot be decoded is never an exception: it carries
a ``reason`` and goes to the quarantine output, the rest of its envelope
survives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass import schemas as S
from hourglass.functions import (
    gender,
    hour_bucket,
    is_person_id,
    is_valid_url,
    normalize_url,
    opaque,
    parse_int,
    person_id,
)

# A trailing comma before the closing "]}" of an envelope.
TRAILING_COMMA = r",\s*\]\s*\}\s*$"

def _null_message() -> Column:
    return F.lit(None).cast(S.MESSAGE)


def parse_messages(lines: DataFrame, value_col: str = "value",
                   coordinate_cols: tuple[str, ...] | None = None,
                   strict_urls: bool = False) -> DataFrame:
    """One row per message with its string fields, ``secs`` and ``reason``.

    ``lines`` holds one JSON document per row in ``value_col`` (a single
    message or a ``messages`` envelope). ``coordinate_cols`` make ``line_hash``,
    and so the pageview nonce, unique per delivery; by default topic, partition
    and offset if the source has them. ``strict_urls=True`` (speed layer)
    quarantines a page or pageview whose URL does not parse; the batch path
    keeps such URLs unchanged.

    Columns: line_hash, pos, raw (text of a quarantined message, else NULL),
    reason, secs and every message field.
    """
    v = F.col(value_col)
    cleaned = F.regexp_replace(v, TRAILING_COMMA, "]}")
    p = F.from_json(cleaned, S.ENVELOPE,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COLUMN})
    if coordinate_cols is None:
        coordinate_cols = tuple(c for c in S.QUEUE_COORDINATES if c in lines.columns)
    hash_inputs = [v] + [F.col(c) for c in coordinate_cols]
    df = lines.select(
        v.alias("_line"),
        F.xxhash64(*hash_inputs).alias("line_hash"),
        p.alias("_p"),
    )
    pc = F.col("_p")
    top_type = pc["messagetype"]
    is_env = F.coalesce(top_type == S.ENVELOPE_TYPE, F.lit(False))
    # Malformed JSON parses to all-NULL fields plus the corrupt-record column;
    # a well-formed envelope whose "messages" is not an array of objects keeps
    # its messagetype (partial result) and is a bad envelope instead.
    corrupt = F.col("_line").isNull() | pc.isNull() | pc[S.CORRUPT_COLUMN].isNotNull()
    single = F.struct(*[pc[n].alias(n) for n in S.MESSAGE_FIELDS])
    line_reason = (
        F.when(corrupt & is_env, "bad_envelope")
        .when(corrupt, "not_json")
        .when(top_type.isNull(), "missing_messagetype")
        .when(is_env & pc["messages"].isNull(), "bad_envelope")
    )
    # Each exploded element carries its message plus, for a line that failed
    # as a whole, the reason and the line text (its single quarantine row).
    # Everything is computed inside the generator's input from the one parsed
    # struct, so the line is parsed once and posexplode copies only
    # ``line_hash`` into each message row: a good envelope's text and parsed
    # struct are never repeated per message (decoding stays linear in
    # envelope size).
    def item(msg, reason, text):
        return F.struct(msg.alias("m"), reason.alias("r"), text.alias("l"))

    none = F.lit(None).cast("string")
    items = (
        F.when(line_reason.isNotNull(),
               F.array(item(_null_message(), line_reason, F.col("_line"))))
        .when(is_env, F.transform(pc["messages"], lambda x: item(x, none, none)))
        .otherwise(F.array(item(single, none, none)))
    )
    df = df.select("line_hash", F.posexplode(items).alias("pos", "_it"))
    it = F.col("_it")
    m = it["m"]
    fields = [m[n].alias(n) for n in S.MESSAGE_FIELDS]
    df = df.select(it["l"].alias("_line"), "line_hash", it["r"].alias("_line_reason"),
                   "pos", *fields)

    t = F.col("messagetype")
    # A timestamp is a 32-bit number of seconds; milliseconds and other numbers beyond
    # it are rejected like text.
    secs = parse_int(F.col("pedigree")).cast("bigint")
    pid_bad = lambda c: ~is_person_id(F.col(c))
    msg_reason = (
        F.when(F.col("_line_reason").isNotNull(), F.col("_line_reason"))
        .when(t.isNull(), "missing_messagetype")
        .when(~t.isin(*S.MESSAGE_TYPES), "unknown_messagetype")
        .when(secs.isNull(), "bad_pedigree")
        # page
        .when((t == "page") & F.col("url").isNull(), "missing_field")
        .when((t == "page") & parse_int(F.col("pageview")).isNull(), "bad_pageview")
        # person
        .when((t == "person") & pid_bad("personid"), "bad_personid")
        .when((t == "person") & F.col("gendertype").isNull(), "missing_gendertype")
        .when((t == "person") & F.col("fullname").isNull(), "missing_field")
        # equiv
        .when((t == "equiv") & (pid_bad("personid1") | pid_bad("personid2")), "bad_personid")
        # pageview
        .when((t == "pageview") & pid_bad("personid"), "bad_personid")
        .when((t == "pageview") & F.col("pageid").isNull(), "missing_field")
    )
    if strict_urls:
        msg_reason = (
            msg_reason
            .when((t == "page") & ~is_valid_url(F.col("url")), "bad_url")
            .when((t == "pageview") & ~is_valid_url(F.col("pageid")), "bad_url")
        )
    # For a quarantined message: its own JSON when it was parsed, else the
    # whole line. Valid messages carry no text (nothing downstream needs it).
    raw = F.when(msg_reason.isNotNull(), F.coalesce(
        F.when(F.col("_line_reason").isNull(),
               F.to_json(F.struct(*[F.col(n) for n in S.MESSAGE_FIELDS]))),
        F.col("_line"),
    ))
    # The plain fields stand before what is computed from all of them: the optimizer
    # restates the equations it has so far for every further column, so a large
    # expression in front would be restated once for each field after it.
    return df.select(
        "line_hash", "pos", *S.MESSAGE_FIELDS,
        secs.alias("secs"),
        raw.alias("raw"),
        msg_reason.alias("reason"),
    )


def to_facts(parsed: DataFrame, last_property_only: bool = False) -> DataFrame:
    """Valid parsed messages -> rows of the ``FACTS`` schema.

    A person message yields three facts (full name, gender, location; value
    ids 1, 2, 3). ``last_property_only=True`` keeps only the full-name fact,
    which is what a single union set three times retains.
    """
    valid = parsed.where(F.col("reason").isNull())
    return facts_from_valid(valid, last_property_only)


def facts_from_valid(valid: DataFrame, last_property_only: bool = False) -> DataFrame:
    return _fact_projection(valid, last_property_only, keep_quarantine=False)


def _fact_projection(parsed: DataFrame, last_property_only: bool,
                     keep_quarantine: bool) -> DataFrame:
    """One Generate + Project from parsed messages to fact rows.

    With ``keep_quarantine`` a quarantined message becomes one row with
    ``dataunit_id = 0``, NULL fact columns and its raw text and reason, so
    facts and quarantine come out of the same single pass.
    """
    t = F.col("messagetype")
    bad = F.col("reason").isNotNull()
    person_vids = (F.array(F.lit(S.FULL_NAME)) if last_property_only
                   else F.array(F.lit(S.FULL_NAME), F.lit(S.GENDER), F.lit(S.LOCATION)))
    value_ids = (
        F.when(bad, F.array(F.lit(S.EDGE_VALUE_ID)))
        .when(t == "person", person_vids)
        .when(t == "page", F.array(F.lit(S.PAGE_VIEWS)))
        .otherwise(F.array(F.lit(S.EDGE_VALUE_ID)))
    )
    df = parsed if keep_quarantine else parsed.where(~bad)
    df = df.select("*", F.explode(value_ids).alias("value_id"))
    vid = F.col("value_id")
    ok = ~bad

    person_property = F.when(ok & (t == "person"), F.struct(
        person_id(F.col("personid")).alias("id"),
        F.struct(
            F.when(vid == S.FULL_NAME, F.col("fullname")).alias("full_name"),
            F.when(vid == S.GENDER, gender(F.col("gendertype"))).alias("gender"),
            F.when(vid == S.LOCATION, F.struct(
                F.col("city").alias("city"),
                F.col("state").alias("state"),
                F.col("country").alias("country"))).alias("location"),
        ).alias("property"),
    ))
    page_property = F.when(ok & (t == "page"), F.struct(
        F.struct(F.col("url").alias("url")).alias("id"),
        F.struct(parse_int(F.col("pageview")).alias("page_views")).alias("property"),
    ))
    equiv = F.when(ok & (t == "equiv"), F.struct(
        person_id(F.col("personid1")).alias("id1"),
        person_id(F.col("personid2")).alias("id2"),
    ))
    page_view = F.when(ok & (t == "pageview"), F.struct(
        person_id(F.col("personid")).alias("person"),
        F.struct(F.col("pageid").alias("url")).alias("page"),
        F.xxhash64(F.col("line_hash"), F.col("pos")).alias("nonce"),
    ))
    dataunit = (
        F.when(bad, S.QUARANTINE_DATAUNIT_ID)
        .when(t == "person", S.PERSON_PROPERTY)
        .when(t == "page", S.PAGE_PROPERTY)
        .when(t == "equiv", S.EQUIV)
        .when(t == "pageview", S.PAGE_VIEW)
    )
    cols = [
        F.when(ok, F.col("secs")).alias("true_as_of_secs"),
        dataunit.cast("int").alias("dataunit_id"),
        vid.cast("int").alias("value_id"),
        person_property.cast(S.PERSON_PROPERTY_T).alias("person_property"),
        page_property.cast(S.PAGE_PROPERTY_T).alias("page_property"),
        equiv.cast(S.EQUIV_T).alias("equiv"),
        page_view.cast(S.PAGE_VIEW_T).alias("page_view"),
    ]
    if keep_quarantine:
        cols += [F.when(bad, F.col("raw")).alias("raw"), F.col("reason")]
    return df.select(*cols)


def to_quarantine(parsed: DataFrame) -> DataFrame:
    """(raw, reason) of every message that could not be decoded."""
    return parsed.where(F.col("reason").isNotNull()).select("raw", "reason")


def to_new_data(parsed: DataFrame, last_property_only: bool = False) -> DataFrame:
    """Facts and quarantine rows in one DataFrame (schema ``NEW_DATA``).

    Quarantined messages carry ``dataunit_id = 0`` and NULL fact columns, so a
    single pass (and a single exactly-once sink) writes both; readers select
    them back apart with a partition filter.
    """
    return _fact_projection(parsed, last_property_only, keep_quarantine=True)


def decode_facts(lines: DataFrame, value_col: str = "value",
                 coordinate_cols: tuple[str, ...] | None = None,
                 last_property_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """(facts, quarantine) of a DataFrame of JSON lines (batch or streaming)."""
    parsed = parse_messages(lines, value_col, coordinate_cols)
    return to_facts(parsed, last_property_only), to_quarantine(parsed)


# --- realtime rows (speed layer) --------------------------------------------------------

def realtime_rows(parsed: DataFrame) -> dict[str, DataFrame]:
    """Keyed rows for the four realtime tables from valid parsed messages.

    URLs are normalized. Versions of a key are ordered by
    ``realtime.version_order``.
    """
    ok = parsed.where(F.col("reason").isNull())
    t = F.col("messagetype")
    pageviews = ok.where(t == "pageview").select(
        opaque(normalize_url(F.col("pageid"))).alias("url"),
        hour_bucket(F.col("secs")).alias("hour_bucket"),
        F.col("secs"),
        F.col("personid"),
    )
    pages = ok.where(t == "page").select(
        opaque(normalize_url(F.col("url"))).alias("url"),
        F.col("pedigree"), F.col("pageview"), F.col("secs"),
    )
    persons = ok.where(t == "person").select(
        "personid", "pedigree", "gendertype", "fullname", "city", "state", "country",
        F.col("secs"),
    )
    equivs = ok.where(t == "equiv").select(
        "personid1", "personid2", "pedigree", F.col("secs"),
    )
    return {"pageviews": pageviews, "pages": pages, "persons": persons, "equivs": equivs}
