"""Typed schemas of the data model (facts, views, realtime tables, messages)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values of the data model -------------------------------------------------
# Fact kinds (union branch ids of a data unit).
PERSON_PROPERTY = 1
PAGE_PROPERTY = 2
EQUIV = 3
PAGE_VIEW = 4
# Person property value branch ids.
FULL_NAME = 1
GENDER = 2
LOCATION = 3
# Page property value branch id.
PAGE_VIEWS = 1
# Edges carry no value id; 0 is this library's placeholder for the second level.
EDGE_VALUE_ID = 0
# Legal (dataunit_id, value_id) partitions of the master dataset.
LEGAL_PARTITIONS = [(1, 1), (1, 2), (1, 3), (2, 1), (3, 0), (4, 0)]

# Message types on the queue; "messages" is the envelope type.
MESSAGE_TYPES = ["page", "person", "equiv", "pageview"]
ENVELOPE_TYPE = "messages"
# Granularities of the batch view, finest first.
GRANULARITIES = ["h", "d", "w", "m"]
# -------------------------------------------------------------------------------------

PERSON_ID = StructType([
    StructField("cookie", StringType()),
    StructField("user_id", LongType()),
])
PAGE_ID = StructType([StructField("url", StringType())])
LOCATION_T = StructType([
    StructField("city", StringType()),
    StructField("state", StringType()),
    StructField("country", StringType()),
])
PERSON_PROPERTY_T = StructType([
    StructField("id", PERSON_ID),
    StructField("property", StructType([
        StructField("full_name", StringType()),
        StructField("gender", StringType()),
        StructField("location", LOCATION_T),
    ])),
])
PAGE_PROPERTY_T = StructType([
    StructField("id", PAGE_ID),
    StructField("property", StructType([StructField("page_views", IntegerType())])),
])
EQUIV_T = StructType([
    StructField("id1", PERSON_ID),
    StructField("id2", PERSON_ID),
])
PAGE_VIEW_T = StructType([
    StructField("person", PERSON_ID),
    StructField("page", PAGE_ID),
    StructField("nonce", LongType()),
])

FACTS = StructType([
    StructField("true_as_of_secs", LongType()),
    StructField("dataunit_id", IntegerType()),
    StructField("value_id", IntegerType()),
    StructField("person_property", PERSON_PROPERTY_T),
    StructField("page_property", PAGE_PROPERTY_T),
    StructField("equiv", EQUIV_T),
    StructField("page_view", PAGE_VIEW_T),
])
FACT_COLUMNS = [f.name for f in FACTS.fields]
PARTITION_COLUMNS = ["dataunit_id", "value_id"]

# Rows of the ingest sink: facts plus the quarantine columns. Quarantined
# messages land in partition dataunit_id = 0 so one pass writes both.
QUARANTINE_DATAUNIT_ID = 0
NEW_DATA = StructType(FACTS.fields + [
    StructField("raw", StringType()),
    StructField("reason", StringType()),
])

BATCH_VIEW = StructType([
    StructField("url", StringType()),
    StructField("granularity", StringType()),
    StructField("bucket", LongType()),
    StructField("total_pageviews", LongType()),
])
BATCH_VIEW_KV = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
])

# All fields any queue message may carry; every value is a JSON string.
MESSAGE_FIELDS = [
    "messagetype", "pedigree",
    "url", "pageview",
    "personid", "gendertype", "fullname", "city", "state", "country",
    "personid1", "personid2",
    "pageid",
]
CORRUPT_COLUMN = "_corrupt_record"
MESSAGE = StructType([StructField(n, StringType()) for n in MESSAGE_FIELDS])
ENVELOPE = StructType(
    MESSAGE.fields
    + [StructField("messages", ArrayType(MESSAGE)),
       StructField(CORRUPT_COLUMN, StringType())]
)

# Columns of a queue source that tell deliveries of one line apart.
QUEUE_COORDINATES = ("topic", "partition", "offset")
