"""Key/value encoding of the batch view: key = UTF-8 ``url/gran-bucket``,
value = 8-byte big-endian long."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the key layout "<url>/<granularity>-<bucket>" as a pattern
# (the url is everything before the last "/<g>-<n>", line breaks included).
KEY_PATTERN = r"(?s)^(.*)/([hdwm])-(-?[0-9]+)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucketed_key_string(url: Column | str, gran: Column | str, bucket: Column | str) -> Column:
    return F.concat(_col(url), F.lit("/"), _col(gran), F.lit("-"), _col(bucket).cast("string"))


def bucketed_key(url: Column | str, gran: Column | str, bucket: Column | str) -> Column:
    """UTF-8 bytes of ``url/gran-bucket``."""
    return F.encode(bucketed_key_string(url, gran, bucket), "UTF-8")


def serialize_long(n: Column | str) -> Column:
    """8-byte big-endian two's complement encoding of a BIGINT."""
    return F.unhex(F.lpad(F.hex(_col(n).cast("bigint")), 16, "0"))


def deserialize_long(b: Column | str) -> Column:
    """Inverse of ``serialize_long`` (two's complement, so negatives round-trip)."""
    return F.conv(F.hex(_col(b)), 16, -10).cast("bigint")


def key_url(key: Column | str) -> Column:
    return F.regexp_extract(F.decode(_col(key), "UTF-8"), KEY_PATTERN, 1)


def key_granularity(key: Column | str) -> Column:
    return F.regexp_extract(F.decode(_col(key), "UTF-8"), KEY_PATTERN, 2)


def key_bucket(key: Column | str) -> Column:
    return F.regexp_extract(F.decode(_col(key), "UTF-8"), KEY_PATTERN, 3).cast("bigint")
