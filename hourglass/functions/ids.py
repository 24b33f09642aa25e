"""Person ids, gender, number parsing and the union discriminator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourglass import schemas as S

# Fixed value: person ids with this prefix are cookies, others numeric user ids.
COOKIE_PREFIX = "cookie"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def person_id(s: Column | str) -> Column:
    """``struct<cookie, user_id>`` from a person id string (NULL if neither)."""
    c = _col(s)
    is_cookie = c.startswith(COOKIE_PREFIX)
    uid = F.lit(None).cast("bigint")
    parsed = parse_long(c)
    return (
        F.when(c.isNull(), F.lit(None).cast(S.PERSON_ID))
        .when(is_cookie, F.struct(c.alias("cookie"), uid.alias("user_id")))
        .when(parsed.isNotNull(),
              F.struct(F.lit(None).cast("string").alias("cookie"), parsed.alias("user_id")))
    )


def is_person_id(s: Column | str) -> Column:
    """True when ``person_id`` would accept the string (cheap, no struct)."""
    c = _col(s)
    return F.coalesce(c.startswith(COOKIE_PREFIX) | parse_long(c).isNotNull(), F.lit(False))


def gender(s: Column | str) -> Column:
    """'MALE' stays MALE, any other non-NULL value is FEMALE."""
    c = _col(s)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(c == "MALE", "MALE").otherwise("FEMALE")


def parse_long(s: Column | str) -> Column:
    """Decimal string -> BIGINT, NULL when it does not parse (no exception)."""
    return F.col(s).try_cast("bigint") if isinstance(s, str) else s.try_cast("bigint")


def parse_int(s: Column | str) -> Column:
    return F.col(s).try_cast("int") if isinstance(s, str) else s.try_cast("int")


def dataunit_id(person_property: Column | str, page_property: Column | str,
                equiv: Column | str, page_view: Column | str) -> Column:
    """Which union branch of a data unit is set (1..4), NULL when none."""
    return (
        F.when(_col(page_view).isNotNull(), S.PAGE_VIEW)
        .when(_col(equiv).isNotNull(), S.EQUIV)
        .when(_col(page_property).isNotNull(), S.PAGE_PROPERTY)
        .when(_col(person_property).isNotNull(), S.PERSON_PROPERTY)
    )
