"""ANSI/DuckDB SQL fragments for the oracle queries, stated apart from
the Spark expressions."""

from __future__ import annotations

from hourglass.sources import testdata as td


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def normalize_url_sql(expr: str) -> str:
    """URL normalization by cutting at delimiters, written without the pattern
    the Spark expression uses."""
    t = f"trim({expr}, chr(9) || chr(10) || chr(13) || ' ')"
    proto = f"lower(split_part({t}, '://', 1))"
    rest = f"substr({t}, strpos({t}, '://') + 3)"
    no_query = f"split_part(split_part({rest}, '#', 1), '?', 1)"
    authority = f"split_part({no_query}, '/', 1)"
    path = f"substr({no_query}, length({authority}) + 1)"
    place = f"list_extract(string_split({authority}, '@'), -1)"
    host, port = f"split_part({place}, ':', 1)", f"split_part({place}, ':', 2)"
    ok = (f"strpos({t}, '://') > 0 AND {proto} IN ('http', 'https', 'ftp') "
          f"AND ({port} = '' OR TRY_CAST({port} AS INTEGER) IS NOT NULL)")
    return f"(CASE WHEN {ok} THEN {proto} || '://' || {host} || {path} ELSE {expr} END)"


def pageview_rows_sql(coarse: bool = False) -> str:
    secs = "(epoch_us(e.ts) // 1000000)"
    if coarse:
        secs = f"({secs} // {td.COARSE_SECS} * {td.COARSE_SECS})"
    return f"""
    SELECT e.event_id,
           p.url || CASE WHEN e.event_id % 2 = 1 THEN '?article=1' ELSE '' END AS raw_url,
           CAST({secs} AS BIGINT) AS secs,
           CASE WHEN e.event_id % 3 = 0 THEN 'cookie_' || CAST(e.user_id AS VARCHAR)
                ELSE CAST(e.user_id AS VARCHAR) END AS personid
    FROM events e
    JOIN pages p ON ((e.event_id // 2) % (SELECT count(*) FROM pages)) = p.page_id
    WHERE e.event_type IN ('view', 'click')"""


def bad_url_rows_sql() -> str:
    """Error events of the last broken kind: syntactically fine pageviews whose
    URL does not parse (valid for the batch path)."""
    return """
    SELECT e.event_id,
           'bad url ' || CAST(e.user_id AS VARCHAR) AS raw_url,
           CAST(epoch_us(e.ts) // 1000000 AS BIGINT) AS secs,
           CAST(e.user_id AS VARCHAR) AS personid
    FROM events e WHERE e.event_type = 'error' AND e.event_id % 8 = 7"""


def person_rows_sql() -> str:
    return f"""
    WITH base AS (
      SELECT c.c_custkey AS id,
             CASE WHEN c.c_custkey % 2 = 0 THEN 'cookie_' || CAST(c.c_custkey AS VARCHAR)
                  ELSE CAST(c.c_custkey AS VARCHAR) END AS personid,
             CASE WHEN c.c_custkey % 7 = 0 THEN 'other'
                  WHEN c.c_custkey % 2 = 1 THEN 'MALE' ELSE 'FEMALE' END AS gendertype,
             c.c_name AS fullname, c.c_mktsegment AS city, n.n_name AS state,
             r.r_name AS country, CAST({td.BASE_SECS} + c.c_custkey AS BIGINT) AS secs
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                      JOIN region r ON n.n_regionkey = r.r_regionkey)
    SELECT * FROM base
    UNION ALL
    SELECT id, personid, gendertype, fullname || '-v2', city, state, country,
           CAST({td.LATER_SECS} + id AS BIGINT)
    FROM base WHERE id % 5 = 0"""


def equiv_rows_sql() -> str:
    return """
    SELECT CAST(user_id AS VARCHAR) AS personid1,
           'cookie_' || CAST(user_id AS VARCHAR) AS personid2,
           CAST(min(epoch_us(ts) // 1000000) AS BIGINT) AS secs
    FROM events GROUP BY user_id"""


def page_rows_sql() -> str:
    return f"""
    SELECT url, CAST(1 + page_id % 2 AS VARCHAR) AS pageview,
           CAST({td.BASE_SECS} + page_id AS BIGINT) AS secs
    FROM pages"""


def granularity_rollup_sql(hourly: str, count_col: str = "n") -> str:
    """UNION ALL of the four granularities over a relation (url, h, n)."""
    parts = []
    for g, b in [("h", "h"), ("d", "h // 24"), ("w", "h // 24 // 7"), ("m", "h // 24 // 28")]:
        parts.append(f"SELECT url, '{g}' AS granularity, CAST({b} AS BIGINT) AS bucket, "
                     f"CAST(sum({count_col}) AS BIGINT) AS total_pageviews "
                     f"FROM {hourly} GROUP BY 1, 2, 3")
    return "\nUNION ALL\n".join(parts)
