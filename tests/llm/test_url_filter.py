"""URL filters: base rules, pattern rules against running every expression, edge cases."""

import re

import pytest

from hourglass.llm import queries, url_filter as U
from hourglass.llm.joins import join_measured

URLS = [None, "", "no-scheme/x", "http://", "https://A.EXAMPLE.com/en/1", "http://www.example.com/en/", "http://www.example.com/EN/",
        "http://x.www.example.com/en/a?b#c", "ftp://h.net/es/2", "ftp://h.net/es", "ftp://net/fr/", "http://org.net?x=/fr/",
        "http://adult.org/", "http://adult-education.org/a", "http://xadult.org/", "http://a.org/porncentral", "http://b.org/wp-login.php",
        "http://b.org/wp-login.php?x", "http://ads.tracker.org/", "http://myads.tracker.org/", "http://c.org/calendar/1/day/",
        "http://d.org/setup.EXE", "http://é.org/poker/ü", "x://y://adult/", "http://spam-filter.org/spam", "http://com/", "http://a.org\n/xxx/"] \
    + ["http://long.org/" + "a/" * 40000 + "casino"]


def brute_pattern(pattern):
    body = pattern.removeprefix("||") if pattern.startswith("||") else pattern.removeprefix("|")
    body = body.removesuffix("|")
    out = "".join(".*" if c == "*" else "(?:^|[^a-z0-9]|$)" if c == "^" else re.escape(c) for c in body)
    lead = r"^[^:/?#]*://(?:[^/?#]*\.)?" if pattern.startswith("||") else "^" if pattern.startswith("|") else ""
    return re.compile(lead + out + (r"\Z" if pattern.endswith("|") else ""), re.S)


def brute(url, rules=U.PATTERN_RULES):
    low = (url or "").translate(str.maketrans(U.UPPER, U.LOWER))
    head, mark, rest = (url or "").partition("://")
    host = re.split("[/?#]", rest, maxsplit=1)[0] if mark else ""
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0] if mark else ""
    host = host.translate(str.maketrans(U.UPPER, U.LOWER))
    fit = [(len(h + p), h + p, v) for v, h, p in U.BASE_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, max(fit)[1], max(fit)[2]
    hits = {v for v, p in rules if url is not None and brute_pattern(p).search(low)}
    return host, path, None, "allow" if "allow" in hits or not hits else "block"


@pytest.mark.parametrize("most", [1 << 25, 0])
def test_against_every_rule(spark, monkeypatch, most):
    monkeypatch.setattr(U, "join_measured", lambda *a: join_measured(*a, most=most))
    rows = [(i, u, "h", "v", 0) for i, u in enumerate(URLS)] + [(None, URLS[12], "", "", 1), (3, URLS[12], "", "", 2), (3, URLS[12], "", "", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string, token int")
    got = U.judge_urls(pages, U.BASE_RULES, U.rules_frame(spark, U.PATTERN_RULES)).collect()
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=str) \
        == sorted(((r[0], *brute(r[1])) for r in rows), key=str)


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/adult")], "page_id long, url string")
    none = U.rules_frame(spark, [("block", "x")]).limit(0)
    assert U.judge_urls(pages, (), none).first().verdict == "allow"
    assert U.judge_urls(pages.limit(0), U.BASE_RULES, none).count() == 0


def test_rarest_token(spark):
    urls = spark.createDataFrame([(f"http://a.org/common/{i}",) for i in range(9)] + [("http://a.org/common/rare",)], "url string")
    index = U.token_index(U.rules_frame(spark, [("block", "^common^rare^"), ("block", "wild*"), ("block", "^common^unseen^")]), urls)
    assert {r.pattern: r.token for r in index.collect()} == {"^common^rare^": "rare", "wild*": "", "^common^unseen^": "unseen"}


def test_query_against_sql(spark, oracle, rows_of):
    sf = "/root/testdata/sf0.01"
    assert rows_of(queries.QUERIES["op9_url_filter"](spark, sf)) == oracle(queries.ORACLES["op9_url_filter"], sf)


def test_the_plan_reads_pages_once_more(spark):
    from hourglass.plans import inspect
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    judged = U.judge_urls(pages, U.BASE_RULES, U.rules_frame(spark, U.PATTERN_RULES))
    # The URLs were read and stored before; what is left reads the pages once and the stored hits.
    read = [line for line in inspect.plan_text(judged).splitlines() if line.startswith("Location:")]
    assert sum("pages.parquet" in line for line in read) == 1 and len(read) == 2
