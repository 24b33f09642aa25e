"""URL filters: host and path rules, then pattern rules found by their rarest token.

Host and path rules decide first: a rule fits its host and all subdomains when the
path starts with the rule's, the longest rule wins. Other URLs are judged by pattern
rules. A pattern is plain text with ``*`` (anything), ``^`` (one character that is no
ASCII letter or digit, or an end of the URL), a leading ``||`` (start of the host or of
one of its labels) and ``|`` at either end (start or end of the URL); patterns are in
lower case and A-Z of the URL count as lower case. Each rule is indexed by the one of
its literal tokens that the fewest URLs hold. The tokens of a URL fetch candidate
rules, and only those run their regular expressions. Without a whole literal token a
rule is a candidate for every URL. A URL that an ``allow`` pattern fits is allowed, else
one that a ``block`` pattern fits is blocked, else it is allowed. The distinct URLs that no
base rule decides, and what the patterns found, are written once to the shared folder and
read from there.

Defined results: a null URL, or one without ``://``, has an empty host and path; no
pattern rule sees a null URL; null ids, repeated rows and empty tables are kept as they
are; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.joins import join_measured
from hourglass.session import work_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Verdict, host and path of the base rules.
BASE_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
              ("block", "net", "/es/"), ("block", "net", "/fr/"))

#: Pattern rules of the production query.
PATTERN_RULES = (
    ("block", "^adult^"), ("block", "^casino^"), ("block", "^gambling^"), ("block", "^malware^"),
    ("block", "^phishing^"), ("block", "^pills^"), ("block", "^poker^"), ("block", "^porn*"),
    ("block", "^spam^"), ("block", "^torrent^"), ("block", "^viagra^"), ("block", "^warez^"), ("block", "^xxx^"),
    ("block", "||ads.*"), ("block", "||doubleclick.*"), ("block", "/wp-login.php|"), ("block", "^sessionid=*"),
    ("block", "/calendar/*/day/"), ("block", "*.exe|"), ("allow", "^adult^education^"), ("allow", "||spam^filter."),
)


def lowered(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return lowered(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def base_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def pattern_table(rules: DataFrame) -> DataFrame:
    """(rule_id, verdict, regex, tokens) of ``rules`` (verdict, pattern)."""
    p = F.col("pattern")
    body = F.regexp_replace(F.regexp_replace(p, r"^\|\|?", ""), r"\|$", "")
    quoted = F.regexp_replace(body, r"([\\.+?()\[\]{}|$/\-])", r"\\$1")
    regex = F.regexp_replace(F.regexp_replace(quoted, r"\^", "(?:^|[^a-z0-9]|\\$)"), r"\*", ".*")
    lead = F.when(p.startswith("||"), F.lit(r"^[^:/?#]*://(?:[^/?#]*\.)?")).when(p.startswith("|"), F.lit("^")) \
        .otherwise(F.lit(""))
    ended = F.concat(F.when(p.startswith("|"), F.lit("|")).otherwise(F.lit("*")), body,
                     F.when(p.endswith("|"), F.lit("|")).otherwise(F.lit("*")))
    tail = F.when(p.endswith("|"), F.lit(r"\z")).otherwise(F.lit(""))
    # A run of letters and digits is a whole token of every URL that fits, unless it
    # meets a wildcard or an open end of the pattern.
    tokens = F.regexp_extract_all(ended, F.lit("(?<![a-z0-9*])([a-z0-9]+)(?![a-z0-9*])"), F.lit(1))
    return rules.dropDuplicates(["verdict", "pattern"]).select(
        F.xxhash64("verdict", "pattern").alias("rule_id"), "verdict", "pattern",
        F.concat(F.lit("(?s)"), lead, regex, tail).alias("regex"), F.array_distinct(tokens).alias("tokens"))


def url_tokens(urls: DataFrame) -> DataFrame:
    """(url, token) for the tokens of each URL, and the empty token of all."""
    found = F.regexp_extract_all(lowered(F.col("url")), F.lit("([a-z0-9]+)"), F.lit(1))
    return urls.select("url", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), found))).alias("token"))


def token_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """(token, verdict, pattern, regex): each rule under its token that the fewest URLs hold.

    Ties go to the longer and then to the first token.
    """
    table = pattern_table(rules)
    listed = table.select("rule_id", F.explode_outer("tokens").alias("token"))
    asked = listed.where("token is not null").select("token").distinct()
    held = join_measured(url_tokens(urls), asked, ["token"], "left_semi", F.col("url")) \
        .groupBy("token").agg(F.count("*").alias("n"))
    rarest = (listed.join(held, "token", "left")
              .groupBy("rule_id").agg(F.min_by("token", F.struct(
                  F.coalesce("n", F.lit(0)), -F.length("token"), "token")).alias("token")))
    return (table.join(rarest, "rule_id")
            .select(F.coalesce("token", F.lit("")).alias("token"), "verdict", "pattern", "regex"))


def stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pattern_hits(urls: DataFrame, rules: DataFrame, folder: str) -> DataFrame:
    """(url, _verdict, patterns) of the distinct URLs that any pattern rule fits."""
    distinct = stored(urls.select("url").where("url is not null").distinct(), f"{folder}/urls")
    index = token_index(rules, distinct)
    candidates = join_measured(url_tokens(distinct), index, ["token"], "inner", F.col("url"))
    fits = candidates.where(F.rlike(lowered(F.col("url")), F.col("regex")))
    return stored(fits.groupBy("url").agg(
        F.min("verdict").alias("_verdict"),                 # allow sorts before block
        F.sort_array(F.collect_set("pattern")).alias("patterns")),   # at most the rules there are
        f"{folder}/hits")


def judge_urls(pages: DataFrame, base_rules: Sequence[tuple[str, str, str]], pattern_rules: DataFrame,
               folder: str | None = None) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, patterns) of ``pages`` (page_id, url)."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = base_rule(F.col("host"), F.col("path"), base_rules)
    ruled = split.withColumns({"rule": rule, "verdict": verdict})
    hits = pattern_hits(ruled.where("rule is null"), pattern_rules, folder or work_dir(pages.sparkSession, "url-filter"))
    judged = join_measured(ruled, hits, ["url"], "left", F.col("page_id"))
    return judged.select(
        "page_id", "url", "host", "path", "rule",
        F.coalesce("verdict", "_verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.coalesce("patterns", F.array().cast("array<string>")))
        .otherwise(F.array().cast("array<string>")).alias("patterns"))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, pattern string")
