"""Quality rules: statistics against plain Python, the learner, verdicts on labels."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hourglass.llm import quality_rules as Q, queries

TEXTS = [None, "", " \t\n", "a b c a b c", "a b c\nd\na b c\n\n \nd", "#a *b $$% &|<> é", "x\x0by\x0cz\rw", "one\ntwo\none",
         "a a a a", "a b c x a b c y z", "é " * 60, "w1 w2 w3 " * 30000, " lead  and trail ", "a\x85b c d", "A! B!! c?"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    places = {i + k for i, x in enumerate(windows) if counts[x] > 1 for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(places), n < 50 or 100 * len(places) > 50 * n)


def test_statistics(spark):
    rows = [(i, t, 1, "r") for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], 2, "r"), (4, TEXTS[4], 1, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, rule string")
    got = Q.judge(docs, []).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    assert Q.judge(docs.limit(0), []).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op8_quality_rules"](spark, sf).collect()
    assert {r.doc_id: tuple(r)[1:7] for r in got} == {k: brute(t) for k, t in texts.items()}
    assert all(not (r.kept and r.base_failed) and r.kept == (not r.base_failed and r.rule is None) for r in got)


def test_learner_finds_planted_conjunctions():
    own = random.Random(5)
    rows = []
    for _ in range(3000):
        r = {f: own.random() for f in Q.FEATURES}
        r["bad"] = (r["symbol_rate"] > 0.8 and r["upper_rate"] < 0.5) or r["repeat_rate"] > 0.9
        rows.append(r)
    rules = Q.learn(rows, precision=0.9)
    holds = lambda r: any(all((r[c.feature] >= c.threshold) == c.above for c in rule) for rule in rules)
    fresh = [{f: own.random() for f in Q.FEATURES} for _ in range(2000)]
    right = sum(holds(r) == ((r["symbol_rate"] > 0.8 and r["upper_rate"] < 0.5) or r["repeat_rate"] > 0.9) for r in fresh)
    assert right > 1900 and 2 <= len(rules) <= Q.MOST_RULES
    assert Q.learn([]) == [] and Q.learn([{**rows[0], "bad": False}]) == []


def test_verdicts_agree_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op8_quality_rules"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where(~F.col("base_failed"))
    rows = got.select("quality", "kept").collect()
    clean = [r for r in rows if r.quality == 1]
    assert sum(r.kept for r in clean) > 0.97 * len(clean)
    junk = [r for r in rows if r.quality == 0]
    assert sum(not r.kept for r in junk) > 0.8 * len(junk)


def test_the_sample_does_not_depend_on_the_partitions(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    one, other = (Q.learn_from(docs, labels.repartition(n, *by), 400) for n, by in ((3, ["doc_id"]), (7, ["quality", "doc_id"])))
    assert one and one == other
