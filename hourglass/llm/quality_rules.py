"""Quality rules: fixed base rules, and a decision list learned from labelled statistics.

Statistics are DataFrame expressions over whole texts. The list is learned by sequential
covering: a rule grows by adding the threshold condition with the largest information
gain on one part of the labelled rows, is pruned on the other part by dropping its last
conditions while that does not lower its worth there, and is kept if it is precise enough.
Rows it covers are set aside and the next rule is grown. The ordered rules become one
Spark conditional expression.

Learning takes a bounded sample of labelled rows' statistics (``SAMPLE_ROWS``); all else
runs over all rows, inside Spark's own functions.

Defined results: a null text has no words (all statistics 0, base failed); null ids and
repeated rows are kept; an empty table gives no rows; without labelled rows the list is
empty, and every text that passes the base rules is kept; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words, symbols, and the base rules' limits.
WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50

#: Most labelled rows whose statistics are gathered to learn from.
SAMPLE_ROWS = 6000
MOST_RULES = 12
MOST_CONDITIONS = 4
THRESHOLDS = 40
LEAST_PRECISION = 0.97
LEAST_COVERED = 3

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_marks", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words")
FEATURES = ("n_words", "word_length", "symbol_rate", "mark_rate", "upper_rate", "dup_line_rate", "repeat_rate")


def text_statistics(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, statistics, features) of ``docs`` (doc_id, text); ``keep``: columns to pass on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    first = docs.select(
        "doc_id", *keep,
        F.array_remove(F.split(text, WHITE), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "").alias("_lines"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, "[^!?]+", "")).cast("long").alias("n_marks"),
        F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_upper"))
    words = F.col("_words")
    n = F.size(words)
    windows = F.transform(F.slice(words, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda w, i: F.struct(
        F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    counted = first.select(
        "doc_id", *keep, "n_symbols", "n_marks", "n_upper", n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(windows).alias("_windows"))
    w = F.col("_windows")
    # Equal windows are neighbours once sorted.
    again = F.filter(w, lambda x, k: (F.get(w, k - 1)["h"] == x["h"]) | (F.get(w, k + 1)["h"] == x["h"]))
    repeated = counted.withColumn("_again", again).drop("_windows")
    places = F.flatten(F.transform("_again", lambda x: F.sequence(x["i"], x["i"] + 2)))
    whole = repeated.withColumn("n_repeat_words", F.size(F.array_distinct(places)).cast("long"))
    # The generator keeps a filter on the statistics from being pushed below it, where the
    # optimizer would write their expressions into one another.
    full = whole.select("doc_id", *keep, F.inline(F.array(F.struct(*STATISTICS))))
    rate = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return full.withColumns({
        "word_length": rate("word_chars", "n_words"), "symbol_rate": rate("n_symbols", "n_words"),
        "mark_rate": rate("n_marks", "n_words"), "upper_rate": rate("n_upper", "word_chars"),
        "dup_line_rate": rate("n_dup_lines", "n_lines"), "repeat_rate": rate("n_repeat_words", "n_words")})


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:g}"

    def column(self) -> Column:
        return F.col(self.feature) >= self.threshold if self.above else F.col(self.feature) < self.threshold


Rule = tuple[Condition, ...]


def _candidates(rows: list[dict], features: tuple[str, ...], most: int) -> list[tuple[Condition, int]]:
    """Threshold conditions at quantiles, each with the set of rows it holds for (bits of an int)."""
    out = []
    for f in features:
        values = sorted({r[f] for r in rows})
        step = max(1, len(values) // most)
        cuts = {float(f"{(a + b) / 2:.3g}") for a, b in zip(values, values[1:], strict=False)} if len(values) <= most \
            else {float(f"{values[k]:.3g}") for k in range(step, len(values), step)}
        for cut in sorted(cuts):
            above = 0
            for i, r in enumerate(rows):
                if r[f] >= cut:
                    above |= 1 << i
            out += [(Condition(f, True, cut), above), (Condition(f, False, cut), ((1 << len(rows)) - 1) ^ above)]
    return out


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    """Information gain of a condition: positives still covered times bits saved for each."""
    (p0, n0), (p1, n1) = before, after
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 else -1.0


def learn(rows: list[dict], label: str = "bad", features: tuple[str, ...] = FEATURES,
          most_rules: int = MOST_RULES, precision: float = LEAST_PRECISION) -> list[Rule]:
    """An ordered list of rules that cover rows whose ``label`` is true.

    Every third row prunes, the others grow; ties go to the first condition in order.
    """
    if not rows:
        return []
    conditions = _candidates(rows, features, THRESHOLDS)
    positive = sum(1 << i for i, r in enumerate(rows) if r[label])
    left = (1 << len(rows)) - 1
    prune = sum(1 << i for i in range(2, len(rows), 3))
    found: list[Rule] = []
    while len(found) < most_rules:
        grow = left & ~prune
        covered, rule, sets = grow, [], []
        while len(rule) < MOST_CONDITIONS and covered & ~positive:
            before = ((covered & positive).bit_count(), (covered & ~positive).bit_count())
            best, best_gain = None, 1e-9
            for c, held in conditions:
                both = covered & held
                gain = _gain(before, ((both & positive).bit_count(), (both & ~positive).bit_count())) if before[0] else -1
                if gain > best_gain:
                    best, best_gain = (c, held), gain
            if best is None:
                break
            rule.append(best[0])
            sets.append(best[1])
            covered &= best[1]
        if not rule:
            break

        def worth(k: int, part: int) -> tuple[float, int, int]:
            for held in sets[:k]:
                part &= held
            p, n = (part & positive).bit_count(), (part & ~positive).bit_count()
            return (p - n) / max(p + n, 1), p, n

        k = max(range(1, len(rule) + 1), key=lambda k: (worth(k, left & prune)[0], -k))
        _, p, n = worth(k, left)
        if p < LEAST_COVERED or p / (p + n) < precision:
            if k < len(rule):     # the whole rule may still do
                k = len(rule)
                _, p, n = worth(k, left)
            if p < LEAST_COVERED or p / (p + n) < precision:
                break
        found.append(tuple(rule[:k]))
        gone = left
        for held in sets[:k]:
            gone &= held
        left &= ~gone
    return found


def learn_from(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from at most ``sample_rows`` labelled rows (quality 0 or 1) that pass the base rules.

    Labels are chosen evenly by the hash of their id, the first ones in its order; every one
    of a smaller table. The same tables always give the same rows.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", "quality")
    every = max(1, -(-known.count() // sample_rows))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0) \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows)
    some = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")   # at most sample_rows ids
    rows = text_statistics(some, ("quality",)).where(~base_failed()) \
        .select("doc_id", *FEATURES, (F.col("quality") == 0).alias("bad")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "bad", *FEATURES).limit(2 * sample_rows).collect()
    return learn([r.asDict() for r in rows])


def verdict(rules: list[Rule]) -> Column:
    """The first rule that holds, as text; null where none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        holds = rule[0].column()
        for c in rule[1:]:
            holds = holds & c.column()
        out = F.when(holds, F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Statistics, base verdict, the rule that rejects and the final verdict of each text."""
    judged = text_statistics(docs).withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
