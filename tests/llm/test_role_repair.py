"""Role repair against trying every edit, block by block and whole; damage, hashes, edge cases."""

import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hourglass.llm import role_repair as R
from hourglass.llm.queries import QUERIES

LEGAL_ROLES = re.compile("(s?(ua)+)?")


def shortest(rows):
    """Least (cost, audit, repaired) over all edits, by search over role initials."""
    # The initials so far matter only by what may follow: kept whole here, cut to what the pattern tells apart.
    def tail(done):
        return "" if not done else "s" if done == "s" else done[-1]

    front = {"": (0, "", ())}
    nexts = {"": "su", "s": "u", "u": "a", "a": "u"}

    def put(out, t, x):
        if t not in out or x[:2] < out[t][:2]:
            out[t] = x

    def inserted(front):
        front = dict(front)
        for _ in range(3):
            for t, (c, a, done) in list(front.items()):
                for x in "ua":
                    if x in nexts[t]:
                        put(front, x, (c + 2, a + "I", done + (({"u": "user", "a": "assistant"}[x], ""),)))
        return front

    for role, text, fault in rows:
        out = {}
        for t, (c, a, done) in inserted(front).items():
            put(out, t, (c + 3, a + "D", done))
            if fault in (1, 2):
                continue
            extra = fault == 3
            if role[:1] and role[:1] in nexts[t]:
                put(out, tail(role[:1]) if t == "" else role[:1], (c + extra, a + "K", done + ((role, text),)))
            for x in "ua":
                if x in nexts[t]:
                    put(out, x, (c + 2 + extra, a + "R", done + (({"u": "user", "a": "assistant"}[x], text),)))
        front = out
    front = inserted(front)
    return min((front[t] for t in ("", "a") if t in front), key=lambda x: x[:2])


def every_edit(rows):
    """All edit sequences with at most two inserts in a row, without any automaton."""
    done = [(0, "", ())]
    for role, text, fault in [*rows, (None, None, None)]:
        grown = list(done)
        for _ in range(2):
            done = [(c + 2, a + "I", r + ((x, ""),)) for c, a, r in done for x in ("user", "assistant")]
            grown += done
        if role is None:
            done = grown
            break
        done = []
        for c, a, r in grown:
            done.append((c + 3, a + "D", r))
            if fault not in (1, 2):
                done.append((c + (fault == 3), a + "K", r + ((role, text),)))
                done += [(c + 2 + (fault == 3), a + "R", r + ((x, text),)) for x in ("user", "assistant")]
    return min(x for x in done if LEGAL_ROLES.fullmatch("".join(role[:1] or "-" for role, _ in x[2])))


ROW = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", " "]), st.just("t."), st.sampled_from([0, 0, 0, 1, 2, 3]))


@settings(max_examples=40, deadline=None)
@given(st.lists(ROW, max_size=3))
def test_search_against_every_edit(rows):
    assert shortest(rows)[:2] == every_edit(rows)[:2] and shortest(rows)[2] == every_edit(rows)[2]


def folded(rows, size):
    fold = None
    for k in range(0, max(len(rows), 1), size):
        b = R.Block("g", 1, k, False)
        for i, (role, text, fault) in enumerate(rows[k:k + size]):
            b.add(k + i, role, text, fault)
        done = b.done(0)
        fold = fold or R.Fold(done)
        fold.add(done)
    return fold.done()


@settings(max_examples=300, deadline=None)
@given(st.lists(ROW, max_size=14), st.integers(1, 5))
def test_blocks_against_search(rows, size):
    cost, audit, done = shortest(rows)
    got = folded(rows, size)
    text = "\n".join(f"{r}:{t}" for r, t in done)
    assert (got["cost"], got["audit"]) == (cost, audit)
    assert got["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert got["illegal"] == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))


def test_tops_of_the_grammar():
    p = R.parser()
    assert len(p.tops) == 4 and len(p.accepting) == 2 and p.start in p.accepting


def plain(table):
    """The query's rows, one conversation at a time."""
    out, talks = [], {}
    for r in table:
        talks.setdefault(r[0], []).append(r)
    for conv, rows in talks.items():
        kept = []
        for conv_id, turn, role, text in rows:
            code = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv_id, turn)).encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if code == 0:
                continue
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            kept += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in kept:
            body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append(1 if not body else 2 if (role, text) in seen else 0 if body[-1] in ".!?" else 3)
            seen.add((role, text))
        cost, audit, done = shortest([(role, text, f) for (_, role, text), f in zip(kept, faults)])
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in done)
        out.append((conv, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, place string, g int"


def rows_of(df):
    return sorted(map(str, [tuple(r[c] for c in COLUMNS) for r in df.collect()]))


def test_query_on_the_test_table(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert rows_of(QUERIES["op13_role_repair"](spark, sf)) == sorted(map(str, plain([tuple(r) for r in table])))


@pytest.fixture(scope="module")
def odd_rows():
    roles = ["system", "user", "assistant", "tool", "", None, "Ué"]
    texts = ["Yes.", "no", None, "", " \t\x0b", "again!", "again!", "x" * 70_000 + "?", "é。", "wait? \n"]
    rows = []
    for conv in [None, 0, 1, 2, 3]:
        for k in range(60):
            rows.append((conv, None if k % 13 == 5 else k * (1 + (conv or 0) % 2) - 9, roles[(k * 7 + (conv or 4)) % 7],
                         texts[(k * 3 + k // 9) % 10], "p", k))
    rows += rows[40:55] + [(7, 1, "user", "Only?", "p", 1), (8, None, None, None, None, None)]
    return rows + [(k, 0, "user", "hi.", "", 0) for k in range(100, 160)]


def test_odd_tables(spark, workdir, odd_rows):
    """Nulls, ties, repeats, long texts, dropped conversations, clashing columns; blocks of any size."""
    from pyspark.sql import functions as F

    from hourglass.llm.queries import damaged_conversations
    table = spark.createDataFrame(odd_rows, SCHEMA).repartition(4)
    table.write.parquet(f"{workdir}/conversations.parquet")
    want = sorted(map(str, plain([r[:4] for r in odd_rows])))
    assert rows_of(QUERIES["op13_role_repair"](spark, workdir)) == want
    c = F.col
    small = R.repair(damaged_conversations(table), c("conv_id"), c("turn"), c("role"), c("text"), c("there"), block_rows=3)
    assert rows_of(small.summary) == want


def test_messages_are_the_hashed_text(spark, workdir, odd_rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(odd_rows, SCHEMA)
    found = R.repair(docs, F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text"))
    want = {r.conv_id: (r.repaired_sha256, r.audit.replace("D", "")) for r in found.summary.collect()}
    talks = {}
    for r in sorted(found.messages().collect(), key=lambda r: r.place):
        talks.setdefault(r.conv_id, []).append(r)
    for conv, (digest, edits) in want.items():
        rows = talks.get(conv, [])
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in rows).encode()).hexdigest() == digest
        assert "".join(r.edit for r in rows) == edits


def test_empty_table(spark, workdir):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{workdir}/conversations.parquet")
    assert QUERIES["op13_role_repair"](spark, workdir).collect() == []
