"""Repair of conversation structure by a generalised LR parser with weighted edits.

The roles of a conversation must read ``(s?(ua)+)?`` by their initials. The grammar's
item sets give an LR automaton; ``RoleParser`` keeps a graph-structured stack whose equal
tops are merged by the least (cost, audit). Against each row a top may delete it, keep it
(shift its role), rerole it or, before it and at the end, insert an empty row; the audit is
the edits' initials in order, and of equal costs the least audit wins.

The merged tops are few and what can follow a top depends on nothing else, so a run of
rows is a small table (top before, top after) -> (cost, audit). Rows are dealt by ranges of
(conversation, turn), cut into blocks of bounded rows and bytes, and each block gives its
table; a conversation's tables are then folded in order, with the hash of the repaired text
running along. A conversation of any length is read in blocks by many tasks, and the task
that folds it holds one block at a time, but for the audit itself.

Defined results: null roles and texts are one space; a null conversation is one; null turns
come first; rows of equal turns are ordered by role, then by their text's digest; an empty
table gives no rows. A conversation none of whose rows are ``there`` has zeros and an empty
audit. Columns not named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.joins import join_measured
from hourglass.llm.shared_files import ship_package
from hourglass.session import work_dir

#: A conversation is nothing, or an optional system row and turns of user and assistant.
GRAMMAR = {"C": [(), ("P",), ("s", "P")], "P": [("u", "a"), ("P", "u", "a")]}
ROLES = {"u": "user", "a": "assistant"}
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_COST = 1

BLOCK_ROWS = 512
BLOCK_BYTES = 1 << 20
SPACE = " \t\n\x0b\x0c\r"


# --- the automaton ---------------------------------------------------------------------------

def lr_table(grammar: dict[str, list[tuple[str, ...]]], start: str):
    """SLR automaton: step(stack, token) -> stacks after the reductions that the token allows
    and its shift; accepts(stack)."""
    rules = [("", (start,))] + [(a, body) for a, bodies in grammar.items() for body in bodies]

    def closure(items):
        found, todo = set(items), list(items)
        while todo:
            r, dot = todo.pop()
            body = rules[r][1]
            for k, (a, _) in enumerate(rules):
                if dot < len(body) and a == body[dot] and (k, 0) not in found:
                    found.add((k, 0))
                    todo.append((k, 0))
        return frozenset(found)

    states, goto = [closure({(0, 0)})], {}
    for n, items in enumerate(states):          # grows while it is walked
        for x in {rules[r][1][d] for r, d in items if d < len(rules[r][1])}:
            to = closure({(r, d + 1) for r, d in items if d < len(rules[r][1]) and rules[r][1][d] == x})
            if to not in states:
                states.append(to)
            goto[n, x] = states.index(to)

    nullable = {a for a, body in rules if not body}
    first: dict[str, set] = {}
    follow: dict[str, set] = {"": {"$"}}
    changed = True
    while changed:
        before = str((sorted((k, sorted(v)) for k, v in first.items()), sorted((k, sorted(v)) for k, v in follow.items())))
        for a, body in rules:
            if all(x in nullable for x in body):
                nullable.add(a)
            for i, x in enumerate(body):
                heads = lambda y: first.get(y, set()) if y in grammar else {y}
                if all(y in nullable for y in body[:i]):
                    first.setdefault(a, set()).update(heads(x))
                if x in grammar:
                    rest = body[i + 1:]
                    for j, y in enumerate(rest):
                        if all(z in nullable for z in rest[:j]):
                            follow.setdefault(x, set()).update(heads(y))
                    if all(y in nullable for y in rest):
                        follow.setdefault(x, set()).update(follow.get(a, set()))
        changed = before != str((sorted((k, sorted(v)) for k, v in first.items()),
                                 sorted((k, sorted(v)) for k, v in follow.items())))

    def reduced(stack, token):
        """All stacks that reductions before ``token`` lead to, the stack itself too."""
        found, todo = {stack}, [stack]
        while todo:
            top = todo.pop()
            for r, dot in states[top[-1]]:
                a, body = rules[r]
                if r and dot == len(body) and token in follow.get(a, ()):
                    under = top[:len(top) - len(body)]
                    if (to := (*under, goto[under[-1], a])) not in found:
                        found.add(to)
                        todo.append(to)
        return found

    def step(stack, token):
        return {(*x, goto[x[-1], token]) for x in reduced(stack, token) if (x[-1], token) in goto}

    def accepts(stack):
        return any((0, 1) in states[x[-1]] for x in reduced(stack, "$"))

    return step, accepts


class RoleParser:
    """Merged stack tops of the grammar and the weighted edits on them."""

    def __init__(self, grammar=GRAMMAR, start: str = "C", tokens: str = "sua"):
        step, accepts = lr_table(grammar, start)
        # All sets of stacks that some row of tokens leads to, then those told apart by what follows.
        tops, moves = [frozenset({(0,)})], []
        for top in tops:
            to = {t: frozenset(y for x in top for y in step(x, t)) for t in tokens}
            moves.append({t: y for t, y in to.items() if y})
            tops += [y for y in moves[-1].values() if y not in tops]
        kind = [any(map(accepts, top)) for top in tops]
        while True:
            sign = [(kind[n], tuple((t, kind[tops.index(y)]) for t, y in sorted(moves[n].items()))) for n in range(len(tops))]
            order = list(dict.fromkeys(sign))
            finer = [order.index(x) for x in sign]
            if len(set(finer)) == len(set(kind)):
                break
            kind = finer
        self.tops = range(len(set(finer)))
        self.shift = [{} for _ in self.tops]
        for n, to in enumerate(moves):
            self.shift[finer[n]].update({t: finer[tops.index(y)] for t, y in to.items()})
        self.accepting = {finer[n] for n, top in enumerate(tops) if any(map(accepts, top))}
        self.start = finer[0]
        #: The one role that an inserted or reroled row takes at a top.
        self.made = [[t for t in ROLES if t in to] for to in self.shift]
        if any(len(x) != 1 for x in self.made):
            raise ValueError("the grammar leaves the made role open")

    def inserts(self, front: dict[int, tuple[int, str]]) -> dict[int, tuple[int, str]]:
        """The tops that any number of inserted rows leads to."""
        front, todo = dict(front), sorted(front)
        while todo:
            top = todo.pop()
            cost, audit = front[top]
            to, new = self.shift[top][self.made[top][0]], (cost + COSTS["I"], audit + "I")
            if to not in front or new < front[to]:
                front[to] = new
                todo.append(to)
        return front

    def row(self, front: dict[int, tuple[int, str]], initial: str, fault: int) -> dict[int, tuple[int, str]]:
        """The tops after one row (fault 1 blank, 2 duplicate, 3 truncated, else 0)."""
        out: dict[int, tuple[int, str]] = {}

        def put(to, cost, audit):
            if to not in out or (cost, audit) < out[to]:
                out[to] = (cost, audit)

        extra = TRUNCATED_COST if fault == 3 else 0
        for top, (cost, audit) in self.inserts(front).items():
            put(top, cost + COSTS["D"], audit + "D")
            if fault in (1, 2):
                continue
            if initial in self.shift[top]:
                put(self.shift[top][initial], cost + COSTS["K"] + extra, audit + "K")
            put(self.shift[top][self.made[top][0]], cost + COSTS["R"] + extra, audit + "R")
        return out

    def replay(self, top: int, audit: str, roles: list[str], texts: list[str | None]) -> Iterator[tuple[str, str, str]]:
        """(role, text, edit) of the rows that an audit leaves."""
        at = 0
        for edit in audit:
            made = self.made[top][0]
            if edit == "I":
                yield ROLES[made], "", edit
                top = self.shift[top][made]
                continue
            if edit == "K":
                yield roles[at], texts[at], edit
                top = self.shift[top][roles[at][:1]]
            elif edit == "R":
                yield ROLES[made], texts[at], edit
                top = self.shift[top][made]
            at += 1


@cache
def parser() -> RoleParser:
    return RoleParser()


# --- blocks ------------------------------------------------------------------------------------

BLOCK_SCHEMA = ("g string, conv_id {id}, part int, seq long, first_role string, last_role string, first_turn long, "
                "last_turn long, min_turn long, n_turns long, blank long, duplicate long, truncated long, "
                "illegal long, edges array<struct<top:int,to:int,cost:long,audit:string>>, "
                "roles array<string>, texts array<string>")
LEGAL = {"su", "ua", "au"}


class Block:
    """Consecutive rows of one conversation."""

    def __init__(self, g, conv_id, seq, known_start: bool):
        p = parser()
        self.g, self.conv_id, self.seq = g, conv_id, seq
        tops = [p.start] if known_start else list(p.tops)
        self.fronts = {t: {t: (0, "")} for t in tops}
        self.roles, self.texts, self.bytes = [], [], 0
        self.counts = [0, 0, 0, 0]
        self.illegal = self.n_turns = 0
        self.first_turn = self.last_turn = self.min_turn = None

    def add(self, turn, role, text, fault):
        p = parser()
        if self.roles:
            self.illegal += self.roles[-1][:1] + role[:1] not in LEGAL
        else:
            self.first_turn = turn
        if turn is not None and (turn != self.last_turn or self.min_turn is None):
            self.n_turns += 1
            self.min_turn = turn if self.min_turn is None else self.min_turn
        self.last_turn = turn
        self.counts[fault] += 1
        text = None if fault in (1, 2) else text
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += 16 + len(text or "")
        self.fronts = {t: p.row(front, role[:1], fault) for t, front in self.fronts.items()}

    def full(self, rows: int) -> bool:
        return len(self.roles) >= rows or self.bytes >= BLOCK_BYTES

    def done(self, part: int) -> dict:
        edges = [{"top": t, "to": to, "cost": c, "audit": a} for t, front in self.fronts.items()
                 for to, (c, a) in front.items()]
        return {"g": self.g, "conv_id": self.conv_id, "part": part, "seq": self.seq,
                "first_role": self.roles[0] if self.roles else None, "last_role": self.roles[-1] if self.roles else None,
                "first_turn": self.first_turn, "last_turn": self.last_turn, "min_turn": self.min_turn,
                "n_turns": self.n_turns, "blank": self.counts[1], "duplicate": self.counts[2],
                "truncated": self.counts[3], "illegal": self.illegal, "edges": edges,
                "roles": self.roles, "texts": self.texts}


def cut_blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema, rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted rows; the first conversation of a partition may have begun before it."""
    part, seq, block, last, held, size = TaskContext.get().partitionId(), 0, None, None, [], 0
    seen_other = False
    for batch in batches:
        for r in batch.to_pylist():
            if block is None or block.g != r["g"] or block.full(rows):
                if block is not None:
                    seen_other = seen_other or block.g != r["g"]
                    held.append(block.done(part))
                    size += block.bytes
                    seq += 1
                # A conversation's first block, met inside the partition, starts at the grammar's start.
                fresh = seen_other and block.g != r["g"]
                block = Block(r["g"], r["conv_id"], seq, fresh)
                if size > 8 << 20 or len(held) >= 2000:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
            if r["there"]:
                key = (r["g"], r["turn"], r["role"], r["digest"])
                fault = r["fault"]
                if fault != 1 and (r["repeats"] or key == last):
                    fault = 2
                last = key
                block.add(r["turn"], r["role"], r["text"], fault)
    if block is not None:
        held.append(block.done(part))
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


class Fold:
    """The blocks of one conversation, in order."""

    def __init__(self, first: dict):
        self.g, self.conv_id = first["g"], first["conv_id"]
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.n_turns, self.min_turn, self.last_turn, self.last_role = 0, None, None, None
        # top -> cost, audit, hash of the repaired text, whether it has a row, edits of the blocks (linked)
        self.front = {parser().start: (0, "", hashlib.sha256(), False, None)}

    def _take(self, edges, roles, texts, at):
        p, best = parser(), {}
        for e in edges:
            if e["top"] in self.front:
                cost, audit = self.front[e["top"]][:2]
                found = (cost + e["cost"], audit + e["audit"], e["top"], e["audit"])
                if e["to"] not in best or found[:2] < best[e["to"]][:2]:
                    best[e["to"]] = found
        front = {}
        for to, (cost, audit, top, edits) in best.items():
            _, _, digest, some, link = self.front[top]
            digest = digest.copy()
            for role, text, _ in p.replay(top, edits, roles, texts):
                digest.update((("\n" if some else "") + f"{role}:{text}").encode())
                some = True
            front[to] = (cost, audit, digest, some, (link, {**at, "top": top, "audit": edits}))
        self.front = front

    def add(self, b: dict):
        for k in self.counts:
            self.counts[k] += b[k]
        if b["roles"]:
            if self.last_role is not None:
                self.counts["illegal"] += self.last_role[:1] + b["first_role"][:1] not in LEGAL
            self.n_turns += b["n_turns"] - (b["first_turn"] is not None and b["first_turn"] == self.last_turn)
            self.min_turn = b["min_turn"] if self.min_turn is None else self.min_turn
            self.last_turn, self.last_role = b["last_turn"], b["last_role"]
        self._take(b["edges"], b["roles"], b["texts"], {"part": b["part"], "seq": b["seq"]})

    def done(self) -> dict:
        p = parser()
        ends = [{"top": t, "to": to, "cost": c, "audit": a} for t in p.tops
                for to, (c, a) in p.inserts({t: (0, "")}).items()]
        self._take(ends, [], [], {"part": None, "seq": None})
        cost, audit, digest, _, link = min((x for t, x in self.front.items() if t in p.accepting), key=lambda x: x[:2])
        edits = []
        while link is not None:
            link, e = link
            edits.append(e)
        # Turns ascend after the nulls, so the last row has the greatest.
        gaps = 0 if self.min_turn is None else self.last_turn - self.min_turn + 1 - self.n_turns
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": cost, "audit": audit,
                "repaired_sha256": digest.hexdigest(), "g": self.g, "edits": edits[::-1]}


def fold_blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    fold, held, size = None, [], 0
    for batch in batches:
        for b in batch.to_pylist():
            if fold is None or fold.g != b["g"]:
                if fold is not None:
                    held.append(fold.done())
                    size += len(held[-1]["audit"])
                    if size > 4 << 20 or len(held) >= 5000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                fold = Fold(b)
            fold.add(b)
    if fold is not None:
        held.append(fold.done())
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


# --- the operator ------------------------------------------------------------------------------

def _arrow(schema: str, spark) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


class Repair:
    """The result of ``repair``: ``summary``, one row a conversation, and ``messages()``."""

    def __init__(self, summary: DataFrame, blocks: DataFrame):
        self.summary, self._blocks = summary, blocks

    def messages(self) -> DataFrame:
        """The repaired rows: (conv_id, place, role, text, edit), ``place`` ascending in order."""
        edits = self.summary.select("g", "conv_id", F.posexplode("edits")).select(
            "g", "conv_id", "pos", "col.part", "col.seq", "col.top", "col.audit")
        rows = edits.join(self._blocks.select("g", "part", "seq", "roles", "texts"), ["g", "part", "seq"], "left")
        kind = self.summary.schema["conv_id"].dataType.simpleString()
        out = f"conv_id {kind}, place struct<block:int,row:int>, role string, text string, edit string"
        arrow = _arrow(out, rows.sparkSession)

        def run(batches):
            for batch in batches:
                found = [{"conv_id": b["conv_id"], "place": {"block": b["pos"], "row": k}, "role": role, "text": text,
                          "edit": edit}
                         for b in batch.to_pylist()
                         for k, (role, text, edit) in enumerate(parser().replay(
                             b["top"], b["audit"], b["roles"] or [], b["texts"] or []))]
                if found:
                    yield pa.RecordBatch.from_pylist(found, arrow)

        return rows.drop("g", "part", "seq").mapInArrow(run, out)


def repair(rows: DataFrame, conv_id: Column, turn: Column, role: Column, text: Column,
           there: Column | None = None, folder: str | None = None, block_rows: int = BLOCK_ROWS) -> Repair:
    """Faults and cheapest repair of each conversation of ``rows``. Rows not ``there`` only name
    their conversation."""
    spark = rows.sparkSession
    ship_package(spark)
    folder = folder or work_dir(spark, "role-repair")
    there = F.lit(True) if there is None else there
    body = F.coalesce(text, F.lit(" "))
    last = F.substring(F.rtrim(body, F.lit(SPACE)), -1, 1)
    fault = F.when(last == "", 1).when(last.isin(".", "!", "?"), 0).otherwise(3)
    found = rows.select(
        F.coalesce(conv_id.cast("string"), F.lit(" ")).alias("g"), conv_id.alias("conv_id"), turn.cast("long").alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"), F.when(there, body).alias("text"),
        F.when(there, F.sha2(body, 256)).alias("digest"), F.when(there, fault).alias("fault"), there.alias("there"))
    # Texts that a role says again: the turn that says them first. Copies in that turn stand together.
    order = F.struct(F.col("turn").isNotNull(), "turn")
    again = found.where("there").groupBy("g", "role", "digest").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")
    flagged = join_measured(found, again, ["g", "role", "digest"], "left", F.col("turn")).withColumn(
        "repeats", F.coalesce(order > F.col("first"), F.lit(False))).drop("first")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["g", "turn", "role", "digest"]
    kind = rows.select(conv_id.alias("c")).schema["c"].dataType.simpleString()
    block_schema = BLOCK_SCHEMA.format(id=kind)
    arrow = _arrow(block_schema, spark)
    dealt = flagged.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    dealt.mapInArrow(lambda b: cut_blocks(b, arrow, block_rows), block_schema).write.mode("overwrite").parquet(f"{folder}/blocks")
    blocks = spark.read.schema(block_schema).parquet(f"{folder}/blocks")

    out_schema = (f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                  "audit string, repaired_sha256 string, g string, "
                  "edits array<struct<part:int,seq:long,top:int,audit:string>>")
    out_arrow = _arrow(out_schema, spark)
    summary = blocks.repartition(parts, "g").sortWithinPartitions("g", "part", "seq") \
        .mapInArrow(lambda b: fold_blocks(b, out_arrow), out_schema)
    return Repair(summary, blocks)
