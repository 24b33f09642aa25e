"""Merkle manifest of a dataset, with proofs by pointer jumping.

Rows are leaves. In each group leaves ascend by key; while several nodes remain, every two
consecutive ones (the last may be alone) become the hash of their digests. What remains is
the group's subroot, and the subroots, ordered by group, likewise give the root. Digests
are SHA-256, hashed as lowercase hex text.

``build`` writes, all in the shared folder:

* ``leaves``  one row a leaf: group, place in its group, leaves of the group, digest, carried columns;
* ``nodes``   one row a tree node below its subroot: group, level, place, digest of its sibling;
* ``tops``    one row a group: subroot, place among the groups, siblings towards the root.

``proofs`` then doubles distances: a node at a level divisible by 2^(j+1) holds the sibling
segment of its first 2^j levels and joins the node 2^j above, whose segment it appends.
After ceil(log2(height)) rounds every leaf holds its siblings up to its subroot, and those
of the subroot follow. Only nodes whose segments are asked for again are joined, so the
rounds' upper sides shrink from 1/2 to 1/4, 1/16, 1/256 of the leaves.

No group is gathered: places come from a range partitioning by (group, key), levels from
blocks of 32 nodes.

Defined results: a null group is a group of its own and the first; null keys come first in
their group; rows with equal keys are ordered by their digest, equal rows stay apart; an
empty table gives no rows. Columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourglass.llm.joins import join_measured
from hourglass.session import work_dir

#: Levels built from one block of nodes: 2 ** 5 = 32 nodes a block.
BLOCK_LEVELS = 5
#: Rows of an upper side that are broadcast at most, by their proven number and size.
BROADCAST_BYTES = 8 << 20


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts in a row."""
    return F.sha2(F.concat(*parts), 256)


def field(column: Column) -> Column:
    """``-`` for a null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return digest(*[field(c) for c in columns])


def _above(left: Column, right: Column) -> Column:
    """The hash of a run of two nodes, or of one whose second is null (hex text)."""
    return digest(left, F.coalesce(right, F.lit("")))


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def _shift(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def _stored(df: DataFrame, path: str) -> DataFrame:
    """Written and read again: later steps don't repeat earlier ones, whatever is lost."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _placed(leaves: DataFrame, folder: str) -> DataFrame:
    """``leaves`` (g, key, leaf, ...) with their place in the group, ``i``, and its leaves, ``n``."""
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = leaves.repartitionByRange(parts, "g", "key", "leaf").sortWithinPartitions("g", "key", "leaf")
    ordered = _stored(ordered.withColumn("at", F.monotonically_increasing_id()), f"{folder}/ordered")
    # Rows of a group are consecutive in each partition: one row a (partition, group).
    runs = ordered.groupBy("g", F.shiftright("at", 33).alias("p")).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("run"))
    group = Window.partitionBy("g")
    before = group.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("g", "p", (F.coalesce(F.sum("run").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("run").over(group).alias("n"))
    told = join_measured(ordered.withColumn("p", F.shiftright("at", 33)), runs, ["g", "p"], "inner", F.col("at"))
    return told.withColumn("i", F.col("at") + F.col("shift")).drop("at", "p", "shift")


def _height(n: Column) -> Column:
    """Levels between the leaves and the top of ``n`` of them."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0).cast("int")


def build_tree(leaves: DataFrame, folder: str) -> tuple[DataFrame, DataFrame, int]:
    """Trees of ``leaves`` (g, i, n, leaf): their nodes below the top (g, level, i, sibling),
    one top a group (g, n, top), and the greatest height."""
    spark = leaves.sparkSession
    now = leaves.select("g", "i", "n", _height(F.col("n")).alias("h"), F.col("leaf").alias("d"))
    tallest = leaves.agg(F.max(_height(F.col("n")))).first()[0]
    if tallest is None:
        return (spark.createDataFrame([], "g string, level int, i bigint, sibling binary"),
                spark.createDataFrame([], "g string, n bigint, top string"), 0)
    below, tops = [], []
    for level in range(0, max(tallest, 1), BLOCK_LEVELS):
        blocks = now.groupBy("g", "n", "h", F.shiftright("i", BLOCK_LEVELS).alias("b")).agg(
            F.array_sort(F.collect_list(F.struct("i", "d"))).alias("a"))
        blocks = blocks.withColumn("a0", F.col("a.d")).drop("a")
        for k in range(BLOCK_LEVELS):
            blocks = blocks.withColumn(f"a{k + 1}", _next_level(F.col(f"a{k}")))
        # The digests of a block's last level go on to the next round, which gives their siblings.
        rows = F.concat(*[_node_rows(F.col(f"a{k}"), k, level + k) for k in range(BLOCK_LEVELS + 1)])
        every = _stored(blocks.select("g", "n", "h", F.inline(rows)), f"{folder}/nodes-{level:03d}")
        top = level + BLOCK_LEVELS
        below.append(every.where((F.col("level") < F.col("h")) & (F.col("level") < top))
                     .select("g", "level", "i", "sibling"))
        tops.append(every.where(F.col("level") == F.col("h")).select("g", "n", F.col("d").alias("top")))
        now = every.where((F.col("level") == top) & (F.col("h") > top)).select("g", "i", "n", "h", "d")
    return reduce(DataFrame.unionByName, below), reduce(DataFrame.unionByName, tops), tallest


def _next_level(a: Column) -> Column:
    """The digests above those of a block, left to right."""
    count = F.floor((F.size(a) + 1) / 2).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda j: _above(F.get(a, j * 2), F.get(a, j * 2 + 1)))


def _node_rows(a: Column, k: int, level: int) -> Column:
    """Rows of a block's nodes at its k-th level; none beyond the group's top."""
    rows = F.transform(a, lambda d, j: F.struct(
        F.lit(level).alias("level"), (F.col("b") * (1 << (BLOCK_LEVELS - k)) + j).alias("i"),
        F.unhex(F.get(a, j.bitwiseXOR(F.lit(1)))).alias("sibling"),
        F.when((F.col("h") == level) | F.lit(k == BLOCK_LEVELS), d).alias("d")))
    return F.when(F.col("h") >= level, rows).otherwise(F.filter(rows, lambda x: F.lit(False)))


def siblings_to_top(nodes: DataFrame, height: int, n_leaves: int, n_groups: int, folder: str) -> DataFrame:
    """(g, i, siblings) for every leaf below a top: a binary per level, null where there is none."""
    held = nodes.select("g", "level", "i", F.array("sibling").alias("segment"))
    j = 0
    while (1 << j) < height:
        step = 1 << j
        lower = held.where(F.col("level") % (2 * step) == 0)
        upper = held.where(F.col("level") % (2 * step) == step).select(
            "g", (F.col("level") - step).alias("level"), F.col("i").alias("above"), F.col("segment").alias("more"))
        # Levels step, 3 * step, ...: at most so many nodes, each with step siblings.
        most = sum(n_leaves // (1 << k) + n_groups for k in range(step, height, 2 * step))
        if most * (64 + 48 * step) <= BROADCAST_BYTES:
            upper = F.broadcast(upper)
        held = lower.withColumn("above", F.shiftright("i", step) if step < 63 else F.lit(0).cast("bigint")) \
            .join(upper, ["g", "level", "above"], "left").select(
                "g", "level", "i",
                F.concat("segment", F.coalesce("more", F.array().cast("array<binary>"))).alias("segment"))
        held = _stored(held, f"{folder}/jump-{j:02d}")
        j += 1
    return held.where(F.col("level") == 0).select("g", "i", F.col("segment").alias("siblings"))


def fold(leaf: Column, siblings: Column, place: Column) -> Column:
    """The top that a leaf's digest and its siblings give (hex text)."""
    steps = F.transform(siblings, lambda s, k: F.struct(
        _hex(s).alias("s"), (_shift(place, k) % 2 == 1).alias("second")))
    return F.aggregate(steps, leaf, lambda d, x: F.when(x["s"].isNull(), digest(d))
                       .when(x["second"], digest(x["s"], d)).otherwise(digest(d, x["s"])))


def proof_digest(*siblings: Column) -> Column:
    """The hash of all siblings of a proof, level by level."""
    every = F.filter(F.concat(*siblings), lambda s: s.isNotNull())
    return F.sha2(F.array_join(F.transform(every, _hex), ""), 256)


def prove(docs: DataFrame, key: Column, group: Column, leaf: Column, folder: str | None = None,
          carry: Sequence[Column] = ()) -> DataFrame:
    """The manifest of ``docs``: one row a document with ``key, leaf, subroot, root``, its
    proof (``siblings`` to the subroot with its place ``i``, ``top_siblings`` to the root with
    the subroot's place ``top_i``) and the columns in ``carry``."""
    spark: SparkSession = docs.sparkSession
    folder = folder or work_dir(spark, "merkle")
    # "0" is the null group: before all others, which begin with "1".
    g = F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))
    leaves = _stored(docs.select(g.alias("g"), key.alias("key"), leaf.alias("leaf"), F.struct(
        F.lit(0).alias("_"), *carry).alias("carried")), f"{folder}/hashed")
    leaves = _stored(_placed(leaves, f"{folder}/placed"), f"{folder}/leaves")
    nodes, tops, height = build_tree(leaves, f"{folder}/tree")
    tops = _stored(tops, f"{folder}/tops")
    n_groups, n_leaves = tops.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    below = siblings_to_top(nodes, height, n_leaves, n_groups, f"{folder}/jumps")

    # The subroots are the leaves of one more tree.
    ordered = _placed(tops.select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("top").alias("leaf")),
                      f"{folder}/top-placed")
    ordered = _stored(ordered, f"{folder}/top-leaves")
    top_nodes, roots, top_height = build_tree(ordered, f"{folder}/top-tree")
    above = siblings_to_top(top_nodes, top_height, n_groups, 1, f"{folder}/top-jumps")
    none = F.array().cast("array<binary>")
    root = roots.select(F.col("g").alias("_one"), F.col("top").alias("root"))       # a single row
    subroots = ordered.join(above, ["g", "i"], "left").join(
        F.broadcast(root), F.col("g") == F.col("_one")).select(
            F.col("key").alias("g"), F.col("leaf").alias("subroot"), F.col("i").alias("top_i"),
            F.coalesce("siblings", none).alias("top_siblings"), "root")
    subroots = _stored(subroots, f"{folder}/subroots")

    proved = leaves.join(below, ["g", "i"], "left").withColumn("siblings", F.coalesce("siblings", none))
    proved = join_measured(proved, subroots, ["g"], "inner", F.col("i"), most=BROADCAST_BYTES)
    names = [c for c in leaves.schema["carried"].dataType.names if c != "_"]
    return proved.select("key", "leaf", "subroot", "root", "i", "siblings", "top_i", "top_siblings",
                         *[F.col("carried")[c].alias(c) for c in names])
