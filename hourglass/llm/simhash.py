"""SimHash near-duplicates by bit-sliced comparison.

Each text gets a 64-bit fingerprint: the bitwise majority of the XXH64 values of its
word shingles. Equal fingerprints form one class. The 64 bits are cut into blocks such that
two fingerprints within the radius agree on at least one choice of blocks (pigeonhole), and
classes that agree on a choice meet in a bucket. Inside a bucket the fingerprints are
stored as bit planes, one machine word holding a bit of 64 of them; a query's distance to
all of them is counted plane by plane with carry-save counters, and a block of comparisons
is abandoned once every counter exceeds the radius. A bucket passes on a spanning forest of
its links, never all pairs. Buckets above ``TILE`` members are cut into tiles, and every
pair of tiles meets, so no link is lost and no task holds a whole hot bucket.

Defined results: a null text is an empty one; texts without words have fingerprint zero
and link like any other; null ids are kept and take part in links, but a component is named
by its smallest id (null if it has none); rows with an id that occurs twice are rows of
their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hourglass.llm.components import components
from hourglass.llm.joins import join_measured
from hourglass.llm.shared_files import ship_package

SEED = 42
TILE = 2048
QUERIES_AT_ONCE = 256


def fingerprint(text: str | None, shingle: int = 4, seed: int = SEED) -> int:
    """The fingerprint of a whole text, unsigned."""
    from xxhash import xxh64_intdigest

    # Bytes: lower() then changes A-Z only, and split() cuts at 0x20 and 0x09-0x0D only.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), seed)
    parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    hashes = np.fromiter((xxh64_intdigest(p, seed) for p in parts), "<u8", len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fingerprint) of ``docs`` (doc_id, text); the fingerprint's bits as a long."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], "<u8")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view("<i8"))],
                                             ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id long, fingerprint long")


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """(64, words) of uint64: bit j of word w of plane p is bit p of print 64 w + j."""
    width = -(-len(prints) // 64) * 64
    padded = np.zeros(width, "<u8")
    padded[:len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _exceeds(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Bits of counters whose count is above the radius."""
    above, equal = np.zeros_like(over), ~np.zeros_like(over)
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal = equal & ~counters[k]
    return above | over


def within(queries: np.ndarray, planes: np.ndarray, n: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query index, block index) of all pairs at most ``radius`` bits apart."""
    width = planes.shape[1]
    live = np.arange(len(queries))
    asked = np.where((queries[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1), ~np.uint64(0), np.uint64(0))
    # Planes on which the block and all queries agree cannot add to a distance.
    full = np.full(width, ~np.uint64(0))
    if n % 64:
        full[-1] = np.uint64((1 << (n % 64)) - 1)
    zero, one = (planes == 0).all(1), (planes == full).all(1)
    same = (zero & (asked == 0).all(0)) | (one & (asked != 0).all(0))
    order = np.flatnonzero(~same)
    counters = [np.zeros((len(queries), width), np.uint64) for _ in range(max(radius.bit_length(), 1))]
    over = np.zeros((len(queries), width), np.uint64) | ~full
    for step in range(0, len(order), 2):
        pair = order[step:step + 2]
        x = planes[pair[0]] ^ asked[live, pair[0]][:, None]
        if len(pair) == 2:   # carry-save: ones + x + y -> ones, twos
            y = planes[pair[1]] ^ asked[live, pair[1]][:, None]
            ones = counters[0]
            half = ones ^ x
            carry = (ones & x) | (half & y)
            counters[0] = half ^ y
        else:
            carry = counters[0] & x
            counters[0] = counters[0] ^ x
        for k in range(1, len(counters)):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if step % 8 == 6:
            kept = (~_exceeds(counters, over, radius)).any(1)
            if not kept.any():
                return np.empty(0, np.int64), np.empty(0, np.int64)
            if kept.sum() < 0.75 * len(kept):
                live, over = live[kept], over[kept]
                counters = [c[kept] for c in counters]
    hit = ~_exceeds(counters, over, radius)
    bits = np.unpackbits(np.ascontiguousarray(hit).view(np.uint8), axis=1, bitorder="little")
    q, b = np.nonzero(bits[:, :n])
    return live[q], b


def forest(members: np.ndarray, other: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``members``, or between them and ``other``."""
    block = members if other is None else other
    nodes = members if other is None else np.concatenate((members, other))
    shift = 0 if other is None else len(members)
    planes, label = bit_planes(block), np.arange(len(nodes))
    for at in range(0, len(members), QUERIES_AT_ONCE):
        q, b = within(members[at:at + QUERIES_AT_ONCE], planes, len(block), radius)
        i, j = q + at, b + shift
        i, j = i[i != j], j[i != j]
        while len(i):   # least label of each link's ends, to the roots, until none changes
            a, b2 = label[i], label[j]
            if (a == b2).all():
                break
            least = np.minimum(a, b2)
            np.minimum.at(label, a, least)
            np.minimum.at(label, b2, least)
            while (label[label] != label).any():
                label = label[label]
    inner = np.flatnonzero(label != np.arange(len(nodes)))
    return [(int(nodes[k]), int(nodes[label[k]])) for k in inner]


def block_choices(n_classes: int, radius: int) -> list[list[tuple[int, int]]]:
    """Choices of bit ranges (first bit, bits), one of which any near pair agrees on.

    radius + m blocks, any m of them: the more classes, the larger m and the longer the keys.
    """
    m = 1 if n_classes <= 1 << 24 else 2 if n_classes <= 1 << 32 else 3
    k = radius + m
    cuts = [64 * i // k for i in range(k + 1)]
    ranges = [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [list(c) for c in combinations(ranges, m)]


def bucket_keys(print_: Column, choices: list[list[tuple[int, int]]]) -> Column:
    keys = []
    for number, ranges in enumerate(choices):
        key = F.lit(0).cast("long")
        for first, bits in ranges:
            part = F.shiftrightunsigned(print_, first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
            key = F.shiftleft(key, bits).bitwiseOR(part)
        keys.append(F.struct(F.lit(number).alias("choice"), key.alias("key")))
    return F.array(*keys)


def links(classes: DataFrame, radius: int, folder: str, tile: int = TILE) -> DataFrame:
    """(a, b): links of ``classes`` (fingerprint) whose components are those of all links."""
    spark = classes.sparkSession
    ship_package(spark)
    choices = block_choices(classes.count(), radius)
    keyed = classes.select("fingerprint", F.inline(bucket_keys(F.col("fingerprint"), choices)))
    counts = keyed.groupBy("choice", "key").agg(F.count("*").alias("n"))
    counts.where("n > 1").write.mode("overwrite").parquet(f"{folder}/buckets")
    buckets = spark.read.schema("choice int, key long, n long").parquet(f"{folder}/buckets")
    hot = buckets.where(F.col("n") > tile).select("choice", "key", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    parts = join_measured(keyed, hot, ["choice", "key"], "left", F.col("fingerprint"))
    own = F.pmod(F.xxhash64("fingerprint", "choice"), F.coalesce("tiles", F.lit(1))).cast("int")
    placed = parts.withColumn("own", own).select(
        "choice", "key", "fingerprint", "own",
        F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1)).alias("with")).select(
        "choice", "key", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"),
        F.col("own"), "fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        found: list[tuple[int, int]] = []

        def close() -> None:
            rows = np.concatenate(held)
            own, prints = rows[:, 0], np.ascontiguousarray(rows[:, 1]).view("<u8")
            if key[2] == key[3]:
                if len(prints) > 1:
                    found.extend(forest(prints, None, radius))
            else:
                low, high = prints[own == key[2]], prints[own == key[3]]
                if len(low) and len(high):
                    found.extend(forest(low, high, radius))

        def out() -> pa.RecordBatch:
            pairs = np.array(found, "<u8").reshape(-1, 2).view("<i8")
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            table = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype("<i8") for k in range(6)], 1)
            if not len(table):
                continue
            keys = table[:, :4]
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(table)], strict=True):
                if key != tuple(keys[a]):
                    if held:
                        close()
                    held, key = [], tuple(keys[a])
                held.append(table[a:b, 4:])
            if len(found) > 50_000:
                yield out()
        if held:
            close()
        yield out()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["choice", "key", "low", "high"]
    return placed.repartition(n, *order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long")


def groups(prints: DataFrame, folder: str, radius: int, tile: int = TILE) -> DataFrame:
    """(fingerprint, component, component_id) of the classes with several rows or a link.

    ``prints``: doc_id, fingerprint, a stored table; ``folder``: shared scratch.
    """
    spark = prints.sparkSession
    prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")) \
        .write.mode("overwrite").parquet(f"{folder}/classes")
    classes = spark.read.schema("fingerprint long, least long, n long").parquet(f"{folder}/classes")
    found = components(links(classes, radius, folder, tile), f"{folder}/components")
    named = join_measured(classes, found.withColumnRenamed("node", "fingerprint"), ["fingerprint"], "left", F.col("fingerprint")) \
        .where("n > 1 or component is not null").withColumn("component", F.coalesce("component", "fingerprint"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return join_measured(named.select("fingerprint", "component"), least, ["component"], "inner", F.col("fingerprint")) \
        .select("fingerprint", "component", "component_id")


def near_duplicates(docs: DataFrame, folder: str, shingle: int = 4, radius: int = 4, tile: int = TILE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of ``docs`` (doc_id, text); ``folder``: shared scratch."""
    spark = docs.sparkSession
    fingerprints(docs, shingle).write.mode("overwrite").parquet(f"{folder}/fingerprints")
    prints = spark.read.schema("doc_id long, fingerprint long").parquet(f"{folder}/fingerprints")
    # A row outside all groups is named by its own id.
    members = groups(prints, folder, radius, tile).select("fingerprint", "component_id", F.lit(True).alias("grouped"))
    return join_measured(prints, members, ["fingerprint"], "left", F.coalesce("doc_id", F.lit(0))).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one_each(docs: DataFrame, folder: str, shingle: int = 4, radius: int = 4, tile: int = TILE) -> DataFrame:
    """``docs`` with one row of each group, all columns as they are.

    The row with the group's smallest id stays; of several with that id (or of a group
    without ids) the least row by its columns in order. Other columns may have any name.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field(place).to_pylist()
            prints = np.array([fingerprint(t, shingle) for t in texts], "<u8")
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(prints.view("<i8"))], ["row", "fingerprint"])

    schema = StructType([*rows.schema.fields, StructField("fingerprint", LongType())])
    rows.mapInArrow(run, schema).write.mode("overwrite").parquet(f"{folder}/rows")
    stored = spark.read.schema(schema).parquet(f"{folder}/rows")
    id_of = F.col("row.doc_id").cast("long")
    found = groups(stored.select(id_of.alias("doc_id"), "fingerprint"), folder, radius, tile)
    found.write.mode("overwrite").parquet(f"{folder}/groups")
    members = spark.read.schema("fingerprint long, component long, component_id long").parquet(f"{folder}/groups")
    known = join_measured(stored, members, ["fingerprint"], "left", F.xxhash64("row"))
    alone = known.where("component is null").select("row")
    one = known.where(F.col("component").isNotNull() & id_of.eqNullSafe(F.col("component_id"))) \
        .groupBy("component").agg(F.min("row").alias("row")).select("row")
    return alone.unionAll(one).select("row.*")
