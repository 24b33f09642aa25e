"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks.

Words are runs of letters and digits in lower case; a text is the sequence of its 5-word
shingles (an item of fewer words is one shingle). For each benchmark item, windows with as
many shingles as the item are cut from the documents at every common shingle: one starts
there, and one ends there. Any other window is no more like the item than one of them, as it
moves to the next common shingle without losing one. A window whose common shingles, counted
from above, cannot reach the least similarity is dropped. Each other window gets a 64-bit
SimHash. Two fingerprints within ``radius`` bits agree on one of radius + 1 blocks, so
equal (item, block, value) finds every pair within the radius; the exact weighted similarity of
the shingles (sum of least over sum of greatest counts) decides. At a similarity of 0.8 some 10
of 64 bits differ and up to 20 do, and blocks that allow as many are narrow: by themselves they
would let most pairs of any window and any item through. So a window is looked up only under the
item it was cut for, and candidates grow with the windows, not with windows times items.

Everything is DataFrame expressions in one pass over the documents, without a shuffle of
them: the benchmark's index is broadcast in slices of at most ``SLICE_BYTES`` by measured
size, one pass for each slice.

Defined results: null and wordless texts match nothing; a document shorter than an item is
one window; documents with null ids count as one; repeated rows give one result; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.joins import join_measured

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 20
SLICE_BYTES = 64 << 20
SCHEMA = "doc_id long, item_id long, similarity double, distance int, start_word int"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles_of(words: Column, k: int) -> Column:
    """Hashes of the k-word shingles in order; ``words`` must be a column, not an expression."""
    count = F.greatest(F.size(words) - (k - 1), F.lit(0))
    return F.transform(F.slice(words, F.lit(1), count),
                       lambda w, i: F.xxhash64(w, *(F.get(words, i + j) for j in range(1, k))))


def simhash(shingles: Column) -> Column:
    """The bitwise majority of a column of shingle hashes."""
    # A second parameter of the inner lambda, even one with a default, would be the element's place.
    ones = lambda b: F.size(F.filter(shingles, lambda h: F.getbit(h, F.lit(b)) == 1))
    bits = [F.when(2 * ones(b) > F.size(shingles), F.lit((1 << b) - ((1 << 64) if b == 63 else 0)))
            .otherwise(F.lit(0)).cast("long") for b in range(64)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def blocks_of(fingerprint: Column, radius: int) -> list[Column]:
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
            for a, b in zip(cuts, cuts[1:], strict=False)]


def block_rows(fingerprint: Column, radius: int) -> Column:
    return F.array(*(F.struct(F.lit(i).alias("block"), v.alias("value"))
                     for i, v in enumerate(blocks_of(fingerprint, radius))))


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of least over sum of greatest counts of the shingles of two columns."""
    count = lambda array, x: F.size(F.filter(array, lambda y: y == x))
    common = F.aggregate(F.array_distinct(b), F.lit(0), lambda acc, x: acc + F.least(count(a, x), count(b, x)))
    return common / (F.size(a) + F.size(b) - common)


def items_of(benchmark: DataFrame, shingle: int) -> DataFrame:
    """(item_id, k, item, print): shingles and fingerprint of each item with words."""
    words = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text")).alias("words")) \
        .where(F.size("words") > 0)
    sized = words.withColumn("k", F.least(F.size("words"), F.lit(shingle)))
    own = F.col("words")
    item = F.lit(None).cast("array<bigint>")
    for k in range(1, shingle + 1):
        item = F.when(F.col("k") == k, shingles_of(own, k)).otherwise(item)
    shingled = sized.select("item_id", "k", item.alias("item"))
    return shingled.withColumn("print", simhash(F.col("item")))


def windows(docs: DataFrame, items: DataFrame, k: int, similarity: float) -> DataFrame:
    """(doc_id, key, start, window): item-sized windows at common shingles that can reach the
    similarity, each with the item's key that it was cut for."""
    distinct = items.withColumn("own", F.array_distinct("item"))
    index = distinct.select(item_key().alias("key"), F.explode("own").alias("h"), "item", F.size("own").alias("n_own"))
    found = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    hashed = found.select("doc_id", shingles_of(F.col("words"), k).alias("all"))
    # The outer form keeps the optimizer from computing the shingles once more to drop empty ones.
    places = hashed.select("doc_id", "all", F.posexplode_outer("all").alias("at", "h"))
    hits = places.join(F.broadcast(index), "h")     # a slice of measured size
    size, last, at = F.size("item"), F.size("all"), F.col("at")
    place = lambda i: F.get("all", i)
    common = lambda i: F.coalesce(F.array_contains("item", place(i)), F.lit(False))
    between = lambda a, b: F.arrays_overlap(F.slice("all", a + 1, F.greatest(b - a, F.lit(0))), F.col("item"))
    final = F.greatest(last - size, F.lit(0))
    # The final window counts at its first common shingle. A window that gains the common shingle it loses is the one before.
    same = common(at - 1) & F.coalesce(place(at - 1) == place(at + size - 1), F.lit(False))
    starts = F.when(at > final, ~between(final, at)).otherwise(~same)
    # The window that ends here, if none starts at the same place; the first one counts at its last common shingle.
    first = F.greatest(at - size + 1, F.lit(0))
    ends = (last > size) & ~common(first) & ((at >= size - 1) | ~between(at + 1, size))
    sides = F.array(F.struct(F.least(at, final).alias("start"), starts.alias("cut")),
                    F.struct(first.alias("start"), ends.alias("cut")))
    cut = hits.select("doc_id", "key", "all", "item", "n_own", F.inline(sides)).where("cut").select(
        "doc_id", "key", "item", "n_own", size.alias("size"), "start", F.slice("all", F.col("start") + 1, size).alias("window"))
    # Common shingles, repeated ones of the item as if all were in the window.
    most = F.size(F.array_intersect("window", "item")) + F.col("size") - F.col("n_own")
    least = similarity / (1 + similarity) * (F.col("size") + F.size("window"))
    return cut.where(most >= least - 1e-6).select("doc_id", "key", "start", "window")


def item_key() -> Column:
    """An item's id as a key that is never null (a clash only costs a comparison)."""
    return F.coalesce("item_id", F.lit(-(1 << 63)).cast("long"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY,
               radius: int = RADIUS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, item_id, similarity, distance, start_word): items that documents hold.

    ``docs``: doc_id, text; ``benchmark``: item_id, text. One row for each pair, of its most
    similar window.
    """
    spark = docs.sparkSession
    items = items_of(benchmark, shingle)
    sizes = items.groupBy("k").agg(F.sum(F.size("item").cast("long") * (F.size("item") + 6) * 8).alias("n")).collect()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = spark.range(0).select(*(F.lit(None).cast(kind).alias(name) for name, kind in map(str.split, SCHEMA.split(", "))))
    for row in sorted(sizes, key=lambda r: r.k):      # as many rows as shingle lengths
        slices = -(-row.n // slice_bytes)
        for s in range(slices):
            own = items.where((F.col("k") == row.k) & (F.pmod(F.xxhash64("item_id"), F.lit(slices)) == s))
            found = found.unionByName(_leaks(windows(docs, own, row.k, similarity), own, similarity, radius))
    return found.groupBy("doc_id", "item_id").agg(
        F.max_by(F.struct("similarity", "distance", "start_word"),
                 F.struct("similarity", -F.col("distance"), -F.col("start_word"))).alias("best")).select("doc_id", "item_id", "best.*")


def candidates(cut: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """Windows and the items they were cut for that agree on a block, a row for each such block.

    The item is part of the index's key: another item that the window resembles has
    windows of its own at their common shingles, so nothing is lost, and windows meet no
    more items than they share shingles with.
    """
    printed = cut.withColumn("own", simhash(F.col("window")))
    probes = printed.select("*", F.inline(block_rows(F.col("own"), radius)))
    index = items.select("item_id", item_key().alias("key"), "item", "print", F.inline(block_rows(F.col("print"), radius)))
    return join_measured(probes, index, ["key", "block", "value"], "inner", F.col("doc_id"))


def _leaks(cut: DataFrame, items: DataFrame, similarity: float, radius: int) -> DataFrame:
    distance = F.bit_count(F.col("own").bitwiseXOR(F.col("print")))
    # A pair that agrees on several blocks counts at the first.
    first = reduce(lambda acc, i: F.when(i[1], F.lit(i[0])).otherwise(acc),
                   reversed([(i, a == b) for i, (a, b) in enumerate(zip(blocks_of(F.col("own"), radius),
                                                                       blocks_of(F.col("print"), radius), strict=True))]),
                   F.lit(-1))
    near = candidates(cut, items, radius).where((distance <= radius) & (F.col("block") == first)).select(
        "doc_id", "item_id", "window", "item", distance.cast("int").alias("distance"), F.col("start").cast("int").alias("start_word"))
    # The generator keeps the similarity from being computed once more for the condition on it.
    measured = near.select("doc_id", "item_id", "distance", "start_word", F.inline(F.array(F.struct(
        weighted_similarity(F.col("window"), F.col("item")).alias("similarity")))))
    return measured.where(F.col("similarity") >= similarity).select(
        "doc_id", "item_id", "similarity", "distance", "start_word")


def without_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """``docs`` without the documents named in ``leaks`` (best a stored table); null ids stay."""
    named = leaks.where("doc_id is not null").select("doc_id").distinct()
    return join_measured(docs, named, ["doc_id"], "left_anti", F.xxhash64("text"))
