"""Range cuts from the whole table: the same rows are dealt alike, however they are partitioned.

``repartitionByRange`` cuts by a sample, which changes with the input's partitions. Here the
bytes of ever finer ranges of the key are summed over all rows (only ranges that hold more
than a share are split further), so cuts depend on the rows alone, and are exact up to one
key; rows of a key that holds more than a share are split by their digest.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shards grow with the square root of the bytes: many small ones, or fewer of some GB.
SHARD_UNIT, MOST_SHARDS = 1 << 16, 1 << 16
#: Ranges of the first pass, and parts of a heavy one in each further pass.
FIRST_RANGES, PARTS = 1024, 16
LOWEST = -(1 << 63)


def shards_for(n_bytes: int) -> int:
    return max(1, min(MOST_SHARDS, math.isqrt(max(n_bytes, 0) // SHARD_UNIT)))


def _array(values: list, kind: str = "bigint") -> Column:
    """A list as one literal."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def place_of(value: Column, bounds: list, kind: str = "bigint") -> Column:
    """How many of the sorted ``bounds`` are at most ``value``: two short searches."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    block = F.size(F.filter(_array(bounds[::step], kind), lambda b: b <= value))      # the bounds before it all are
    before = F.greatest((block - 1) * step, F.lit(0))
    inside = F.slice(_array(bounds, kind), before + 1, F.lit(step))
    return before + F.size(F.filter(inside, lambda b: b <= value))


def range_cuts(rows: DataFrame, shards: int) -> list[tuple[int, int]]:
    """Cuts (key, digest part) of ``rows`` (key long without nulls, n_bytes): at most about
    ``shards`` pieces of like bytes, and one more for each cut beside a heavy key."""
    lo, hi, total = rows.agg(F.min("key"), F.max("key"), F.sum("n_bytes")).first()
    if lo is None or shards <= 1:
        return []
    share = total / shards
    width = -(-(hi - lo + 1) // FIRST_RANGES)
    starts = [*range(lo, hi + 1, width)]
    weights: dict[int, int] = {}
    ends = dict(zip(starts, [*starts[1:], hi + 1]))
    todo = starts
    while todo:
        # Only rows of the ranges in ``todo`` are summed; their number is bounded by the shards'.
        at = F.col("key")
        lasts = _array([ends[s] - 1 for s in todo])
        inside = rows.withColumn("p", place_of(at, todo)).where(at <= F.get(lasts, F.col("p") - 1))
        sums = {r.p: r.n for r in inside.groupBy("p").agg(F.sum("n_bytes").alias("n")).collect()}
        weights.update({s: sums.get(k + 1, 0) for k, s in enumerate(todo)})
        heavy = [s for s in todo if weights[s] > share and ends[s] - s > 1]
        todo = []
        for s in heavy:
            end, step = ends[s], -(-(ends[s] - s) // PARTS)
            parts = [*range(s, end, step)]
            ends.update(zip(parts, [*parts[1:], end]))
            todo += parts
    cuts, filled = [], 0.0
    for s in sorted(weights):
        n = weights[s]
        if n > share and ends[s] - s == 1:      # one key: pieces by digest
            pieces = math.ceil(n / share)
            cuts += [(s, -(-(k << 32) // pieces)) for k in range(pieces)]
            if s < hi:
                cuts.append((s + 1, 0))
            filled = 0.0
            continue
        if filled and filled + n > share:
            cuts.append((s, 0))
            filled = 0.0
        filled += n
    return sorted({c for c in cuts if c > (lo, 0)})


def shard_of(key: Column, digest: Column, cuts: list[tuple[int, int]]) -> Column:
    """The piece a row falls in; ``digest`` is hexadecimal text."""
    part = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    pairs = [{"key": k, "part": p} for k, p in cuts]
    return place_of(F.struct(key.alias("key"), part.alias("part")), pairs, "struct<key:bigint,part:bigint>").cast("int")
