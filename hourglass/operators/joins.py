"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A query-side list (URLs and their bounds) is broadcast only up to this many
# rows and bytes of URLs; beyond, the join falls back to a shuffle join (AQE may
# still pick a broadcast at runtime from real sizes).
DEFAULT_BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def bounded_list(urls: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``urls`` (url) has at most ``max_rows`` rows and ``max_bytes`` of text.

    Reads at most ``max_rows + 1`` rows (a LIMIT job), never the whole input.
    """
    n, size = urls.limit(max_rows + 1).agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("url").cast("bigint")), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


# Salt buckets for shuffle joins whose large side may be dominated by one key.
DEFAULT_SALTS = 32


def salted_range_join(rows: DataFrame, bounds: DataFrame, key: str, value: str,
                      lo: str, hi: str, salt_of: str, salts: int = DEFAULT_SALTS) -> DataFrame:
    """``rows`` joined with ``bounds`` on ``key`` and ``lo <= value <= hi``,
    as a shuffle join that splits hot keys; rows without a value pass for their key.

    Each row gets a salt ``pmod(xxhash64(salt_of), salts)`` (deterministic,
    so retried tasks agree); each bounds row (one per key) is replicated once
    per salt. A key holding a third of all rows is then spread over ``salts``
    tasks instead of one, whether or not AQE's skew handling is on. Returns
    the columns of ``rows`` plus those of ``bounds`` except ``key``.
    """
    r = rows.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_of)), F.lit(salts)).cast("int"))
    b = (bounds.withColumn("_bsalt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
         .withColumnRenamed(key, "_bkey"))
    j = r.join(b, (F.col(key) == F.col("_bkey")) & (F.col("_salt") == F.col("_bsalt"))
               & (F.col(value).isNull() | F.col(value).between(F.col(lo), F.col(hi))))
    return j.drop("_salt", "_bsalt", "_bkey")
