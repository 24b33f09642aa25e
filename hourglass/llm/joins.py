"""Joins with a smaller side whose size is measured, and with hot keys split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20
SALTS = 16


def _bytes_of(df: DataFrame) -> Column:
    """Bytes of a row: lengths of strings, binaries and arrays, 8 for the rest."""
    parts = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif kind == "array":
            parts.append(F.octet_length(F.to_json(F.struct(c))))
        else:
            parts.append(F.lit(8))
    return reduce(lambda a, b: a + b, parts, F.lit(16))


def measured_bytes(df: DataFrame) -> int:
    return df.agg(F.sum(_bytes_of(df).cast("long"))).first()[0] or 0


def join_measured(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, spread: Column,
                  most: int = BROADCAST_BYTES, salts: int = SALTS) -> DataFrame:
    """``left`` joined with ``right``: broadcast if ``right`` is measured to be small.

    Otherwise both are shuffled by the key and a salt: rows of ``left`` get one of
    ``salts`` values from ``spread``, rows of ``right`` are repeated for each, so no key of
    ``left`` meets in one task. ``how``: inner, left, left_semi or left_anti.
    """
    on = list(on)
    if measured_bytes(right) <= most:
        return left.join(F.broadcast(right), on, how)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
