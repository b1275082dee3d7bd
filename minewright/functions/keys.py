"""Hashing and sharding of string keys as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the 32-bit FNV-1a hash, and the number of shards.
FNV_OFFSET = 2166136261
FNV_PRIME = 16777619
SHARDS = 10


def _byte_values(key: Column) -> Column:
    """The UTF-8 bytes of a string as an array of integers 0..255."""
    hexed = F.hex(F.encode(key, "UTF-8"))
    starts = F.when(F.length(hexed) > 0, F.sequence(F.lit(1), F.length(hexed), F.lit(2))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.conv(F.substring(hexed, i, F.lit(2)), 16, 10).cast("bigint"))


def fnv1a(key: Column) -> Column:
    """32-bit FNV-1a of the UTF-8 bytes, as a non-negative bigint."""
    return F.aggregate(
        _byte_values(key),
        F.lit(FNV_OFFSET).cast("bigint"),
        lambda h, b: (h.bitwiseXOR(b) * F.lit(FNV_PRIME)).bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")),
    )


def shard_of(key: Column, shards: int = SHARDS) -> Column:
    """First byte modulo the number of shards; the empty key goes to shard 0."""
    first = F.conv(F.hex(F.substring(F.encode(key, "UTF-8"), 1, 1)), 16, 10).cast("int")
    return F.when(key == "", F.lit(0)).otherwise(F.pmod(first, F.lit(shards)))


def unit_uniform(*parts: Column) -> Column:
    """Uniform number in [0, 1) drawn from the hash of the parts, so the same row always gets the same number."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
