"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

HASH_RANGE = 2**32


def tidy(value: Column | str, digits: int = 6) -> Column:
    """Round for display and comparison; adding 0.0 turns -0.0 into 0.0."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column.cast("double"), digits) + F.lit(0.0)


def hash32(key: Column | str, seed: int) -> Column:
    """Uniform number in [0, 2**32) that depends only on the key's text and the seed.

    The same row gets the same number on every run and in every partitioning.
    """
    column = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(column.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_below(key: Column | str, seed: int, fraction: float | Column) -> Column:
    """True for about ``fraction`` of the keys."""
    limit = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return hash32(key, seed) < limit * F.lit(float(HASH_RANGE))


def hash_bucket(key: Column | str, seed: int, buckets: int) -> Column:
    return F.pmod(hash32(key, seed), F.lit(buckets)).cast("int")


def same_value(left: Iterable[Column], right: Iterable[Column]) -> Column:
    """Pairwise equality in which nulls equal each other."""
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) for a, b in zip(left, right)])
