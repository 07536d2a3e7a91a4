"""Rebalancing, splitting and folding.

The default modes decide by a hash of the row's key: the same rows are chosen on every run,
in every partitioning and after a lost executor, and choosing needs no shuffle. The native
random modes of Spark are there as well; their outcome depends on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.functions.expressions import hash32, hash_below, hash_bucket
from rowsmith.operators.columns import filter_class, union_classes

UNDERSAMPLE_SEED = 42
SPLIT_SEED = 1234
_LEVEL_BITS = 16
SPREAD_COPIES = 4


def _two_classes(sizes: dict) -> tuple[object, int, object, int]:
    if len(sizes) != 2:
        raise ValueError(f"the label has {len(sizes)} classes, but two are needed")
    (minor, few), (major, many) = sorted(sizes.items(), key=lambda x: (x[1], x[0]))
    return minor, few, major, many


def class_sizes(df: DataFrame, label: str) -> tuple[object, int, object, int]:
    """(minority value, its rows, majority value, its rows) of a two-class label, from a job
    that returns one row per class."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return _two_classes({r[0]: r["n"] for r in counts.limit(3).collect()})


def _digit(number: Column, shift: int) -> Column:
    return F.shiftright(number, shift).bitwiseAND(F.lit((1 << _LEVEL_BITS) - 1))


def _cut(counts: list[tuple[int, int]], keep: int) -> tuple[int, int, int] | None:
    """(digit, rows below it, rows in it) of the digit in which the ``keep``-th row lies."""
    below = 0
    for digit, n in sorted(counts):
        if below + n >= keep:
            return digit, below, n
        below += n
    return None


def _first_digits(df: DataFrame, label: str, key: str, seed: int) -> dict[object, list[tuple[int, int]]]:
    """Per class, the rows of each first digit of the key's hash: class sizes and the first cut
    from one pass. At most 65,536 small rows for each of two classes."""
    groups = df.filter(F.col(label).isNotNull()).groupBy(label, _digit(hash32(key, seed), 32 - _LEVEL_BITS).alias("digit"))
    found: dict[object, list[tuple[int, int]]] = {}
    for row in groups.agg(F.count(F.lit(1)).alias("n")).collect():
        found.setdefault(row[0], []).append((row["digit"], row["n"]))
    return found


def _lowest_hashes(df: DataFrame, key: str, seed: int, keep: int, first: list[tuple[int, int]]) -> Column:
    """Condition that holds for the ``keep`` rows that come first by (hash, key).

    ``first`` has the rows of each first digit. A second pass counts the second digits inside the
    cut, and a third is needed only if rows that share the cut's whole hash are split. No rows are
    ranked or moved, and the condition is a plain filter. Keys are unique.
    """
    number = hash32(key, seed)
    if keep <= 0:
        return F.lit(False)
    cut = _cut(first, keep)
    if cut is None:
        return F.lit(True)
    base, below, _ = cut
    inside = df.filter(_digit(number, 32 - _LEVEL_BITS) == base)
    counts = inside.groupBy(_digit(number, 0).alias("digit")).agg(F.count(F.lit(1)).alias("n")).collect()
    digit, before, n = _cut([(r["digit"], r["n"]) for r in counts], keep - below)
    limit, left = (base << _LEVEL_BITS) + digit, keep - below - before
    if left == n:
        return number <= limit
    last = df.filter(number == limit).select(key).orderBy(key).limit(left).agg(F.max(key)).head()[0]
    return (number < limit) | ((number == limit) & (F.col(key) <= F.lit(last)))


def undersample(
    df: DataFrame, label: str, key: str | None = None, seed: int = UNDERSAMPLE_SEED, mode: str = "hash"
) -> DataFrame:
    """Thin out the larger class to about (``hash``, ``bernoulli``) or precisely (``exact``)
    the size of the smaller one."""
    if mode == "exact" and key is not None:
        digits = _first_digits(df, label, key, seed)
        _, few, major, many = _two_classes({v: sum(n for _, n in d) for v, d in digits.items()})
    else:
        _, few, major, many = class_sizes(df, label)
    majority = filter_class(df, label, major)
    if mode == "bernoulli":
        return union_classes(majority.sample(False, few / many, seed), df.filter(F.col(label) != F.lit(major)))
    if key is None:
        raise ValueError(f"mode {mode} needs a key")
    if mode == "hash":
        chosen = hash_below(key, seed, few / many)
    elif mode == "exact":
        chosen = _lowest_hashes(majority, key, seed, few, digits[major])
    else:
        raise ValueError(f"unknown mode: {mode}")
    is_major = F.col(label) == F.lit(major)
    # One scan with one filter instead of a union of two.
    return df.filter(F.col(label).isNotNull() & (~is_major | chosen))


def oversample(
    df: DataFrame, label: str, key: str | None = None, seed: int = UNDERSAMPLE_SEED, mode: str = "hash"
) -> DataFrame:
    """Repeat rows of the smaller class up to the size of the larger one.

    ``hash`` gives the precise size: every row floor(many / few) times, and the rows with the
    lowest hashes once more for the remainder; ``copy`` numbers the repeats from 1.
    From ``SPREAD_COPIES`` copies a row on, the copies are dealt out by key and number.
    ``bernoulli`` draws with replacement and gives the size only on average.
    """
    if mode == "bernoulli":
        minor, few, major, many = class_sizes(df, label)
        drawn = filter_class(df, label, minor).sample(True, many / few, seed)
        return union_classes(filter_class(df, label, major), drawn)
    if mode != "hash":
        raise ValueError(f"unknown mode: {mode}")
    if key is None:
        raise ValueError("mode hash needs a key")
    digits = _first_digits(df, label, key, seed)
    minor, few, major, many = _two_classes({v: sum(n for _, n in d) for v, d in digits.items()})
    whole, remainder = divmod(many, few)
    extra = _lowest_hashes(filter_class(df, label, minor), key, seed, remainder, digits[minor])
    copies = F.when(
        F.col(label) == F.lit(minor), F.lit(whole) + F.when(extra, 1).otherwise(0)
    ).otherwise(F.lit(1))
    rows = df.filter(F.col(label).isNotNull())
    out = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    # Copies are made where their row is. Many of them would leave a few large partitions.
    return out.repartition(key, "copy") if whole >= SPREAD_COPIES else out


def no_sampling(df: DataFrame) -> DataFrame:
    """The unbalanced data as it is."""
    return df


def train_test_split(
    df: DataFrame,
    key: str | None = None,
    weights: tuple[float, float] = (0.8, 0.2),
    seed: int = SPLIT_SEED,
    mode: str = "hash",
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together hold every row."""
    if mode == "random":
        train, test = df.randomSplit(list(weights), seed)
        return train, test
    if mode != "hash":
        raise ValueError(f"unknown mode: {mode}")
    if key is None:
        raise ValueError("mode hash needs a key")
    in_train = F.coalesce(hash_below(key, seed, weights[0] / sum(weights)), F.lit(False))
    return df.filter(in_train), df.filter(~in_train)


def kfold(df: DataFrame, key: str, k: int = 3, seed: int = SPLIT_SEED, name: str = "fold") -> DataFrame:
    """Add the row's fold, 0..k-1."""
    return df.withColumn(name, hash_bucket(key, seed, k))
