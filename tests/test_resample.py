import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowsmith.operators.resample import kfold, no_sampling, oversample, train_test_split, undersample


def number(key, seed):
    return int(hashlib.md5(f"{key}:{seed}".encode()).hexdigest()[:8], 16)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def data(spark):
    return spark.range(2000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("label")
    )


def few_and_many(data):
    rows = [tuple(r) for r in data.collect()]
    few = [k for k, label in rows if label == 1]
    many = sorted((k for k, label in rows if label == 0), key=lambda k: (number(k, 42), k))
    return few, many


def test_undersample_exact(data):
    few, many = few_and_many(data)
    expected = Counter([(k, 1) for k in few] + [(k, 0) for k in many[: len(few)]])
    for parts in (1, 6):
        assert rows_of(undersample(data.repartition(parts), "label", "k", mode="exact")) == expected


def test_undersample_hash(data):
    few, many = few_and_many(data)
    limit = len(few) / len(many) * 2**32
    expected = Counter([(k, 1) for k in few] + [(k, 0) for k in many if number(k, 42) < limit])
    assert rows_of(undersample(data.repartition(5), "label", "k")) == expected


def test_larger_class_is_found_by_size(data):
    flipped = data.withColumn("label", 1 - F.col("label"))
    counts = Counter(r["label"] for r in undersample(flipped, "label", "k", mode="exact").collect())
    assert counts[0] == counts[1]


def test_oversample(data):
    few, many = few_and_many(data)
    found = [tuple(r) for r in oversample(data.repartition(5), "label", "k").collect()]
    per_class = Counter(label for _, label, _ in found)
    assert per_class[0] == per_class[1] == len(many)
    copies = Counter(k for k, label, _ in found if label == 1)
    whole, rest = divmod(len(many), len(few))
    ordered = sorted(few, key=lambda k: (number(k, 42), k))
    assert copies == Counter({k: whole + (i < rest) for i, k in enumerate(ordered)})
    assert len(set(found)) == len(found)


def test_native_modes(data):
    for found in (undersample(data, "label", mode="bernoulli"), oversample(data, "label", mode="bernoulli")):
        counts = Counter(r["label"] for r in found.select("label").collect())
        assert counts[0] == pytest.approx(counts[1], rel=0.25)
    train, test = train_test_split(data, mode="random")
    assert train.count() + test.count() == 2000
    assert no_sampling(data) is data


def test_missing_class_and_arguments(data):
    with pytest.raises(ValueError):
        undersample(data.filter("label = 0"), "label", "k")
    with pytest.raises(ValueError):
        oversample(data.withColumn("label", F.col("k") % 3), "label", "k")
    for act in (undersample, oversample):
        with pytest.raises(ValueError):
            act(data, "label")
        with pytest.raises(ValueError):
            act(data, "label", "k", mode="other")
    with pytest.raises(ValueError):
        train_test_split(data)


def test_split_is_whole_disjoint_and_stable(data):
    train, test = train_test_split(data, "k")
    keys = {r["k"] for r in train.collect()}, {r["k"] for r in test.collect()}
    assert not keys[0] & keys[1] and len(keys[0] | keys[1]) == 2000
    assert keys[0] == {k for k in range(2000) if number(k, 1234) < 0.8 * 2**32}
    assert {r["k"] for r in train_test_split(data.repartition(3), "k")[0].collect()} == keys[0]


def test_split_puts_a_null_key_in_the_test_part(spark):
    df = spark.createDataFrame([(None,), (1,)], "k int")
    train, test = train_test_split(df, "k")
    assert train.count() + test.count() == 2


def test_folds(data):
    folds = {r["k"]: r["fold"] for r in kfold(data.repartition(4), "k", 3).collect()}
    assert folds == {k: number(k, 1234) % 3 for k in range(2000)}


def test_copies_are_spread_over_partitions(spark):
    rows = spark.range(0, 4_000, 1, 8).select("id", (F.col("id") < 20).cast("int").alias("label"))
    out = oversample(rows, "label", "id")
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert out.filter("label = 1").count() == 3_980
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)
