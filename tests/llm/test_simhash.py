import random

import numpy as np
import pytest

from rowsmith.llm import simhash
from tests.llm import brute, cases


def compare(spark, docs):
    got = sorted(map(repr, map(tuple, simhash.near_copies(docs).collect())))
    want = sorted(map(repr, brute.near_copies([(r["doc_id"], r["text"]) for r in docs.collect()])))
    assert got == want


def test_awkward_rows_match_brute_force(spark):
    compare(spark, cases.documents(spark))


def test_empty_table(spark):
    assert simhash.near_copies(cases.nothing(spark)).collect() == []
    assert simhash.keep_one(cases.nothing(spark)).collect() == []


def test_long_text_is_read_whole(spark):
    text = cases.prose(random.Random(3), 70_000)
    upper = text.translate({c: c - 32 for c in range(ord("a"), ord("z") + 1)})  # A-Z only, as the rule says
    assert simhash.text_fingerprint(text) == simhash.text_fingerprint(upper) == brute.fingerprint(text)
    assert simhash.text_fingerprint(text) != simhash.text_fingerprint(text + cases.prose(random.Random(4), 70_000))


def chains(rng, n):
    """Random values, balls around centres and long chains of neighbours."""
    values = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(n // 4):
            x = centre
            for b in rng.sample(range(64), rng.randrange(9)):
                x ^= 1 << b
            values.append(x)
    x = rng.getrandbits(64)
    for _ in range(n // 4):
        for b in rng.sample(range(64), 4):
            x ^= 1 << b
        values.append(x)
    return sorted(set(values))


@pytest.mark.parametrize("hot_rows,block,small", [(2_000, 1_000, 0), (5, 7, 200_000), (20, 7, 0)])
@pytest.mark.parametrize("max_bits", [4, 3, 1])
def test_links_join_all_near_pairs(spark, monkeypatch, hot_rows, block, small, max_bits):
    monkeypatch.setattr(simhash, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(simhash, "SMALL_ROWS", small)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block)
    values = np.array(chains(random.Random(max_bits), 200), np.uint64)
    signed = [int(x) for x in values.view(np.int64)]
    classes = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    found = simhash.components(simhash.links(classes, "fp", max_bits)).collect()
    root = {r["node"]: r["root"] for r in found}
    up = {x: x for x in signed}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(values):
        near = np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ a) <= max_bits) + i + 1
        for j in near:
            up[top(signed[i])] = top(signed[j])
    groups = {}
    for x in signed:
        groups.setdefault(top(x), set()).add(x)
    got = {}
    for x in signed:
        got.setdefault(root.get(x, x), set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_links_stay_few_in_a_dense_group(spark):
    rng = random.Random(9)
    centre = rng.getrandbits(63)
    ball = {centre ^ (1 << a) ^ (1 << b) for a in range(60) for b in range(a)}
    classes = spark.createDataFrame([(x,) for x in ball], "fp long").repartition(2)
    count = simhash.links(classes, "fp").count()
    assert count < 20 * len(ball)


def parts_of(rows):
    """Component number of every row of [(doc_id, text)]: brute force gives it when each row has an id of its own."""
    return [comp for _, _, comp in brute.near_copies([(i, text) for i, (_, text) in enumerate(rows)])]


def test_keep_one_keeps_a_row_of_every_component(spark):
    docs = cases.documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    groups = {}
    for (doc, text), part in zip(rows, parts_of(rows)):
        groups.setdefault(part, set()).add((doc is None, doc or 0))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    assert got == sorted(map(min, groups.values()))
    assert got.count((False, 6)) == 2  # id 6 stands on two unrelated texts


def test_keep_one_of_near_copies_without_ids(spark):
    rng = random.Random(12)
    text = cases.prose(rng, 400)
    near = [text]
    for word in text.split():
        other = text.replace(word, "zebra", 1)
        if 0 < (brute.fingerprint(text) ^ brute.fingerprint(other)).bit_count() <= 4:
            near.append(other)
        if len(near) == 4:
            break
    rows = [(None, t) for t in near] + [(None, cases.prose(rng, 90))]
    assert len(near) == 4 and len(set(parts_of(rows))) == 2
    got = [r["text"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(got) == 2 and rows[-1][1] in got
