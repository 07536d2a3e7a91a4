"""Periodic runs, fill-in-middle and packing against plain versions."""

import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsmith.llm import fill_in_middle, packing, periodic_runs
from rowsmith.llm.queries import VOCABULARY
from tests.llm import brute, cases


def same(got, want):
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))


# Periodic runs


def runs_of(words):
    """Every (start, length, period), by comparing all words of all lags."""
    found = []
    for q in range(1, len(words) // 3 + 1):
        i = q
        while i < len(words):
            start = i - q
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            part = words[start:i]
            if len(part) >= max(24, 3 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                found.append((start, len(part), q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def run_row(doc, text):
    words = brute.WORD.findall(text or "")
    found = runs_of(words)
    keep = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    milli = 1000 * top[1] // top[2] if found else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc, len(found), *top, milli, brute.sha(lines), brute.sha(" ".join(keep)))


def planted(doc, text):
    words = brute.WORD.findall(text or "")
    if doc is None or zlib.crc32(str(doc).encode()) % 10 or not words:
        return text
    n, g = len(words), zlib.crc32(str(doc).encode()) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))


def test_runs_of_random_words_match_brute_force():
    rng = random.Random(4)
    count = 0
    for _ in range(1_500):
        size = rng.choice([1, 2, 2, 3, 5])
        words = []
        for _ in range(rng.randrange(1, 9)):
            if rng.random() < 0.5:
                part = [rng.randrange(size) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 9, 12, 20, 30]))]
                part *= rng.choice([1, 2, 3, 3, 4, 6, 10, 30])
                words += part[: rng.randrange(1, len(part) + 1)]
            elif rng.random() < 0.5 and words:
                at = rng.randrange(len(words))
                words += words[at : at + rng.randrange(1, 80)] * rng.choice([1, 2, 3, 4])
            else:
                words += [rng.randrange(size) for _ in range(rng.randrange(20))]
        words = words[:400]
        want = runs_of(words)
        assert periodic_runs.find_runs(np.array(words, np.int64)) == want
        count += len(want)
    assert count > 1_000


@pytest.mark.parametrize(
    "words, found",
    [
        ([0] * 300_000, [(0, 300_000, 1)]),
        ([0, 1, 2] * 100_000 + [3], [(0, 300_000, 3)]),
        ([7, *([*range(5_000)] * 4), 8], [(1, 20_000, 5_000)]),
        ([0] * 23, []),
        ([0] * 24, [(0, 24, 1)]),
        ([0, 1, 2, 3, 4, 5, 6, 7] * 3, [(0, 24, 8)]),
        ([*range(9)] * 3, [(0, 27, 9)]),
        ([*([*range(9)] * 3)][:26], []),
    ],
)
def test_long_and_short_runs(words, found):
    started = time.monotonic()
    assert periodic_runs.find_runs(np.array(words, np.int64)) == found
    assert time.monotonic() - started < 20


def test_run_report_matches_brute_force(spark):
    docs = cases.documents(spark)
    period = " ".join(f"w{i}" for i in range(40))
    more = [(100 + i, t, *[None] * 10) for i, t in enumerate([f"a b {period} {period} {period} w0 z", "x " * 30 + "y " * 40, "\xa0 " * 30])]
    docs = docs.unionByName(spark.createDataFrame(more, cases.SCHEMA))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    same(periodic_runs.run_report(docs).collect(), [run_row(*r) for r in rows])
    text = F.col("text")
    got = periodic_runs.plant_runs(docs)
    assert got.columns == docs.columns
    same(got.select("doc_id", text).collect(), [(d, planted(d, t)) for d, t in rows])
    many = docs.select(F.explode(F.sequence(F.lit(1), F.lit(60))).alias("doc_id"), "text").filter("length(text) < 3000")
    rows = [(r["doc_id"], planted(r["doc_id"], r["text"])) for r in many.collect()]
    assert sum(run_row(*r)[1] for r in rows) > 20
    same(periodic_runs.run_report(periodic_runs.plant_runs(many)).collect(), [run_row(*r) for r in rows])
    assert periodic_runs.run_report(periodic_runs.plant_runs(cases.nothing(spark))).collect() == []


# Fill-in-middle


def fim_row(doc, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc, n, "plain", None, None, brute.sha(text), brute.sha(text))
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        form, out = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, out = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc, n, form, len(prefix), len(middle), brute.sha(out), brute.sha(text))


def test_fill_in_middle_matches_brute_force(spark, monkeypatch):
    odd = ["a<P>b", "<S>", "x<M>", "<P", "<<S", "é😀\r\n\x00 ", "́a", "<P><", "M>" * 50, "$1\\1" * 9]
    rows = [(r[0], r[1]) for r in cases.rows()] + [(1_000 + i, odd[i % len(odd)]) for i in range(120)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fim string").drop("fim")
    want = [fim_row(*r) for r in rows]
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    same(fill_in_middle.transform_report(docs).collect(), want)
    monkeypatch.setattr(fill_in_middle, "BLOCK_CHARS", 7)  # cuts in any block, at its ends too
    for n in range(30):
        text = "".join(random.Random(n).choices("aé😀\n", k=n))
        for a in range(n + 1):
            b = random.Random(a).randrange(n + 1)
            assert fill_in_middle.unit_cuts(text, fill_in_middle.CODE_POINT, a, b) == (n, min(a, b), max(a, b))
    assert fill_in_middle.transform_report(cases.nothing(spark)).collect() == []


def test_other_units_and_restoring(spark):
    docs = spark.createDataFrame([(i, "éx\n" * 5 + "👩‍👩‍👧 end") for i in range(40)], "doc_id long, text string")
    for unit, size in ((fill_in_middle.GRAPHEME, 20), (fill_in_middle.LINE, 6)):
        rows = fill_in_middle.transform(docs, unit=unit, rate=100)
        back = rows.withColumn("back", fill_in_middle.restore(F.col("fim.output"), F.col("fim.form")))
        assert back.filter("back <> text").count() == 0
        assert {r["n"] for r in rows.select("fim.n").collect()} == {size}
    unfit = fill_in_middle.transform(docs, unit="[a-z]").select("fim.*").distinct().collect()
    assert [(r["n"], r["form"]) for r in unfit] == [(None, "plain")]


# Packing


def fewest(sizes, room):
    best = len(sizes)

    def go(i, open_):
        nonlocal best
        if len(open_) >= best:
            return
        if i == len(sizes):
            best = len(open_)
            return
        for b in sorted(set(r for r in open_ if r >= sizes[i])):
            at = open_.index(b)
            go(i + 1, [*open_[:at], b - sizes[i], *open_[at + 1 :]])
        go(i + 1, [*open_, room - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    go(0, [])
    return best


def test_dominance_keeps_the_best_number_of_sequences():
    rng = random.Random(5)
    triples = 0
    for _ in range(1_200):
        room = rng.choice([10, 20, 37, 100])
        sizes = [rng.randint(rng.choice([1, room // 5]), rng.choice([room, room // 2])) for _ in range(rng.randrange(1, 11))]
        fixed, left = packing.reduce_instance(Counter(sizes), room)
        rest = [w for w, n in left.items() for _ in range(n)]
        assert all(p.used <= room for p in fixed)
        assert sum(p.count for p in fixed) + fewest(rest, room) == fewest(sizes, room)
        triples += sum(len(p.pieces) == 3 for p in fixed)
    assert triples


def test_counted_best_fit_equals_best_fit_piece_by_piece():
    rng = random.Random(6)
    for _ in range(300):
        sizes = [rng.randint(1, 40) for _ in range(rng.randrange(200))]
        rooms = []
        for w in sorted(sizes, reverse=True):
            fits = [r for r in rooms if r >= w]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else 40) - w)
        got = [40 - p.used for p in packing.best_fit(Counter(sizes), 40) for _ in range(p.count)]
        assert sorted(got) == sorted(rooms)


def piece_rows(rows, room):
    out = []
    for doc, text in rows:
        ids = [*brute.ids_of(text), 2]
        stops = [*range(len(ids), 0, -room)][::-1]
        for i, stop in enumerate(stops):
            start = stops[i - 1] if i else 0
            out.append((doc, i, start, stop - start, zlib.crc32(brute.little(ids[start:stop]))))
    return out


@pytest.mark.parametrize("room", [1_024, 60])
def test_packing_places_every_piece(spark, room):
    docs = cases.documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = packing.pack_report(docs, VOCABULARY, capacity=room).collect()
    same([r[:5] for r in found], piece_rows(rows, room))
    ends = Counter()
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= room
    assert len(ends) <= 1 + 1.05 * sum(ends.values()) / room
    assert packing.pack_report(cases.nothing(spark), VOCABULARY).collect() == []


def test_sequences_hold_the_ids_of_their_pieces(spark):
    docs = cases.documents(spark).filter("doc_id is not null and doc_id < 6 or doc_id > 14")
    packed = packing.pack(docs, VOCABULARY, capacity=50)
    ids = {(r["sequence_id"], r["offset"]): bytes(r["ids"]) for r in packed.collect()}
    for r in packing.sequences(packed).collect():
        want = b"".join(v for (s, _), v in sorted(ids.items()) if s == r["sequence_id"])
        assert bytes(r["ids"]) == want
