import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from rowsmith.llm import bpe, decontaminate, library_tokens, licenses, quality_classifier, quality_rules, token_counts, token_files
from rowsmith.llm.queries import VOCABULARY
from rowsmith.session import scratch_path
from tests.llm import brute, cases


def same(got, want):
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))


# Benchmark passages


def test_contamination_matches_brute_force(spark, monkeypatch):
    docs, items = cases.documents(spark), cases.benchmark(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute.contamination(rows, [(r["item_id"], r["text"]) for r in items.collect()])
    same(decontaminate.contamination(docs, items).collect(), want)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 60)  # several blocks, merged per row
    monkeypatch.setattr(decontaminate, "PASS_BLOCKS", 100)
    same(decontaminate.contamination(docs, items).collect(), want)
    total = sum(len(r["text"] or "") for r in items.collect())
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", -(-total // 5))  # five blocks in passes of two
    monkeypatch.setattr(decontaminate, "PASS_BLOCKS", 2)
    same(decontaminate.contamination(docs, items).collect(), want)


def test_drop_contaminated_keeps_columns_and_clean_rows(spark):
    docs, items = cases.documents(spark), cases.benchmark(spark).filter("item_id = 10")
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()}
    assert 6 not in {r["doc_id"] for r in kept.filter("text like 'x'").collect()} and gone <= {6, 12, 13}
    assert decontaminate.contamination(docs, items.filter("false")).filter("contaminated").count() == 0
    assert decontaminate.drop_contaminated(cases.nothing(spark), items).collect() == []


def test_shifts_skip_but_miss_nothing():
    rng = random.Random(2)
    words = [rng.choice([b"a", b"b", b"c"]) for _ in range(3_000)]
    search = decontaminate.Search(4)
    for _ in range(12):
        at = rng.randrange(2_990)
        search.add(tuple(words[at : at + 4]), str(at))
    search.build()
    found = {start for start, _ in search.find(words)}
    assert found == {i for i in range(2_997) if tuple(words[i : i + 4]) in search.windows}
    lone = decontaminate.Search(10)
    lone.add(tuple(b"w%d" % i for i in range(10)), "x")
    assert lone.build().skip == 9


# Byte pair encoding


def test_round_trip_matches_the_library(spark):
    docs = cases.documents(spark)
    want = [(r["doc_id"], *brute.round_trip(r["text"])) for r in docs.collect()]
    same(bpe.round_trip(docs, VOCABULARY).collect(), want)
    assert bpe.round_trip(cases.nothing(spark), VOCABULARY).collect() == []


def test_encode_and_decode_columns(spark):
    docs = cases.documents(spark).select("doc_id", "text", bpe.encode(cases_col("text"), VOCABULARY).alias("ids"))
    for r in docs.withColumn("back", bpe.decode(cases_col("ids"), VOCABULARY)).collect():
        assert r["ids"] == brute.ids_of(r["text"]) and r["back"] == (r["text"] or "")


def cases_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_fragments_of_random_text_match_the_library():
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "　", "​", "'s", "'t", "'", "<|endoftext|>"]
    parts += ["é", "à", "ß", "中", "😀", "1", "²", "Ⅷ", "_", "!", "the", "ing", "\r", "\x0b", "don't", "A", "aaaa", "\x00", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(1_500)]
    texts += ["a" * 3_000, "ab" * 999, " " * 500, "\n" * 300 + "x", "=-" * 400]
    cache, made = bpe.encoder(VOCABULARY)
    for text, found in zip(texts, cache.ids(texts)):
        ids = np.frombuffer(found, "<u4")
        assert ids.tolist() == brute.ids_of(text)
        assert bpe.decode_ids(ids, made.vocabulary.tokens) == text


def test_forced_boundaries_are_never_inside_a_token():
    _, made = bpe.encoder(VOCABULARY)
    for token in made.vocabulary.tokens[:5_000]:
        pair = np.frombuffer(token, np.uint8)
        if token.decode("utf-8", "replace") not in made.vocabulary.special:
            assert made.vocabulary.inside[pair[:-1], pair[1:]].all()


# Token files


def test_token_files_match_brute_force(spark, monkeypatch):
    docs = cases.documents(spark)
    want = brute.token_files([(r["doc_id"], r["text"]) for r in docs.collect()])
    path = scratch_path(spark, "tokens")
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 5_000)
    token_files.write_token_files(docs, path, VOCABULARY, parts=4)
    same(token_files.document_tokens(spark, path).collect(), want)
    empty = scratch_path(spark, "tokens")
    token_files.write_token_files(cases.nothing(spark), empty, VOCABULARY)
    assert token_files.document_tokens(spark, empty).collect() == []


def ids_by_table(table, texts):
    return [np.frombuffer(ids, "<u4").tolist() for ids in table.ids(pa.array(texts, pa.string()))]


@pytest.mark.parametrize("entries, group", [(200, 700), (50, 1), (500_000, 4_000_000)])
def test_table_gives_the_ids_of_the_library(monkeypatch, entries, group):
    monkeypatch.setattr(library_tokens, "TABLE_ENTRIES", entries)
    monkeypatch.setattr(library_tokens, "GROUP_BYTES", group)
    rng = random.Random(3)
    parts = ["a", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u205f", "\u3000", "\u200b", "'s", "'"]
    parts += ["<|endoftext|>", "<", "|", "\xe9", "\xd7", "\xf7", "\u024f", "\u0250", "\u047f", "\u0480", "\u4e2d", "\U0001f600", "1", "\xb2", "\u2167"]
    parts += ["_", "!", "\r", "\x0b", "don't", "A", "\x00", "\u0301", "\u2014", "\x7f", "aaaa"]
    plain = ["the", " ", "\n", ".", ",", "12", " and", "\xe9", "\u0436", "A", "-", " "]
    texts = ["".join(rng.choice(parts + plain * 3) for _ in range(rng.randrange(40))) for _ in range(1_500)]
    texts += ["".join(rng.choice(plain) for _ in range(rng.randrange(80))) for _ in range(500)]
    texts += [None, "", "", " ", "a" * 3_000, " " + "ab" * 999, " " * 500, "\n" * 300 + "x", "=-" * 400, None]
    table = library_tokens.LibraryTable(VOCABULARY)
    assert ids_by_table(table, texts) == [brute.ids_of(t) for t in texts]
    part = pa.array(texts, pa.string()).slice(700, 50)
    assert [np.frombuffer(x, "<u4").tolist() for x in table.ids(part)] == [brute.ids_of(t) for t in texts[700:750]]
    assert ids_by_table(table, []) == [] and ids_by_table(table, [None]) == [[]]


def test_words_reach_the_library_once_whatever_stands_beside_them(monkeypatch):
    sent = []
    table = library_tokens.library_table(VOCABULARY)
    table._clear()
    encode = table._encode
    monkeypatch.setattr(table, "_encode", lambda texts: (sent.extend(texts), encode(texts))[1])
    words = ["".join(c) for c in itertools.product("bcdfg", "aeiou", "lmnr", "aeiou")]
    signs = [".", ",", ";", ".\n", "!\n", "?", ":"]
    texts = ["x " + " ".join(w + s + v for w, v in zip(words, words[::-1])) for s in signs]
    assert ids_by_table(table, texts) == [brute.ids_of(t) for t in texts]
    # Each word behind a space, each without one, and the signs; all texts together are seven times as much.
    assert sum(map(len, sent)) < 2 * sum(len(w) + 1 for w in words) + 50 < sum(map(len, texts)) / 2


def test_other_vocabularies_go_to_the_library_as_whole_texts(tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    library.pre_tokenizer = None
    library.save(str(tmp_path / "other.json"))
    table = library_tokens.LibraryTable(str(tmp_path / "other.json"))
    texts = ["a b", "", "one two\n three", None, "a b", "x" * 200 + " y"]
    assert not table.cuts
    assert ids_by_table(table, texts) == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("high", [1, 2, 300, 50_257, 1 << 20, (1 << 32) - 1])
def test_blocks_round_trip(high):
    rng = np.random.default_rng(high % 1_000)
    ids = rng.integers(0, high, 10_000, dtype=np.uint32) // rng.integers(1, 1_000, 10_000, dtype=np.uint32)
    data = token_files.pack_segment(ids)
    assert (token_files.read_ids(data) == ids).all()
    assert (token_files.read_ids(data, 4_000, 9_000) == ids[4_000:9_000]).all()
    assert len(token_files.block_starts(data)) == 3
    assert len(token_files.read_ids(token_files.pack_segment(ids[:0]))) == 0


# Quality rules


def test_quality_counts_match_brute_force(spark):
    docs = cases.documents(spark)
    got = [tuple(r)[:7] for r in quality_rules.judge(docs).collect()]
    same(got, [(r["doc_id"], *brute.quality(r["text"])) for r in docs.collect()])
    assert quality_rules.judge(cases.nothing(spark)).collect() == []


def test_failed_lines_go_and_documents_that_lose_too_much(spark):
    good = cases.prose(random.Random(8), 120)
    texts = [
        good,
        good + "\nHome | About | Contact | Login",
        good + "\nWe use cookies. Accept all cookies to go on.",
        "\n".join("word%d### other%d$$$ third%d&&& last%d***" % (i, i, i, i) for i in range(30)),
        "\n".join("THIS%d!! IS%d!! LOUD%d!!" % (i, i, i) for i in range(30)),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in quality_rules.keep_good(docs).collect()}
    assert out == {0: good, 1: good, 2: good}


def test_long_lines_lose_only_the_sentences_that_are_boilerplate(spark):
    rng = random.Random(21)
    prose = lambda n: cases.prose(rng, n).replace("\n", " ")
    mention = "The ministry wrote a new privacy policy for all of the schools in the country last year."
    first, last = prose(600) + " End.", prose(600) + " End."
    texts = [
        f"{first} {mention} {last}",  # one line, one mention in passing
        f"{first} Accept all cookies. {last}",
        f"{first}\nAll rights reserved.\n{last}",
        prose(3_000).replace(".", "") + " terms of use",  # no sentence marks at all
        " ".join(f"Click here to subscribe to our newsletter{i}." for i in range(20)) + f"\n{first}",
        " ".join(f"Click here to see item{i}." for i in range(400)) + f"\n{prose(60)}",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in quality_rules.keep_good(docs).collect()}
    assert out == {0: texts[0], 1: f"{first} {last}", 2: f"{first}\n{last}", 3: texts[3], 4: first}
    lost = {r["doc_id"]: r["lost_chars"] for r in quality_rules.judge(docs).collect()}
    assert lost[0] == lost[3] == 0 and lost[1] == len("Acceptallcookies.") and lost[2] == len("Allrightsreserved.")


def test_lists_headings_and_dialogue_stay(spark):
    good = [
        "# Title", "## Heading here", "## Heading ##", "* item one", "- buy fresh milk", "- milk", "  - two words", "1. first - of all",
        "> a quotation", "> yes", "Yes - of course", "Yes - of course - why not", "- Yes - of course", "What?!", "Really?! Well...",
        "**Important notice**", "Up 50% today", "from 5% to 10%", "Q & A", "and / or", "No. Never.", "No.", "J. R. R. Tolkien wrote it.",
        "- No. Never. Again.", "Buy. Now.", "• a point", "The end. Yes. We went home early that day.", "Home | About",
    ]
    bad = [
        "Home | About | Contact", "Home > News > Sport > Today", "Home - About - Contact", "• Home • About • Contact •", "| a | b | c |",
        "Buy. Now. Cheap. Pills.", "Buy! Now! Cheap! Pills! Here!", "=====", "-----", "* * *", "$$$ win### big***", "THIS!! IS!! LOUD!!",
    ]
    prose = cases.prose(random.Random(31), 300)
    docs = spark.createDataFrame([(i, f"{prose}\n{x}") for i, x in enumerate(good + bad)], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in quality_rules.keep_good(docs).collect()}
    assert [x for i, x in enumerate(good) if out[i] != f"{prose}\n{x}"] == []
    assert [x for i, x in enumerate(bad) if out[len(good) + i] != prose] == []


# Importance resampling


def test_selection_prefers_text_like_the_target(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        words = ["alpha", "beta", "gamma", "delta"] if i % 2 else ["noise", "junk", "spam", "blah"]
        rows.append((i, " ".join(rng.choice(words) for _ in range(30))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1) for i in range(1, 60, 2)] + [(3, 0)], "doc_id long, quality int")
    got = quality_classifier.resample(docs, labels, share=0.5).collect()
    chosen = {r["doc_id"] for r in got if r["selected"]}
    assert len(chosen) == 150 and all(i % 2 for i in chosen)


def test_top_limit_is_exact_with_ties(spark):
    values = [5, 5, 5, 9, 1, -(10**15), 10**15, 7, 7]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    for k in range(1, len(values) + 1):
        assert quality_classifier.top_limit(rows, "v", k) == sorted(values, reverse=True)[k - 1]
    assert quality_classifier.top_limit(rows, "v", 10) is None


def plain_log_weights(rows, good, buckets):
    """Log weights of [(id, text)] by counting in dictionaries; buckets of words and pairs come from ``bucket_of``."""
    raw, target = Counter(), Counter()
    grams = [grams_of(t) for _, t in rows]
    for (doc, _), g in zip(rows, grams):
        raw.update(g)
        if doc in good:
            target.update(g)
    r, t = sum(raw.values()) + buckets, sum(target.values()) + buckets
    return [sum(math.log((target[b] + 1) / t) - math.log((raw[b] + 1) / r) for b in g) for g in grams]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def grams_of(text, buckets=quality_classifier.BUCKETS):
    words = brute.WORD.findall((text or "").translate(brute.LOWER))
    single = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) % buckets for w in words]
    # Spark hashes several columns by taking each hash as the seed of the next.
    pair = [
        signed(xxhash.xxh64_intdigest(b.encode(), xxhash.xxh64_intdigest(a.encode(), 42))) % buckets for a, b in zip(words, words[1:])
    ]
    return single + pair


def test_resampling_matches_brute_force(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(i, 1) for i in (6, 7, 12, 21)] + [(None, 1), (8, 0)], "doc_id long, quality int")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain_log_weights(rows, {6, 7, 12, 21}, quality_classifier.BUCKETS)
    got = quality_classifier.resample(docs, labels, share=0.3).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    a = sorted(((r["doc_id"], r["log_weight"]) for r in got), key=key)
    b = sorted(((doc, w) for (doc, _), w in zip(rows, want)), key=key)
    assert [x for x, _ in a] == [x for x, _ in b] and np.allclose([x for _, x in a], [x for _, x in b])
    # The k largest sums of weight and noise, and no others.
    k = math.ceil(0.3 * len(rows))
    sums = sorted((r["log_weight"] + r["noise"] for r in got), reverse=True)
    assert sorted((r["log_weight"] + r["noise"] for r in got if r["selected"]), reverse=True) == sums[:k]


def test_copies_are_drawn_one_by_one(spark):
    same = [(1, "the same words again")] * 3_000 + [(None, "the same words again")] * 500
    rows = same + [(i, f"other words {i}") for i in range(2, 502)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(1, 1), (5, 1)], "doc_id long, quality int")
    got = quality_classifier.resample(docs, labels, share=0.5).collect()
    assert len(got) == 4_000 and sum(r["selected"] for r in got) == 2_000
    assert len({r["noise"] for r in got}) == 4_000
    again = quality_classifier.resample(docs.repartition(2), labels, share=0.5).collect()
    same_rows = lambda found: sorted(map(repr, map(tuple, found)))
    assert same_rows(got) == same_rows(again)
    noise = np.array([r["noise"] for r in got])
    assert abs(noise.mean() - 0.5772) < 0.1 and abs(noise.std() - math.pi / math.sqrt(6)) < 0.1


def test_resample_awkward_rows(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(6, 1), (None, 1), (7, None)], "doc_id long, quality int")
    got = quality_classifier.resample(docs, labels).collect()
    assert len(got) == docs.count() and all(np.isfinite(r["log_weight"]) for r in got)
    assert [r["log_weight"] for r in got if r["doc_id"] == 1] == [0.0]
    assert quality_classifier.resample(cases.nothing(spark), labels).collect() == []


# Licences


def test_licences_inherit_from_the_nearest_directory(spark):
    files = [
        ("/a/LICENSE", "Licensed under the Apache License, Version 2.0."),
        ("/a/x.txt", "nothing to see"),
        ("/a/b/y.txt", "header\nReleased under the MIT License.\n" + "code " * 50),
        ("/a/b/z.txt", "plain"),
        ("/a/c/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        ("/a/c/d/e.txt", None),
        ("/other/f.txt", ""),
        (None, "Licensed under CC BY-NC 4.0."),
        ("/a/b/z.txt", "plain"),
        ("/a/g.txt", "This work is licensed under the GNU General Public License, version 2. " + "Text " * 99),
    ]
    docs = spark.createDataFrame(files, "path string, text string")
    got = sorted((str(r["path"]), str(r["licence"]), r["origin"], str(r["from_path"])) for r in licenses.licences(docs).collect())
    assert got == sorted(
        [
            ("/a/LICENSE", "Apache-2.0", "own", "/a/LICENSE"),
            ("/a/x.txt", "Apache-2.0", "inherited", "/a"),
            ("/a/b/y.txt", "MIT", "own", "/a/b/y.txt"),
            ("/a/b/z.txt", "Apache-2.0", "inherited", "/a"),
            ("/a/b/z.txt", "Apache-2.0", "inherited", "/a"),
            ("/a/c/LICENSE", "GPL-3.0", "own", "/a/c/LICENSE"),
            ("/a/c/d/e.txt", "GPL-3.0", "inherited", "/a/c"),
            ("/other/f.txt", "None", "none", "None"),
            ("None", "CC-BY-NC-4.0", "own", "None"),
            ("/a/g.txt", "GPL-2.0", "own", "/a/g.txt"),
        ]
    )
    assert licenses.licences(docs.filter("false")).collect() == []


def plain_score(text, templates):
    """Best cosine of a text and its licence, from the formulas."""
    texts = [(k, Counter(re.findall(licenses.TERM, t.lower()))) for k, parts in sorted(templates.items()) for t in parts]
    seen = Counter(w for _, c in texts for w in c)
    idf = lambda w: math.log((1 + len(texts)) / (1 + seen[w])) + 1
    vector = lambda c: {w: (1 + math.log(n)) * idf(w) for w, n in c.items()}
    mine = vector(Counter(re.findall(licenses.TERM, text.lower())))
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    return max(
        (sum(x * mine.get(w, 0) for w, x in v.items()) / size(v) / size(mine), k) for k, v in ((k, vector(c)) for k, c in texts)
    )


def test_scores_and_inheritance_match_brute_force(spark):
    rng = random.Random(31)
    notices = ["Released under the MIT License.", "Licensed under CC BY 4.0.", "Licensed under the Apache License, Version 2.0."]
    files = []
    for i in range(150):
        depth = rng.randrange(4)
        name = rng.choice(["LICENSE", "COPYING.txt", "a.py", "b.md", "license_check.py"])
        path = "/" + "/".join(rng.choice("ab") for _ in range(depth)) + ("/" if depth else "") + name
        files.append((i, path, rng.choice([*notices, "no words about it", None, "x y\n" + rng.choice(notices) + "\n" + "z " * 40])))
    docs = spark.createDataFrame(files, "doc_id long, path string, text string").repartition(4)
    own, speaks = {}, {}
    for i, path, text in files:
        parts = [p for p in re.split(licenses.SENTENCE, text or "") if re.search(licenses.NOTICE, p)]
        scored = [(-s, k) for s, k in (plain_score(p, licenses.TEMPLATES) for p in parts) if s >= licenses.MIN_COSINE]
        own[i] = min(scored, default=None)
        folder, name = path.rsplit("/", 1)
        if own[i] and re.match(licenses.FILE_NAME, name):
            speaks.setdefault(folder, []).append(own[i])
    want = {}
    for i, path, _ in files:
        if own[i]:
            want[i] = (own[i][1], "own", path, -own[i][0])
            continue
        folder = path.rsplit("/", 1)[0]
        while folder and folder not in speaks:
            folder = folder.rsplit("/", 1)[0]
        found = speaks.get(folder, [])
        if not found:
            want[i] = (None, "none", None, None)
        elif len({k for _, k in found}) > 1:
            want[i] = (None, "disputed", folder, None)
        else:
            want[i] = (min(found)[1], "inherited", folder, -min(found)[0])
    assert {w[1] for w in want.values()} == {"own", "inherited", "disputed", "none"}
    got = {r["doc_id"]: r for r in licenses.licences(docs, keep=("doc_id", "path")).collect()}
    assert len(got) == len(files)
    for i, (licence, origin, place, score) in want.items():
        assert (got[i]["licence"], got[i]["origin"], got[i]["from_path"]) == (licence, origin, place)
        assert got[i]["score"] == (pytest.approx(score) if score else None)


def test_licences_of_awkward_tables(spark):
    docs = cases.documents(spark).withColumn("path", F.concat(F.lit("/"), F.col("source"), F.lit("/LICENSE")))
    named = docs.withColumn("licence", F.lit("mine")).withColumn("origin", F.lit(1)).withColumn("above", F.lit(2)).withColumn("dir", F.lit(3))
    got = licenses.licences(named, keep=("doc_id", "licence", "path", "origin", "above", "dir"))
    assert got.columns == ["doc_id", "kept_licence", "kept_path", "kept_origin", "above", "dir", *licenses.RESULTS]
    assert got.count() == docs.count() and got.filter("licence is not null").count() == 0
    assert licenses.licences(named.filter("false"), keep=("licence",)).collect() == []
    long = "\n".join(f"Released under the MIT License {i}." for i in range(3_000))
    big = spark.createDataFrame([("/a/LICENSE", long), ("/a/x", "")], "path string, text string")
    assert sorted((r["path"], r["licence"], r["origin"]) for r in licenses.licences(big).collect()) == [
        ("/a/LICENSE", "MIT", "own"),
        ("/a/x", "MIT", "inherited"),
    ]


def test_whole_licences_speak_for_their_directory(spark):
    import textwrap

    whole = {k: v[0] for k, v in licenses.whole_texts().items()}
    mit = "The MIT License\n\nCopyright (c) 2020 Foo Ltd. All rights reserved.\n\n" + whole["MIT"]
    texts = {"MIT": mit, **{k: whole[k] for k in ("BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0")}}
    files = []
    for k, t in texts.items():
        paragraphs = [" ".join(p.split()) for p in t.split("\n\n")]
        for i, form in enumerate((t, "\n\n".join(paragraphs), "\n\n".join(textwrap.fill(p, 50) for p in paragraphs))):
            files += [(f"/{k}/{i}/LICENSE", form), (f"/{k}/{i}/src/x.c", "int x;")]
    header = licenses._GNU.replace("software;", "software:")
    for v in "23":
        block = textwrap.indent(textwrap.fill(header.format(what="", version=v) + ".", 60), " * ")
        files.append((f"/h/GPL-{v}.0", f"/*\n{block}\n */\n" + "int y;\n" * 90))
    files.append(("/t/title", "GNU GENERAL PUBLIC LICENSE\n" + "int y;\n" * 90))
    docs = spark.createDataFrame(files, "path string, text string")
    got = {r["path"]: (r["licence"], r["origin"]) for r in licenses.licences(docs).collect()}
    want = {p: (p.split("/")[1], "own" if p.endswith("LICENSE") else "inherited") for p, _ in files if p[1] not in "ht"}
    want |= {"/h/GPL-2.0": ("GPL-2.0", "own"), "/h/GPL-3.0": ("GPL-3.0", "own"), "/t/title": (None, "none")}
    assert got == want


def test_short_notices(spark):
    forms = [
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("All rights reserved.", "proprietary"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("Released under the MIT License.", "MIT"),
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("Copyright 2020 Foo. All rights reserved.", "proprietary"),
        ("Copyright (c) 2020 Foo, all rights reserved", "proprietary"),
        ("// SPDX-License-Identifier: MIT", "MIT"),
        ("# SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
        ("SPDX-License-Identifier: Unheard-Of-1.0", None),
        ("You need a licence to drive a car.", None),
    ]
    rest = cases.prose(random.Random(41), 80)
    docs = spark.createDataFrame([(f"/d/{i}", f"{rest}\n{x}\n{rest}") for i, (x, _) in enumerate(forms)], "path string, text string")
    got = {r["path"]: r["licence"] for r in licenses.licences(docs).collect()}
    assert got == {f"/d/{i}": k for i, (_, k) in enumerate(forms)}


# Token counts


def test_batches_count_once(spark):
    rollup = token_counts.Rollup(spark, scratch_path(spark, "rollup"))
    assert rollup.totals().collect() == []
    docs = spark.createDataFrame([("a", "en", 5, 6), ("a", "en", 7, 7), (None, None, 0, None)], "source string, lang string, n long, m long")
    assert rollup.commit("one", token_counts.inserts(docs, "v1", "n"))
    assert not rollup.commit("one", token_counts.inserts(docs, "v1", "n"))
    assert sorted(map(str, map(tuple, rollup.totals().collect()))) == ["('a', 'en', 'v1', 2, 12)", "(None, None, 'v1', 1, 0)"]
    rollup.compact()
    assert not rollup.commit("one", token_counts.inserts(docs, "v1", "n"))
    rollup.commit("two", token_counts.revisions(docs, ("v1", "n"), ("v2", "m")))
    rollup.commit("three", token_counts.deletes(docs.filter("n = 5"), "v2", "m"))
    assert sorted(map(str, map(tuple, rollup.totals().collect()))) == ["('a', 'en', 'v2', 1, 7)", "(None, None, 'v2', 1, 0)"]
    rollup.compact()
    assert rollup.committed() == ["one", "three", "two"] and rollup.totals().count() == 2


def test_broken_batch_is_written_again(spark):
    path = scratch_path(spark, "rollup")
    rollup = token_counts.Rollup(spark, path)
    docs = spark.createDataFrame([("a", "en", 5)], "source string, lang string, n long")
    token_counts.inserts(docs, "v1", "n").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/batch-x")
    assert rollup.committed() == [] and rollup.totals().collect() == []
    assert rollup.commit("x", token_counts.inserts(docs, "v1", "n"))
    assert [r["tokens"] for r in rollup.totals().collect()] == [5]


def test_counts_of_awkward_rows(spark):
    for r in token_counts.count_corpus(cases.documents(spark), VOCABULARY).collect():
        assert r["bpe"] is not None and r["words"] is not None and r["marked"] >= r["words"] * 0
    assert token_counts.count_corpus(cases.nothing(spark), VOCABULARY).collect() == []


def test_documents_inherit_the_licence_of_their_source(spark, tmp_path):
    from rowsmith.llm.queries import op9_licences

    whole = {k: v[0] for k, v in licenses.whole_texts().items()}
    rows = [
        (1, "a", whole["MIT"]), (2, "a", "plain words"), (3, "a", None), (4, "a", "Licensed under the Apache License, Version 2.0."),
        (5, "b", "plain words"), (6, "b", "Released under the MIT License."), (7, None, "plain words"), (None, "a", "plain words"),
        (8, "c", whole["MIT"]), (9, "c", whole["BSD-3-Clause"]), (10, "c", "plain words"), (2, "a", "plain words"),
    ]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r["doc_id"] or 0), r["licence"], r["origin"]) for r in op9_licences(spark, str(tmp_path)).collect())
    assert got == [
        (0, "MIT", "inherited"), (1, "MIT", "own"), (2, "MIT", "inherited"), (2, "MIT", "inherited"), (3, "MIT", "inherited"),
        (4, "Apache-2.0", "own"), (5, None, "none"), (6, "MIT", "own"), (7, None, "none"),
        (8, "MIT", "own"), (9, "BSD-3-Clause", "own"), (10, None, "disputed"),
    ]
