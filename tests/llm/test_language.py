import random

import numpy as np

from rowsmith.llm import language_id
from tests.llm import cases

SYLLABLES = {"xx": ["ba", "do", "ki", "zu"], "yy": ["été", "oui", "ça", "là"], "zz": ["straß", "über", "ich", "und"]}


def made(n=240):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = "xyz"[i % 3] * 2
        rows.append((i, " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(40)), lang))
    return rows


def test_held_out_rows_are_recognised(spark):
    docs = spark.createDataFrame(made(), "doc_id long, text string, lang string").repartition(3)
    got = language_id.predict_languages(docs).collect()
    truth = {i: lang for i, _, lang in made()}
    held = [r for r in got if r["held_out"]]
    assert 40 < len(held) < 120
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_repeated_rows_lose_no_language(spark):
    many = spark.range(20_000).selectExpr("id + 1000 doc_id", "concat('the house and the garden ', cast(id % 3 as string)) text", "'en' lang")
    alone = language_id.predict_languages(many).groupBy("lang_pred").count().collect()
    assert [tuple(r) for r in alone] == [("en", 20_000)]
    few = [(i, text, lang) for i, text, lang in made(60) if lang == "zz"]
    both = many.unionByName(spark.createDataFrame(few, "doc_id long, text string, lang string"))
    got = language_id.predict_languages(both).filter("doc_id >= 1000").groupBy("lang_pred").count().collect()
    assert [tuple(r) for r in got] == [("en", 20_000)]


def test_sample_is_the_lowest_hashes_of_each_language(spark):
    rows = [(f"text {i % 700}", "a") for i in range(3_000)] + [("same", "b")] * 900 + [(f"t{i}", "c") for i in range(5)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    h = language_id.F.shiftrightunsigned(language_id.F.xxhash64(language_id.F.lit(language_id.SEED), "text"), 11)
    hashes = {r["text"]: r["h"] for r in docs.select("text", h.alias("h")).distinct().collect()}
    want = []
    for lang in "abc":
        texts = sorted({t for t, x in rows if x == lang}, key=hashes.get)
        want += [(lang, t) for t in texts[:50]]
    assert language_id.training_sample(docs, texts=50) == want


def test_labels_of_held_out_rows_are_never_read(spark):
    docs = spark.createDataFrame(made(90), "doc_id long, text string, lang string")
    spoiled = docs.withColumn("lang", language_id.F.when(~language_id.held_out(), language_id.F.col("lang")).otherwise("??"))
    a = sorted(map(tuple, language_id.predict_languages(docs).collect()))
    assert a == sorted(map(tuple, language_id.predict_languages(spoiled).collect()))


def test_awkward_rows(spark):
    got = language_id.predict_languages(cases.documents(spark)).collect()
    assert len(got) == cases.documents(spark).count()
    for r in got:
        if r["doc_id"] in (0, 1, 2):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        assert r["held_out"] is not None
    assert language_id.predict_languages(cases.nothing(spark)).collect() == []
    unlabelled = cases.documents(spark).withColumn("lang", language_id.F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.predict_languages(unlabelled).collect()} == {"und"}


def test_gradients():
    net = language_id.ByteNetwork(["a", "b"])
    rng = np.random.default_rng(1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rows, labels = rng.integers(0, 256, (3, 20)).astype(np.uint8), np.array([0, 1, 0])
    grads = net._gradients(rows, labels)
    loss = lambda: -net.log_probabilities(rows)[np.arange(3), labels].mean()
    for name, at in (("filter", (0, 0)), ("out", (3, 1)), ("bias", (5,)), ("embed", (int(rows[0, 3]), 1))):
        w, step = net.weights[name], 1e-5
        w[at] += step
        up = loss()
        w[at] -= 2 * step
        down = loss()
        w[at] += step
        assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-4


def test_windows_hold_the_whole_text():
    data = bytes(range(1, 200)) * 3
    rows = language_id.windows_of(data)
    assert rows.reshape(-1)[: len(data)].tobytes() == data and not rows.reshape(-1)[len(data) :].any()
    assert len(language_id.windows_of(b"")) == 0
