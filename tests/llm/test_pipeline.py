import hashlib
import re

import corpus_pipeline
from rowsmith.llm import quality_rules, secrets
from rowsmith.llm.common import materialise
from rowsmith.session import scratch_path
from tests.llm import brute, cases


def plain_run(spark, docs, items):
    """The stages after quality rules by brute force; the text of the first and fourth by their operators."""
    rows = [(r["doc_id"], r["text"]) for r in quality_rules.keep_good(docs).collect()]
    keep = {}
    for (doc, text), (_, _, comp) in zip(rows, brute.near_copies(rows)):
        if doc == comp:
            keep.setdefault(doc, text)
    clean = [r[0] for r in brute.contamination(list(keep.items()), items) if not r[5]]
    left = spark.createDataFrame([(d, keep[d]) for d in clean], "doc_id long, text string")
    return sorted((r["doc_id"], *brute.round_trip(r["text"])) for r in secrets.redact(left).collect())


def test_run_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()))
    assert got == plain_run(spark, docs, items) and len(got) > 100


def test_stages_keep_columns_and_take_awkward_rows(spark):
    folder = scratch_path(spark, "tables")
    cases.benchmark(spark).write.parquet(f"{folder}/benchmark.parquet")
    for docs in (cases.documents(spark), cases.nothing(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            before = docs.count()
            docs = materialise(stage(spark, docs, folder), name)
            assert docs.count() <= before
            if name != "bpe":
                assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dedup", "decontaminate", "secrets", "bpe"]


def test_secrets_do_not_leave_the_pipeline(spark):
    docs = corpus_pipeline.secrets_stage(spark, cases.documents(spark), "")
    for r in docs.collect():
        assert not re.search("AKIA[A-Z0-9]{12,}", r["text"] or "")
        if r["n_chars"] is not None:
            assert r["n_chars"] == len(r["text"] or "")


def test_digest_of_empty_text():
    assert brute.round_trip(None) == (0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())
