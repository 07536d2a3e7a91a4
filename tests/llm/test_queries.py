import pytest

from rowsmith.llm.queries import llm_queries, llm_sql
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
NAMES = [n for n in llm_queries() if n != "pipeline"]


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_query_equals_its_sql(spark, name):
    assert compare(llm_queries()[name](spark, FOLDER), connect(FOLDER), llm_sql()[name]) == []


@pytest.mark.parametrize("name", NAMES)
def test_query_answers_for_every_document(spark, name):
    found = llm_queries()[name](spark, FOLDER)
    if name != "op3_token_counts":
        docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
        ids = [r["doc_id"] for r in found.select("doc_id").collect()]
        # Packing gives a row per piece.
        assert sorted(set(ids) if name == "op13_packing" else ids) == sorted(r["doc_id"] for r in docs.collect())


def test_token_counts_are_those_of_distinct_texts(spark):
    from tests.llm import brute

    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("source", "lang", "text", "doc_id").collect()]
    first = {}
    for source, lang, text, doc in sorted(docs, key=lambda r: r[3]):
        first.setdefault(text, (source, lang))
    want = {}
    for text, (source, lang) in first.items():
        n, t = want.get((source, lang), (0, 0))
        want[source, lang] = (n + 1, t + len(brute.ids_of(text)))
    rows = llm_queries()["op3_token_counts"](spark, FOLDER).filter("tokenizer = 'byte_bpe_50k'").collect()
    assert {(r["source"], r["lang"]): (r["docs"], r["tokens"]) for r in rows} == want


def test_token_counts_with_null_and_repeated_ids(spark, tmp_path):
    import regex
    from tests.llm import brute

    rows = [
        (5, "a", "en", "one two, three"),
        (3, "b", "de", "one two, three"),
        (3, "b", "de", "one two, three"),
        (None, "c", None, "one two, three"),
        (None, "d", "en", "ohne Nummer"),
        (None, "d", "en", "ohne Nummer"),
        (7, None, "en", None),
        (6, "a", "en", ""),
        (8, "a", "en", "x\u00e9 \u4e2d\u6587!"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stays = {}
    for doc, source, lang, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        stays.setdefault(text or "", (source, lang))
    want = {}
    for text, (source, lang) in stays.items():
        marked = len(regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]", text))
        for tokenizer, tokens in (("words/2", marked), ("byte_bpe_50k", len(brute.ids_of(text)))):
            n, t = want.get((source, lang, tokenizer), (0, 0))
            want[source, lang, tokenizer] = (n + 1, t + tokens)
    found = llm_queries()["op3_token_counts"](spark, str(tmp_path)).collect()
    assert {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in found} == want
