"""One query per operator, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsmith.llm import (
    bpe,
    decontaminate,
    fill_in_middle,
    language_id,
    licenses,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    secrets,
    simhash,
    token_counts,
    token_files,
)
from rowsmith.llm.common import join_split, materialise, table
from rowsmith.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_copies(table(spark, folder, "documents"))


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secret spans of every document."""
    return secrets.secret_spans(table(spark, folder, "documents"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after four batches: load, new word rule, exact copies out, and the last sent twice.

    Copies are rows of equal text (by SHA-256; null is the empty text); the one with the smallest id stays, a row without an id only where
    no copy has one.
    """
    docs = materialise(token_counts.count_corpus(table(spark, folder, "documents"), VOCABULARY), "counts")
    rollup = token_counts.Rollup(spark, scratch_path(spark, "rollup"))
    load = token_counts.inserts(docs, "words/1", "words").unionByName(token_counts.inserts(docs, "byte_bpe_50k", "bpe"))
    rollup.commit("load", load)
    rollup.commit("words-2", token_counts.revisions(docs, ("words/1", "words"), ("words/2", "marked")))
    rollup.compact()
    # The row that stays is told by its number, as ids may be null or repeat.
    stays = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))["row"]
    first = docs.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n"), stays.alias("stays")).filter("n > 1")
    out = join_split(docs, materialise(first, "copies"), "text_sha256", "n").filter("row <> stays")
    gone = token_counts.deletes(out, "words/2", "marked").unionByName(token_counts.deletes(out, "byte_bpe_50k", "bpe"))
    rollup.commit("copies", gone)
    rollup.commit("copies", gone)
    return rollup.totals()


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of benchmark windows in every document."""
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of ids and decoded text of every document."""
    return bpe.round_trip(table(spark, folder, "documents"), VOCABULARY)


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Write the token files and read every document back."""
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, folder, "documents"), path, VOCABULARY)
    return token_files.document_tokens(spark, path)


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.judge(table(spark, folder, "documents"))


def op8_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, noise and selection of every document."""
    return quality_classifier.resample(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licence of every document. A document is the file <source>/<doc_id>: a whole licence speaks for the documents of its source."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("_")) for c in ("source", "doc_id")]
    path = F.concat_ws("/", F.lit(""), *names)
    return licenses.licences(table(spark, folder, "documents").withColumn("path", path), keep=("doc_id",))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document."""
    return language_id.predict_languages(table(spark, folder, "documents"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document, a tenth of which have runs planted by their id."""
    return periodic_runs.run_report(periodic_runs.plant_runs(table(spark, folder, "documents")))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Form, cuts and digests of every document, its middle moved to the end."""
    return fill_in_middle.transform_report(table(spark, folder, "documents"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    return packing.pack_report(table(spark, folder, "documents"), VOCABULARY)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_simhash,
        op2_secrets,
        op3_token_counts,
        op4_decontaminate,
        op5_bpe,
        op6_token_files,
        op7_quality_rules,
        op8_importance_resampling,
        op9_licences,
        op10_language,
        op11_periodic_runs,
        op12_fill_in_middle,
        op13_packing,
        pipeline,
    )
    return {f.__name__: f for f in found}


def _sql_words(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


# Windows of both sides as strings; only lengths that an item has are cut out of documents.
OP4_SQL = f"""
WITH items AS (SELECT item_id, {_sql_words('text')} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_sql_words('text')} AS w FROM documents),
doc_windows AS (
  SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size)),
found AS (SELECT r, i, size, item_id FROM doc_windows JOIN item_windows USING (size, win)),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM found) GROUP BY r),
which AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN which USING (r)
"""


OP12_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM docs),
cuts AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
pieces AS (
  SELECT doc_id, t, n, form, a, b - a AS m, substr(t, 1, a) AS x, substr(t, a + 1, b - a) AS y, substr(t, b + 1, n - b) AS z FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN m END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
                        WHEN 'spm' THEN '<S>' || z || '<P>' || x || '<M>' || y ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM pieces
"""


def llm_sql() -> dict[str, str]:
    """SQL can say the benchmark search and the cuts; the others are held against brute force in tests/llm."""
    return {"op4_decontaminate": OP4_SQL, "op12_fill_in_middle": OP12_SQL}
