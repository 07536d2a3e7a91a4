"""Token counts as rollups that are kept up by signed changes.

A change is a row (source, lang, tokenizer, docs, tokens) with signed numbers: an insert adds, a delete
takes away, a revised count does both. A batch of changes is summed and written as one folder
named after its id; the folder counts only once its success mark is there. A batch that is sent
again is recognised by its id and changes nothing, and one that broke off half-way is written anew,
so batches may be retried at will. Totals are the sums of all committed batches; ``compact`` folds
them into one table and remembers their ids.

Defined cases. Null sources, languages and versions are groups of their own; null texts have no tokens.
A null number counts as zero. Groups whose documents and tokens sum to zero are left out.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowsmith.llm.bpe import encoder
from rowsmith.llm.common import sha256_hex, text_batches

GROUP = ("source", "lang", "tokenizer")
CHANGE = "source string, lang string, tokenizer string, docs long, tokens long"


def bpe_count(text: Column, path: str) -> Column:
    """Number of ids of a text under a byte-level vocabulary file."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        cache, _ = encoder(path)
        return pa.array(np.fromiter((len(x) // 4 for x in cache.ids(t.as_py() for t in texts)), np.int64, len(texts)))

    return of(text)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def inserts(counted: DataFrame, tokenizer: str, tokens: str, sign: int = 1) -> DataFrame:
    """Changes that add (or with sign -1 take away) the documents of ``counted``."""
    return counted.select(
        "source",
        "lang",
        F.lit(tokenizer).alias("tokenizer"),
        F.lit(sign).cast("long").alias("docs"),
        (F.col(tokens) * sign).cast("long").alias("tokens"),
    )


def deletes(counted: DataFrame, tokenizer: str, tokens: str) -> DataFrame:
    return inserts(counted, tokenizer, tokens, -1)


def revisions(counted: DataFrame, old: tuple[str, str], new: tuple[str, str]) -> DataFrame:
    """Changes from one (tokenizer, count column) to another for the same documents."""
    return deletes(counted, *old).unionByName(inserts(counted, *new))


class Rollup:
    """Totals by source, language and tokenizer version below one folder of any store."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _store(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _done(self, folder: str) -> bool:
        return self._store().exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS"))

    def _folders(self, prefix: str) -> list[str]:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{prefix}*/_SUCCESS")
        found = self._store().globStatus(at) or []
        return sorted(str(s.getPath().getParent().getName()) for s in found)

    def committed(self) -> list[str]:
        """Ids of all batches that count, folded ones too."""
        folded = self._snapshot()
        names = {n.removeprefix("batch-") for n in self._folders("batch-")}
        if folded:
            names |= {r["id"] for r in self.spark.read.parquet(f"{self.path}/{folded}/ids").collect()}
        return sorted(names)

    def _known(self, batch: str) -> bool:
        """Whether one batch counts already; ids of other batches stay where they are."""
        if self._done(f"{self.path}/batch-{batch}"):
            return True
        folded = self._snapshot()
        ids = self.spark.read.parquet(f"{self.path}/{folded}/ids") if folded else None
        return ids is not None and not ids.filter(F.col("id") == batch).isEmpty()

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False, and nothing changed, if its id is committed already."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"not a batch id: {batch!r}")
        if self._known(batch):
            return False
        summed = changes.groupBy(*GROUP).agg(
            *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("docs", "tokens")]
        )
        summed.write.mode("overwrite").parquet(f"{self.path}/batch-{batch}")
        return True

    def _snapshot(self) -> str | None:
        found = self._folders("totals-")
        return found[-1] if found else None

    def totals(self) -> DataFrame:
        folded = self._snapshot()
        inside = set()
        parts = []
        if folded:
            inside = {r["id"] for r in self.spark.read.parquet(f"{self.path}/{folded}/ids").collect()}
            parts.append(f"{self.path}/{folded}/rows")
        parts += [f"{self.path}/{n}" for n in self._folders("batch-") if n.removeprefix("batch-") not in inside]
        rows = self.spark.read.schema(CHANGE).parquet(*parts) if parts else self.spark.createDataFrame([], CHANGE)
        return (
            rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 or tokens <> 0")
        )

    def compact(self) -> None:
        """Fold all committed batches into one table. The last written mark makes it count."""
        ids = self.committed()
        if not ids:
            return
        name = f"totals-{len(self._folders('totals-')):08d}"
        self.totals().write.mode("overwrite").parquet(f"{self.path}/{name}/rows")
        self.spark.createDataFrame([(i,) for i in ids], "id string").write.mode("overwrite").parquet(f"{self.path}/{name}/ids")
        self._store().create(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")).close()


def count_corpus(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Counts of every document: source, lang, words, marked words, bpe, the digest of the text and a number of the row."""
    text_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        "source",
        "lang",
        F.monotonically_increasing_id().alias("row"),
        sha256_hex(text).alias("text_sha256"),
        word_count(F.col("text")).alias("words"),
        F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]")).cast("long").alias("marked"),
        bpe_count(F.col("text"), vocabulary).alias("bpe"),
    )
