"""Data selection by importance resampling over hashed n-grams.

Two bag-of-n-grams models, one of the target text and one of the raw text, count words and
word pairs in ``BUCKETS`` hashed buckets. A document's weight is the ratio of its likelihoods under both,
and a sample without replacement in proportion to the weights is drawn by adding
Gumbel noise to their logarithms and taking the k largest sums.

All documents enter the raw model and all target documents the target model. Counting combines in the
tasks, so the shuffle holds a row per bucket and task. The k largest are found by counting rows in
equal cells of the range of sums and splitting the cell of the k-th again, never by a global sort.

Rows that repeat each other are numbered where they stand (file and place in the written table of weights), and the number enters
their noise, so copies are drawn one by one. A 63-bit hash of id, text and number follows the sum and decides
between equal sums, so exactly k rows are taken.

Defined cases. A null or empty text has no n-grams, log weight 0. The noise hangs on id, text, seed and the number
among equal rows alone. Rows without an id have no label; they are never shuffled by it. Without target rows
both models are equal.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowsmith.llm.common import ascii_lower, join_split, materialise

BUCKETS = 10_000
SHARE = 0.8
SEED = 17
CELLS = 4_096
SCALE = 1 << 20  # steps of a sum within one unit of log weight


def bucket_array(text: Column, buckets: int = BUCKETS) -> Column:
    """Hashed words and word pairs of a text, repeats included."""
    words = F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    pair = lambda w: F.transform(
        w, lambda x, i: F.when(i > 0, F.pmod(F.xxhash64(F.get(w, i - 1), x), F.lit(buckets)).cast("int"))
    )
    return F.transform(
        F.array(words),
        lambda w: F.concat(
            F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int")),
            F.filter(pair(w), lambda b: b.isNotNull()),
        ),
    )[0]


def fit_weights(rows: DataFrame, text_col: str, target_col: str, buckets: int = BUCKETS) -> list[float]:
    """Log ratio of the target's and the raw text's share of every bucket (one added to every count)."""
    grams = rows.select(F.explode(bucket_array(F.col(text_col), buckets)).alias("b"), F.col(target_col).alias("t"))
    counts = grams.groupBy("b").agg(
        F.count(F.lit(1)).alias("raw"), F.sum(F.when(F.col("t"), 1).otherwise(0)).alias("target")
    )
    found = {r["b"]: (r["raw"], r["target"]) for r in counts.collect()}  # a row per bucket
    raw = sum(x for x, _ in found.values()) + buckets
    target = sum(y for _, y in found.values()) + buckets
    if target == buckets:
        return [0.0] * buckets
    out = []
    for b in range(buckets):
        x, y = found.get(b, (0, 0))
        out.append(math.log((y + 1) / target) - math.log((x + 1) / raw))
    return out


def log_weight(text: Column, weights: list[float]) -> Column:
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    return F.aggregate(bucket_array(text, len(weights)), F.lit(0.0), lambda s, b: s + F.get(table, b))


def gumbel(*cols: Column | str, seed: int = SEED) -> Column:
    """Gumbel noise from the hash of the given columns."""
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 12).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(unit))


def top_limit(scored: DataFrame, value: str, k: int) -> int | None:
    """The k-th largest of a long column; None if there are fewer than k rows."""
    low, high, n = scored.agg(F.min(value), F.max(value), F.count(value)).first()
    if k <= 0 or n < k:
        return None
    while low < high:
        step = max(1, -(-(high - low + 1) // CELLS))
        inside = scored.filter(F.col(value).between(low, high))
        cell = F.floor((F.col(value) - F.lit(low)) / F.lit(step)).cast("int") if step > 1 else (F.col(value) - F.lit(low)).cast("int")
        cells = {r["cell"]: (r["n"], r["lo"], r["hi"]) for r in inside.groupBy(cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")
        ).collect()}
        for c in sorted(cells, reverse=True):
            if k <= cells[c][0]:
                low, high = cells[c][1], cells[c][2]
                break
            k -= cells[c][0]
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    quality_col: str = "quality",
    share: float = SHARE,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, log_weight, noise, selected (``share`` of all rows).

    The target text is that of documents with a label of quality 1.
    """
    good = labels.filter((F.col(quality_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # The labels grow with the documents, so they are never broadcast; the texts move once.
    known = rows.filter("id is not null").join(good.withColumn("t", F.lit(True)).hint("merge"), "id", "left")
    unknown = rows.filter("id is null").withColumn("t", F.lit(None).cast("boolean"))
    weights = fit_weights(known.unionByName(unknown), "text", "t", buckets)
    scored = with_noise(rows.withColumn("log_weight", log_weight(F.col("text"), weights)), seed)
    k = math.ceil(share * scored.count())
    limit = top_limit(scored, "sum", k)
    if limit is None:
        selected = F.lit(True)
    else:
        # Of the rows whose sum is the limit, those with the largest hash fill what is left.
        above, level = scored.agg(F.count_if(F.col("sum") > limit), F.count_if(F.col("sum") == limit)).first()
        selected = F.col("sum") > limit
        if above + level == k:
            selected = F.col("sum") >= limit
        else:
            last = top_limit(scored.filter(F.col("sum") == limit), "h", k - above)
            selected = selected | ((F.col("sum") == limit) & (F.col("h") >= last))
    return scored.select(F.col("id").alias(id_col), "log_weight", "noise", selected.alias("selected"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``number`` to a written table with a column ``key``: 0, 1, 2… among the rows of a key.

    Keys that occur once are 0 and are not looked up. Rows of a key are numbered within their file, and the counts of
    the files before are added, so the rows of a common key are never brought together.
    """
    many = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if many.isEmpty():
        return rows.withColumn("number", F.lit(0).cast("long"))
    many = materialise(many, "copies")
    placed = rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    copies = join_split(placed.select("key", "file", "row"), many, "key", "n")
    inside = Window.partitionBy("key", "file").orderBy("row")
    files = Window.partitionBy("key").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    before = copies.groupBy("key", "file").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("key", "file", F.coalesce(F.sum("n").over(files), F.lit(0)).alias("before"))
    numbers = copies.withColumn("i", F.row_number().over(inside) - 1).join(before, ["key", "file"])
    numbers = numbers.select("file", "row", (F.col("i") + F.col("before")).alias("number"))
    all_rows = placed.join(numbers, ["file", "row"], "left").drop("file", "row")
    return materialise(all_rows.withColumn("number", F.coalesce("number", F.lit(0).cast("long"))), "numbered")


def with_noise(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Table (id, log_weight, noise, h, sum) of rows (id, text, log_weight); equal rows get noise of their own."""
    key = F.struct(F.col("id"), F.xxhash64("text"), F.xxhash64(F.lit(seed), "text"), F.length("text"))
    numbered = _numbered(materialise(rows.select("id", "log_weight", key.alias("key")), "weights"))
    noisy = numbered.select("id", "log_weight", gumbel("key", "number", seed=seed).alias("noise"), _order("key", "number", seed=seed).alias("h"))
    steps = F.floor((F.col("log_weight") + F.col("noise")) * SCALE).cast("long")
    return noisy.withColumn("sum", steps * 1024 + F.shiftright("h", 53).cast("long"))


def _order(*cols: str, seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), *cols), 1)
