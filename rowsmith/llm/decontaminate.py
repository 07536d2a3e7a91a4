"""Benchmark passages in documents by a Wu-Manber search over words.

The symbols of the search are words, so a block of two words is rare in texts that hold no
benchmark passage and most looks into the shift table skip nine words. Where the shift is zero, the
hash of the block picks the bucket of test windows that end in it, and each window of the
bucket is compared word by word.

The benchmark is read in blocks of bounded size, each collected and broadcast on its own. A pass
searches every document for the windows of up to ``PASS_BLOCKS`` blocks, without a shuffle, and
merges the hits per row. Between passes the rows are written with their hits, and the blocks
of the pass before are let go, so neither the driver nor a worker ever holds the whole benchmark.

Defined cases. Null and empty texts have no words and no hits; an item without words has no
window; a repeated or null item_id counts as one item (null sorts as the empty string, and is
left out of the list). Repeated rows are judged each on its own. Extra columns stay.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.llm.common import hidden, materialise, sha256_hex, text_batches

WINDOW_WORDS = 10
BLOCK_CHARS = 16_000_000  # benchmark text that is broadcast at once
PASS_BLOCKS = 4  # blocks that a pass holds

# Bytes of words stay (A-Z as a-z), all others become spaces: digits, letters, all beyond ASCII.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Search:
    """Shift tables and buckets for windows of one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.windows: dict[tuple[bytes, ...], set[str]] = defaultdict(set)

    def add(self, window: tuple[bytes, ...], item: str) -> None:
        self.windows[window].add(item)

    def build(self) -> Search:
        b, m = self.block, self.length
        self.skip = m - b + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[int, dict[bytes, list[tuple[bytes, ...]]]] = {}
        for window in self.windows:
            for end in range(b, m + 1):
                block = window[end - b : end]
                if m - end < self.shift.get(block, self.skip):
                    self.shift[block] = m - end
            self.bucket.setdefault(hash(window[-b:]), defaultdict(list))[window[0]].append(window)
        return self

    def find(self, words: list[bytes]) -> Iterable[tuple[int, tuple[bytes, ...]]]:
        """(first word, window) of every occurrence, in order."""
        b, m, skip, shift = self.block, self.length, self.skip, self.shift
        end, size = m, len(words)
        while end <= size:
            block = tuple(words[end - b : end])
            step = shift.get(block, skip)
            if step:
                end += step
                continue
            start = end - m
            for window in self.bucket.get(hash(block), {}).get(words[start], ()):
                if all(x == y for x, y in zip(window, words[start:end])):
                    yield start, window
            end += 1


class Benchmark:
    """All windows of one block of items, by length."""

    def __init__(self, items: Iterable[tuple[str, str | None]], window_words: int):
        searches: dict[int, Search] = {}
        for item, text in items:
            words = words_of(text)
            length = min(window_words, len(words))
            for at in range(len(words) - length + 1 if length else 0):
                searches.setdefault(length, Search(length)).add(tuple(words[at : at + length]), item)
        self.searches = [searches[n].build() for n in sorted(searches)]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of hit words (end exclusive) and the items found."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for search in self.searches:
            for start, window in search.find(words):
                spans.append((start, start + search.length))
                items |= search.windows[window]
        merged: list[tuple[int, int]] = []
        for start, end in sorted(spans):
            if merged and start <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((start, end))
        return merged, items


FOUND = "n_words long, spans array<struct<start:long,stop:long>>, items array<string>"


def _searcher(sent: Broadcast, window_words: int):
    built: list[Benchmark] = []
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    @F.arrow_udf(FOUND)
    def search(texts: pa.Array) -> pa.Array:
        if not built:
            built.append(Benchmark(sent.value, window_words))
        counts, spans, items = [], [], []
        for text in texts:
            words = words_of(text.as_py())
            where, which = built[0].hits(words)
            counts.append(len(words))
            spans.append([{"start": a, "stop": b} for a, b in where])
            items.append(sorted(which))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(items, pa.list_(pa.string()))],
            ["n_words", "spans", "items"],
        )

    return search


def _hit_words(spans: Column) -> Column:
    """Words covered by spans that may overlap."""
    zero = F.lit(0).cast("long")
    return F.aggregate(
        F.array_sort(spans),
        F.struct(zero.alias("total"), zero.alias("upto")),
        lambda s, x: F.struct(
            (s["total"] + F.greatest(zero, x["stop"] - F.greatest(s["upto"], x["start"]))).alias("total"),
            F.greatest(s["upto"], x["stop"]).alias("upto"),
        ),
        lambda s: s["total"],
    )


def mark_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    name: str = "found",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window_words: int = WINDOW_WORDS,
) -> DataFrame:
    """Add a struct column ``name``: n_words, n_hit, spans of hit words, items, n_items, contaminated."""
    text_batches(docs.sparkSession)
    tests = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    total = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_CHARS))
    words, hits, which = hidden("words"), hidden("spans"), hidden("items")
    out = docs
    for first in range(0, blocks, PASS_BLOCKS):
        parts, held = [], []
        for block in range(first, min(first + PASS_BLOCKS, blocks)):
            rows = tests.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
            held.append(docs.sparkSession.sparkContext.broadcast([(r["item"] or "", r["text"]) for r in rows]))
            part = hidden("block")
            out = out.withColumn(part, _searcher(held[-1], window_words)(F.col(text_col)))
            parts.append(part)
        before = [F.struct(F.col(hits).alias("spans"), F.col(which).alias("items"))] if first else []
        found = [*before, *map(F.col, parts)]
        out = out.withColumns(
            {
                words: F.col(parts[0])["n_words"],
                hits: F.flatten(F.array(*[f["spans"] for f in found])),
                which: F.array_distinct(F.flatten(F.array(*[f["items"] for f in found]))),
            }
        ).drop(*parts)
        if first + PASS_BLOCKS < blocks:
            out = materialise(out, "searched")
            for sent in held:
                sent.destroy()
    n_hit = _hit_words(F.col(hits))
    result = F.struct(
        F.col(words).alias("n_words"),
        n_hit.alias("n_hit"),
        F.col(hits).alias("spans"),
        F.array_sort(F.filter(which, lambda x: x != "")).alias("items"),
        F.size(which).cast("long").alias("n_items"),
        (n_hit > 0).alias("contaminated"),
    )
    return out.withColumn(name, result).drop(words, hits, which)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    found = mark_contaminated(docs.select(id_col, text_col), benchmark, "found", text_col)
    return found.select(
        id_col,
        "found.n_words",
        "found.n_hit",
        "found.n_items",
        sha256_hex(F.array_join("found.items", ",")).alias("items_sha256"),
        "found.contaminated",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that hold no benchmark window."""
    found = hidden("found")
    return mark_contaminated(docs, benchmark, found, text_col).filter(~F.col(found)["contaminated"]).drop(found)
