"""Near copies by SimHash fingerprints, searched with deletion-variant signatures.

Two fingerprints that differ in at most ``max_bits`` bits are linked. Cut into
``max_bits // 2 + 1`` segments, such a pair has a segment that differs in at most one bit, so
the two share a variant of that segment with one bit blanked out. Every distinct fingerprint is
indexed under all its variants (64 for 64 bits), rows of one variant meet in a sorted
partition, and the whole fingerprints are compared there.

Scale. Exact copies collapse to one fingerprint before the search. A pair counts only under the
first variant that it shares, and each task keeps a spanning forest of its links, so a dense group
gives about as many links as it has members. Variants of a segment value with more than ``HOT_ROWS``
fingerprints, however many there are, are cut into cells: the other bits fall into one piece more than
bits may differ, so a linked pair has an equal piece, and each row goes to five cells, each about a
three-hundredth of the value. Only a cell that is still too large is dealt into pairs of blocks, in which each row is
copied once a block. Lists of such keys are broadcast only if they are short. Links are joined into components by contracting the graph
on written tables. Neither links nor fingerprints go through the driver.

Defined cases. Null, empty and blank texts have fingerprint zero and are linked like others. A row
keeps its place when doc_ids repeat or are null; component_id is null only when no row of the
component has an id. Extra columns are ignored by ``near_copies`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from rowsmith.llm.common import HOT_ROWS, hidden, join_split, materialise, shuffle_width, text_batches

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
BITS = 64
BLOCK_ROWS = 1_000  # members of a crowded cell in one block, about
SMALL_ROWS = 200_000  # keys that are broadcast at most
TILE = 1_024


def text_fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    take = min(shingle_words, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(joined[a:b], HASH_SEED) for a, b in zip(starts[: len(words) - take + 1].tolist(), ends[take - 1 :].tolist())],
        np.uint64,
        len(words) - take + 1,
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        rows = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """Fingerprint column: the 64 bits as a signed long."""

    @F.arrow_udf(LongType())
    def of(texts: pa.Array) -> pa.Array:
        found = np.fromiter((text_fingerprint(t.as_py(), shingle_words) for t in texts), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return of(text)


def segments(max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """(shift, width) of the segments, one of which differs in at most one bit in every linked pair."""
    count = max(2, max_bits // 2 + 1)
    edges = [round(i * BITS / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


class Variants:
    """Numbers of the one-wildcard variants: segment by segment, bit by bit."""

    def __init__(self, max_bits: int):
        self.max_bits = max_bits
        self.parts = segments(max_bits)
        self.first = np.cumsum([0] + [w for _, w in self.parts])

    def keys(self, fp: Column) -> Column:
        """Array of (variant number, segment value with that bit cleared) in one long each."""
        out = []
        for s, (shift, width) in enumerate(self.parts):
            value = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))
            for p in range(width):
                out.append(self.key(int(self.first[s]) + p, value.bitwiseAND(F.lit(~(1 << p)))))
        return F.array(*out)

    def cells(self, fp: Column, key: Column) -> Column:
        """Array of (piece number, piece) of the bits outside the segment of ``key``.

        There is a piece more than bits may differ, so a linked pair of the key has an equal piece.
        """
        out = None
        for s, (shift, width) in enumerate(self.parts):
            upto = shift + width
            rest = F.shiftrightunsigned(fp, upto).bitwiseOR(F.shiftleft(fp, BITS - upto)) if upto < BITS else fp
            edges = [round(i * (BITS - width) / (self.max_bits + 1)) for i in range(self.max_bits + 2)]
            pieces = F.array(
                *[
                    F.shiftrightunsigned(rest, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).bitwiseOR(F.lit(i << 48))
                    for i, (a, b) in enumerate(zip(edges, edges[1:]))
                ]
            )
            here = F.shiftright(key, 48) < F.lit(int(self.first[s + 1]))
            out = F.when(here, pieces) if out is None else out.when(here, pieces)
        return out

    @staticmethod
    def key(variant: int, value: Column) -> Column:
        return value.bitwiseOR(F.lit(variant << 48))

    def first_shared(self, diff: np.ndarray) -> np.ndarray:
        """Number of the first variant that two fingerprints share, from their exclusive or."""
        found = np.full(len(diff), -1, np.int64)
        for s, (shift, width) in reversed(list(enumerate(self.parts))):
            part = (diff >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            ones = np.bitwise_count(part)
            at = np.where(ones == 1, np.bitwise_count(part - np.uint64(1)), 0)
            found = np.where(ones <= 1, int(self.first[s]) + at, found)
        return found


class Forest:
    """Keeps the links that join two parts not yet joined in this task."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}
        self.kept: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        for a, b in zip(left.tolist(), right.tolist()):
            x, y = self.root(a), self.root(b)
            if x != y:
                self.up[x] = y
                self.kept.append((a, b))

    def take(self) -> list[tuple[int, int]]:
        out, self.kept = self.kept, []
        return out


def _links_of(groups: tuple[np.ndarray, ...], rules: Variants, forest: Forest) -> None:
    """Compare the members of each complete group: rows sorted by (key, cell, side)."""
    key, cell, side, fp = groups
    if not len(key):
        return
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])))
    begin = np.flatnonzero(new)
    length = np.diff(np.concatenate((begin, [len(key)])))
    group = np.cumsum(new) - 1
    bits = fp.view(np.uint64)
    variant = key >> 48

    def check(left: np.ndarray, right: np.ndarray) -> None:
        diff = bits[left] ^ bits[right]
        near = np.flatnonzero(np.bitwise_count(diff) <= rules.max_bits)
        if len(near):
            near = near[rules.first_shared(diff[near]) == variant[left[near]]]
            forest.add(fp[left[near]], fp[right[near]])

    # Sides are in order, so the last tells whether all pairs of a group count. Should two cells have one
    # number, they are compared as one group, which loses nothing.
    whole = side[begin + length - 1] == 2
    plain = whole & (length <= 64)
    rows = np.flatnonzero(plain[group])
    lag = 1
    while len(rows):
        rows = rows[rows + lag < len(key)]
        rows = rows[group[rows] == group[np.minimum(rows + lag, len(key) - 1)]]
        check(rows, rows + lag)
        lag += 1
    for g in np.flatnonzero(~plain):
        rows = np.arange(begin[g], begin[g] + length[g])
        ones, twos = (rows, rows) if whole[g] else (rows[side[rows] == 0], rows[side[rows] == 1])
        for i in range(0, len(ones), TILE):
            for j in range(i if ones is twos else 0, len(twos), TILE):
                a, b = ones[i : i + TILE], twos[j : j + TILE]
                close = np.bitwise_count(bits[a][:, None] ^ bits[b][None, :]) <= rules.max_bits
                x, y = np.nonzero(np.triu(close, 1) if ones is twos and i == j else close)
                check(a[x], b[y])


def _small(keys: DataFrame) -> DataFrame:
    """A written table of keys, broadcast only if its rows are few; else it is joined by a shuffle."""
    return F.broadcast(keys) if keys.count() <= SMALL_ROWS else keys.hint("merge")


def links(classes: DataFrame, fp: str, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that together join all pairs within ``max_bits`` bits."""
    rules = Variants(max_bits)
    only = classes.select(F.col(fp).alias("fp"))
    values = only.select(
        F.explode(
            F.array(
                *[
                    F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)).bitwiseOR(F.lit(s << 48))
                    for s, (shift, width) in enumerate(rules.parts)
                ]
            )
        ).alias("value")
    )
    hot_values = materialise(values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_ROWS), "hot")
    rows = only.select("fp", F.explode(rules.keys(F.col("fp"))).alias("key"))
    cold = rows.withColumn("cell", F.lit(-1).cast("long")).withColumn("side", F.lit(2))
    if hot_values.isEmpty():
        placed = cold
    else:
        hot_keys = [
            hot_values.filter(F.shiftright("value", 48) == s).select(
                F.explode(
                    F.array(
                        *[
                            rules.key(int(rules.first[s]) + p, F.col("value").bitwiseAND(F.lit((1 << 48) - 1)).bitwiseAND(F.lit(~(1 << p))))
                            for p in range(width)
                        ]
                    )
                ).alias("key"),
            )
            for s, (_, width) in enumerate(rules.parts)
        ]
        every = hot_keys[0]
        for more in hot_keys[1:]:
            every = every.unionByName(more)
        hot = _small(materialise(every.distinct(), "hot_keys"))
        dense = rows.join(hot, "key").select("fp", "key", F.explode(rules.cells(F.col("fp"), F.col("key"))).alias("cell"))
        dense = dense.withColumn("side", F.lit(2))
        crowded = materialise(
            dense.groupBy("key", "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_ROWS), "crowded"
        )
        if not crowded.isEmpty():
            blocks = _small(crowded.select("key", "cell", (F.ceil(F.col("n") / BLOCK_ROWS) + 1).cast("long").alias("blocks")))
            dealt = (
                dense.drop("side")
                .join(blocks, ["key", "cell"])
                .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
                .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
                .select(
                    "fp",
                    "key",
                    F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other")).alias("cell"),
                    F.when(F.col("block") == F.col("other"), 2).otherwise((F.col("block") > F.col("other")).cast("int")).alias("side"),
                )
            )
            dense = dense.join(_small(crowded.select("key", "cell")), ["key", "cell"], "left_anti").unionByName(dealt)
        placed = cold.join(hot, "key", "left_anti").unionByName(dense)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        rest: tuple[np.ndarray, ...] | None = None
        names = ("key", "cell", "side", "fp")
        for batch in batches:
            got = tuple(batch.column(n).to_numpy(zero_copy_only=False) for n in names)
            rest = got if rest is None else tuple(np.concatenate(x) for x in zip(rest, got))
            key, cell = rest[0], rest[1]
            if not len(key):
                continue
            open_group = (key == key[-1]) & (cell == cell[-1])
            start = len(key) - int(np.argmin(open_group[::-1])) if not open_group.all() else 0
            _links_of(tuple(x[:start] for x in rest), rules, forest)
            rest = tuple(x[start:] for x in rest)
            if forest.kept:
                a, b = zip(*forest.take())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        if rest is not None:
            _links_of(rest, rules, forest)
        if forest.kept:
            a, b = zip(*forest.take())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    met = placed.repartition(shuffle_width(classes.sparkSession), "key", "cell").sortWithinPartitions("key", "cell", "side")
    return met.mapInArrow(compare, "a long, b long")


def _order(name: str) -> Column:
    return F.struct(F.xxhash64(name).alias("h"), F.col(name).alias("n"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link, by contracting the graph until no link is left.

    Each round sends a node to the neighbour (or itself) that comes first in a hashed order; a
    constant share of the nodes goes in every round, whatever the shape of the graph.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    both = materialise(both, "links")
    steps: list[DataFrame] = []
    while not both.isEmpty():
        first = F.least(_order("a"), _order("b"))
        step = both.groupBy("a").agg(F.min(first)["n"].alias("to")).withColumnRenamed("a", "node")
        step = materialise(step, "step")
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        both = materialise(
            both.join(left, "a").join(right, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            "links",
        )
    if not steps:
        return both.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0].withColumnRenamed("to", "root")
    for step in steps[1:]:
        onward = step.select(F.col("node").alias("root"), F.col("to").alias("next"))
        found = found.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found


def _classes(prints: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """One row per fingerprint: (fp, copies, low, root, component).

    ``root`` names the component; ``component`` is its smallest id, which two components share where ids repeat.
    """
    classes = materialise(
        prints.groupBy("fp").agg(F.count(F.lit(1)).alias("copies"), F.min(id_col).alias("low")), "classes"
    )
    roots = materialise(components(materialise(links(classes, "fp", max_bits), "found")), "roots")
    member = roots.join(classes, roots["node"] == classes["fp"]).select("fp", "root", "low")
    least = member.groupBy("root").agg(F.min("low").alias("component"))
    linked = member.join(least, "root").select("fp", "root", "component")
    return materialise(
        classes.join(linked, "fp", "left").select(
            "fp",
            "copies",
            "low",
            F.coalesce("root", "fp").alias("root"),
            F.when(F.col("root").isNotNull(), F.col("component")).otherwise(F.col("low")).alias("component"),
        ),
        "components",
    )


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``."""
    text_batches(docs.sparkSession)
    prints = materialise(
        docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle_words).alias("fp")), "prints"
    )
    classes = _classes(prints, "id", max_bits)
    found = join_split(prints, classes.select("fp", "component", "copies"), "fp", "copies")
    return found.select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component one row with its smallest id, if it has any."""
    fp, key = hidden("fp"), hidden("key")
    text_batches(docs.sparkSession)
    # Rows are written with their fingerprints, which are worked out once.
    prints = materialise(docs.withColumn(fp, fingerprint(F.col(text_col), shingle_words)), "prints")
    classes = _classes(prints.select(F.col(id_col).alias("id"), F.col(fp).alias("fp")), "id", max_bits)
    # Of each component the class with its smallest id, a class without any id last, then the first fingerprint.
    first = F.min(F.struct(F.col("low").isNull().alias("none"), "low", "fp"))
    chosen = classes.groupBy("root").agg(first.alias("m")).select(F.col("m.fp").alias(fp), _text_key("m.low").alias(key))
    marked = prints.withColumn(key, _text_key(id_col))
    return marked.join(chosen, [fp, key]).dropDuplicates([fp, key]).select(*docs.columns)


def _text_key(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
