"""Best-fit packing: documents' tokens into as few sequences as possible, reduced by dominance first.

A sequence's contents matter only by their lengths, and lengths are at most the capacity, so the whole
instance is a table of ``capacity`` counts, however many documents there are. Three steps:

1. Tasks encode the documents, cut those over the capacity (the first piece takes what is left over) and write the
   pieces; each piece carries its number among the pieces of its length in its task. Counts per length go to the driver.
2. The driver plans on counts. Dominance reduction after Martello and Toth takes the largest length j and looks for a
   set F of at most three pieces with j that is at least as good as every other set with j. Then some best packing has F
   as a sequence, and F is fixed as often as the counts allow:
   j alone, if nothing fits beside it;
   {j, k}, k the largest that fits, if only one piece fits beside j, if both fill the sequence, or if two others beside j are
   never longer than k;
   {j, k, b}, b the largest that fits beside both, if at most two pieces fit beside j and no two pieces longer than b do.
   Lengths without such a set are set aside; they are packed by best fit, decreasing: each piece goes into the fullest
   open sequence that has room, again on counts.
3. A sequence of equal pieces in equal order is one pattern with a count. Every piece finds its place from its length and its number
   among all pieces of that length, by bisection in the slots of that length.

Size of the plan: fixed patterns, and open groups in best fit, are a few for each length, never for each document.
Numbers within a length are the task's own numbers plus the counts of the tasks before, so no length, however common, is gathered.

Defined cases. A null text is empty: its one piece is the end id. Repeated rows and ids are packed each on their own, null ids
stay, extra columns are ignored, an empty table gives no rows. Ties between lengths do not matter; pieces of equal length are
numbered in the order in which they were written.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rowsmith.llm.common import materialise, text_batches
from rowsmith.llm.library_tokens import library_table

CAPACITY = 1_024
END_ID = 2


@dataclass
class Pattern:
    """``count`` sequences that hold the same pieces: (length, pieces of it), in order."""

    count: int
    pieces: list[tuple[int, int]] = field(default_factory=list)

    @property
    def used(self) -> int:
        return sum(length * n for length, n in self.pieces)


def _dominant(j: int, counts: Mapping[int, int], capacity: int) -> tuple[int, ...] | None:
    """A set with ``j`` that dominates all others with ``j``; ``counts`` has j itself counted off."""
    room = capacity - j
    lengths = sorted(w for w, n in counts.items() if n and w <= room)
    if not lengths:
        return (j,)
    best = lengths[-1]
    smallest = [w for w in lengths[:3] for _ in range(min(3, counts[w]))][:3]
    fit = sum(sum(smallest[: i + 1]) <= room for i in range(len(smallest)))
    if fit == 1 or best == room:
        return (j, best)
    if fit > 2:
        return None
    pairs = []
    for a in lengths:
        rest = [b for b in lengths if b <= room - a and b <= a and counts[b] >= 1 + (a == b)]
        if rest:
            pairs.append((a + rest[-1], a, rest[-1]))
    most, a, b = max(pairs)
    if best >= most:
        return (j, best)
    partner = [w for w in lengths if w <= room - best and counts[w] >= 1 + (w == best)]
    if not partner or best + partner[-1] != most:
        return None
    b = min(best, partner[-1])
    longer = [w for w in lengths if w > b for _ in range(min(2, counts[w]))][:2]
    if len(longer) < 2 or sum(longer) > room:
        return (j, best, partner[-1])
    return None


def reduce_instance(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[list[Pattern], dict[int, int]]:
    """Fixed sequences, and the counts that are left. Some best packing holds all fixed sequences."""
    left = {w: n for w, n in counts.items() if n}
    fixed: list[Pattern] = []
    for j in sorted(left, reverse=True):
        while left.get(j):
            others = {w: n - (w == j) for w, n in left.items()}
            found = _dominant(j, others, capacity)
            if found is None:
                break
            need = {w: found.count(w) for w in dict.fromkeys(found)}
            # What makes the set dominant holds until one of its lengths is used up.
            times = min(left[w] // n for w, n in need.items())
            fixed.append(Pattern(times, list(need.items())))
            for w, n in need.items():
                left[w] -= times * n
                if not left[w]:
                    del left[w]
    return fixed, left


def best_fit(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Best fit, longest first: each piece goes into the fullest sequence that has room for it."""
    by_room: dict[int, list[Pattern]] = {}

    def put(group: Pattern, room: int) -> None:
        by_room.setdefault(room, []).append(group)

    for length in sorted((w for w, n in counts.items() if n), reverse=True):
        n = counts[length]
        for room in sorted(r for r in by_room if r >= length):
            each = room // length
            waiting = by_room.pop(room)
            while waiting and n:
                group = waiting.pop()
                for times, inside in ((min(group.count, n // each), each), (1, n % each if n // each < group.count else 0)):
                    if times and inside:
                        put(Pattern(times, [*group.pieces, (length, inside)]), room - inside * length)
                        group.count -= times
                        n -= times * inside
                if group.count:
                    waiting.append(group)
            if waiting:
                by_room.setdefault(room, []).extend(waiting)
            if not n:
                break
        each = capacity // length
        if n // each:
            put(Pattern(n // each, [(length, each)]), capacity - each * length)
        if n % each:
            put(Pattern(1, [(length, n % each)]), capacity - n % each * length)
    return [group for groups in by_room.values() for group in groups]


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Sequences for so many pieces of every length: the dominant sets first, best fit for what is left."""
    fixed, left = reduce_instance(counts, capacity)
    return fixed + best_fit(left, capacity)


class Slots:
    """Where the r-th piece of a length goes: sequence and offset."""

    def __init__(self, patterns: list[Pattern]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        first = 0
        for pattern in patterns:
            offset = 0
            for length, each in pattern.pieces:
                begin = taken.get(length, 0)
                rows.setdefault(length, []).append((begin, first, each, offset))
                taken[length] = begin + each * pattern.count
                offset += each * length
            first += pattern.count
        self.sequences = first
        self.rows = {length: np.array(r, np.int64) for length, r in rows.items()}

    def place(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            rows = self.rows[length]
            begin, first, each, base = rows[np.searchsorted(rows[:, 0], numbers[at], "right") - 1].T
            inside = numbers[at] - begin
            sequence[at] = first + inside // each
            offset[at] = base + inside % each * length
        return sequence, offset


PIECE = "doc_id long, piece int, start long, length long, ids binary, task int, number long"


def token_pieces(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Written table of pieces with their ids (little-endian, 32 bits), task and number within task and length."""
    text_batches(docs.sparkSession)
    end = struct.pack("<I", end_id)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        table = library_table(vocabulary)
        counted: dict[int, int] = {}
        for batch in batches:
            out = []
            for doc, data in zip(batch.column("id").to_pylist(), table.ids(batch.column("text"))):
                data += end
                size = len(data) // 4
                stops = range((size - 1) % capacity + 1, size + 1, capacity)
                start = 0
                for piece, stop in enumerate(stops):
                    number = counted.get(stop - start, 0)
                    counted[stop - start] = number + 1
                    out.append((doc, piece, start, stop - start, data[4 * start : 4 * stop], task, number))
                    start = stop
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
            columns = zip(*out) if out else [()] * len(kinds)
            names = ["doc_id", "piece", "start", "length", "ids", "task", "number"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return materialise(rows.mapInArrow(pieces, PIECE), "pieces")


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a written table that has length, task and number."""
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row per length
    slots = Slots(plan(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    base = per_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    @F.arrow_udf("sequence_id long, offset long")
    def place(lengths: pa.Array, numbers: pa.Array) -> pa.Array:
        found = slots.place(lengths.to_numpy(zero_copy_only=False), numbers.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], ["sequence_id", "offset"])

    rows = pieces.join(base, ["task", "length"]).withColumn("__place", place(F.col("length"), F.col("number") + F.col("before")))
    return rows.select(*pieces.columns, "__place.sequence_id", "__place.offset")


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their ids and places."""
    return place_pieces(token_pieces(docs, vocabulary, id_col, text_col, capacity), capacity).drop("task", "number")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids one after the other, and the documents in them. A sequence is bounded by the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids"),
            F.transform("parts", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"], p["length"])).alias("parts"),
        )
    )


def pack_report(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = token_pieces(docs, vocabulary, id_col, text_col, capacity)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "task", "number")
    return place_pieces(narrow, capacity).drop("task", "number").withColumnRenamed("doc_id", id_col)
