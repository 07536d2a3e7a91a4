"""Token files: ids of all documents in id order, packed in patched frame-of-reference blocks.

A file is a table of segments. A segment holds whole documents and is read without its
neighbours. Its payload starts with an index of its blocks and holds blocks of ``BLOCK_IDS`` ids:

    payload  "PFR1", block count (u32), then per block: byte offset (u64), first id's number (u64)
    block    ids (u32), minimum (u32), width in bits (u8), exceptions (u32)
             packed ids less the minimum, ``width`` bits each, high bit first, filled to a byte
             exceptions: places (u32 each), then values less the minimum (u32 each)

The width holds the ``WIDTH_PERCENTILE`` of the block's values; larger ones are exceptions, packed as
zero. All numbers are little-endian. Beside the payload, a segment lists its part, its first id's
number in the part, and the id and length of each document.

Spark writes and reads the segments as rows of a Parquet table, so they can be in any store.
Documents go to parts by ranges of doc_id, each part is sorted and packed in one stream, and a
reader adds the sizes of the parts before (one row per part).

Defined cases. A null text counts as empty: it has the end id alone. Null ids come first,
repeated ids stay and follow each other in the order of their tokens' bytes. Extra columns are ignored.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowsmith.llm.common import shuffle_width, text_batches
from rowsmith.llm.library_tokens import library_table

END_ID = 2
BLOCK_IDS = 4_096
SEGMENT_IDS = 1_000_000
WIDTH_PERCENTILE = 95
MAGIC = b"PFR1"
SEGMENT = (
    "part int, first long, ids long, doc_ids array<long>, doc_lengths array<long>, payload binary"
)


def pack_block(ids: np.ndarray) -> bytes:
    """One block of at least one id."""
    low = int(ids.min())
    rest = ids.astype(np.int64) - low
    at = math.ceil((len(rest) - 1) * (WIDTH_PERCENTILE / 100))
    width = int(np.partition(rest, at)[at]).bit_length()
    out = np.flatnonzero(rest >> width)
    small = rest.copy()
    small[out] = 0
    if width > 16:
        bits = np.unpackbits(small.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width :]
    else:
        bits = np.unpackbits(small.astype(">u2").view(np.uint8).reshape(-1, 2), axis=1)[:, 16 - width :]
    packed = np.packbits(bits.reshape(-1)).tobytes()
    head = struct.pack("<IIBI", len(ids), low, width, len(out))
    return head + packed + out.astype("<u4").tobytes() + rest[out].astype("<u4").tobytes()


def unpack_block(data: memoryview) -> np.ndarray:
    count, low, width, others = struct.unpack_from("<IIBI", data)
    at = struct.calcsize("<IIBI")
    size = -(-count * width // 8)
    if width:
        # A value lies within three bytes (five, if wide) from its first bit's byte on.
        span, number = (3, np.uint32) if width <= 16 else (5, np.uint64)
        raw = np.zeros(size + span, np.uint8)
        raw[:size] = np.frombuffer(data, np.uint8, size, at)
        window = raw[:size].astype(number)
        for i in range(1, span):
            window = (window << number(8)) | raw[i : size + i]
        bit = np.arange(0, count * width, width)
        shift = (8 * span - width - (bit & 7)).astype(number)
        ids = ((window[bit >> 3] >> shift) & number((1 << width) - 1)).astype(np.int64)
    else:
        ids = np.zeros(count, np.int64)
    places = np.frombuffer(data, "<u4", others, at + size)
    ids[places] = np.frombuffer(data, "<u4", others, at + size + 4 * others)
    return (ids + low).astype(np.uint32)


def pack_segment(ids: np.ndarray) -> bytes:
    blocks = [pack_block(ids[a : a + BLOCK_IDS]) for a in range(0, len(ids), BLOCK_IDS)]
    at = len(MAGIC) + 4 + 16 * len(blocks)
    index = []
    for i, block in enumerate(blocks):
        index.append(struct.pack("<QQ", at, i * BLOCK_IDS))
        at += len(block)
    return b"".join([MAGIC, struct.pack("<I", len(blocks)), *index, *blocks])


def block_starts(payload: bytes) -> list[tuple[int, int]]:
    """(byte offset, number of the first id) of each block."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token segment")
    (count,) = struct.unpack_from("<I", payload, 4)
    return [struct.unpack_from("<QQ", payload, 8 + 16 * i) for i in range(count)]


def read_ids(payload: bytes, first: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``stop`` of a segment; only the blocks that hold them are unpacked."""
    starts = block_starts(payload)
    view = memoryview(payload)
    got, begin = [], None
    for i, (at, number) in enumerate(starts):
        upto = starts[i + 1][1] if i + 1 < len(starts) else float("inf")
        if upto > first and (stop is None or number < stop):
            begin = number if begin is None else begin
            got.append(unpack_block(view[at:]))
    if begin is None:
        return np.zeros(0, np.uint32)
    return np.concatenate(got)[first - begin : None if stop is None else stop - begin]


def narrow(ids: np.ndarray) -> bytes:
    """Ids as little-endian numbers behind a byte that says how wide they are: two bytes where all fit."""
    if len(ids) and int(ids.max()) > 0xFFFF:
        return b"\x04" + ids.astype("<u4").tobytes()
    return b"\x02" + ids.astype("<u2").tobytes()


def widen(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4" if data[0] == 4 else "<u2", offset=1).astype(np.uint32)


def token_bytes(text: Column, path: str, end_id: int = END_ID) -> Column:
    """Ids of a text and the end id, in the form of :func:`narrow`."""
    end = struct.pack("<I", end_id)

    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        found = library_table(path).ids(texts)
        return pa.array([narrow(np.frombuffer(ids + end, "<u4")) for ids in found], pa.binary())

    return of(text)


def _pack_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, id, ids) in order -> segments."""
    part, first = None, 0
    doc_ids: list[int | None] = []
    arrays: list[np.ndarray] = []
    held = 0

    def close() -> pa.RecordBatch:
        nonlocal doc_ids, arrays, held, first
        ids = np.concatenate(arrays)
        row = pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([first], pa.int64()),
                pa.array([len(ids)], pa.int64()),
                pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([[len(a) for a in arrays]], pa.list_(pa.int64())),
                pa.array([pack_segment(ids)], pa.binary()),
            ],
            ["part", "first", "ids", "doc_ids", "doc_lengths", "payload"],
        )
        first += len(ids)
        doc_ids, arrays, held = [], [], 0
        return row

    for batch in batches:
        for number, doc, data in zip(*[batch.column(c) for c in ("part", "id", "ids")]):
            number = number.as_py()
            if number != part:
                if arrays:
                    yield close()
                part, first = number, 0
            doc_ids.append(doc.as_py())
            arrays.append(widen(data.as_py()))
            held += len(arrays[-1])
            if held >= SEGMENT_IDS:
                yield close()
    if arrays:
        yield close()


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    parts: int | None = None,
) -> None:
    """Encode all texts and write them to ``path`` in ascending order of their ids."""
    text_batches(docs.sparkSession)
    parts = parts or shuffle_width(docs.sparkSession)
    shares = [i / parts for i in range(1, parts)]
    bounds = sorted(set(docs.select(id_col).stat.approxQuantile(id_col, shares, 0.2 / parts))) if shares else []
    number = F.lit(0)
    if bounds:
        limits = F.array(*[F.lit(int(b)).cast("long") for b in bounds])
        below = F.aggregate(limits, F.lit(0), lambda n, b: n + (F.col(id_col) > b).cast("int"))
        number = F.coalesce(below, F.lit(0))
    rows = docs.select(
        number.alias("part"), F.col(id_col).cast("long").alias("id"), token_bytes(F.col(text_col), vocabulary, end_id).alias("ids")
    )
    # Each part is a task of its own: part numbers are partition numbers, not hashed onto them.
    ordered = rows.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "id", "ids")
    ordered.mapInArrow(_pack_parts, SEGMENT).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start``, the number of ids in all segments before."""
    segments = spark.read.parquet(path)
    sizes = segments.groupBy("part").agg(F.sum("ids").alias("n")).collect()  # one row per part
    base, before = [], 0
    for row in sorted(sizes, key=lambda r: r["part"]):
        base.append((row["part"], before))
        before += row["n"]
    known = spark.createDataFrame(base, "part int, base long")
    return segments.join(F.broadcast(known), "part").withColumn("start", F.col("base") + F.col("first")).drop("base")


def document_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32 of every document."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, docs, lengths, payload in zip(
                *[batch.column(c) for c in ("start", "doc_ids", "doc_lengths", "payload")]
            ):
                ids = read_ids(payload.as_py())
                size = np.array(lengths.as_py(), np.int64)
                cuts = np.concatenate(([0], np.cumsum(size)))
                data = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs.as_py(), pa.int64()),
                        pa.array(cuts[:-1] + start.as_py(), pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return (
        read_token_files(spark, path)
        .select("start", "doc_ids", "doc_lengths", "payload")
        .mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )
