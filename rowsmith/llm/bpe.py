"""Byte pair encoding with forced boundaries, and its inverse.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can never be merged
across, so a text may be cut there for certain. In byte-level vocabularies that holds
between a character that is no white space and a following space: texts are cut there first, at the speed
of ``str.split``, and the ids of each fragment are kept in a bounded table. Fragments that are not
in the table are cut by the vocabulary's own split pattern and at all other forced boundaries;
the pieces of a whole batch are then merged together, one merge per piece and round, in numpy.
Concatenated ids are those of the whole text.

Bounds. A worker keeps at most ``TABLE_ENTRIES`` fragments of at most ``TABLE_CHARS`` characters; texts are
worked through in groups of about ``GROUP_CHARS`` characters. A piece of more than ``LONG_PIECE`` bytes is
merged with a heap, so a text without any space takes n log n steps.

Defined cases. A null text is encoded like an empty one: no ids, and the empty text comes
back. The special token's own text becomes its id. Rows, repeated or not, are independent.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.llm.common import hidden, text_batches

TABLE_ENTRIES = 200_000
TABLE_CHARS = 40
GROUP_CHARS = 500_000
LONG_PIECE = 256
NONE = np.int64(1) << 40

# The split pattern of the vocabulary's family. White space is the Unicode property.
SPLIT_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Token bytes, merges and special tokens of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            doc = json.load(file)
        alphabet = byte_alphabet()
        ids: dict[str, int] = doc["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in doc["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        self.inside = np.zeros((256, 256), bool)
        for token, i in ids.items():
            raw = token.encode("utf-8") if token in self.special else bytes(alphabet[c] for c in token)
            self.tokens[i] = raw
            if token not in self.special and len(raw) > 1:
                pair = np.frombuffer(raw, np.uint8)
                self.inside[pair[:-1], pair[1:]] = True
        for token, i in self.special.items():
            self.tokens[i] = token.encode("utf-8")
        self.byte_ids = np.array([ids[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])], np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(doc["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        # Texts may be cut before a space after a character that is no white space if no token
        # holds such a pair. Bytes of one character are taken together: the last byte of a
        # no-break space is that of other characters too.
        self.cuts_at_space = not any(
            re.search(r"\S ", token.decode("utf-8", "replace")) for token in self.tokens
        )


class PairTable:
    """Ranks of merges for arrays of pairs: two hash tables, each key in one of its two places."""

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]]):
        self.shift = np.uint64(64 - max(10, (len(merges) * 4).bit_length()))
        self.factors = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
        size = 1 << (64 - int(self.shift))
        keys = np.array([(a << 32) | b for a, b in merges], np.uint64)
        places = [((keys * f) >> self.shift).astype(np.int64) for f in self.factors]
        owner = [np.full(size, -1, np.int64), np.full(size, -1, np.int64)]
        for first in range(len(keys)):
            x, side = first, 0
            for _ in range(1_000):
                at = places[side][x]
                x, owner[side][at] = owner[side][at], x
                if x < 0:
                    break
                side = 1 - side
            else:
                raise RuntimeError("the merge table is too full")
        self.keys = [np.where(o >= 0, keys[o], np.uint64(0xFFFFFFFFFFFFFFFF)) for o in owner]
        rank = np.array([r for r, _ in merges.values()], np.int64)
        self.ranks = [np.where(o >= 0, rank[o], NONE) for o in owner]
        self.made = np.zeros(int(rank.max()) + 1 if len(rank) else 1, np.int64)
        for r, i in merges.values():
            self.made[r] = i

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        out = np.full(len(key), NONE, np.int64)
        for factor, keys, ranks in zip(self.factors, self.keys, self.ranks):
            at = ((key * factor) >> self.shift).astype(np.int64)
            hit = keys[at] == key
            out[hit] = ranks[at[hit]]
        return out


class ForcedBoundaryEncoder:
    """Encodes fragments that start and end at forced boundaries."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.pairs = PairTable(self.vocabulary.merges)
        self.pattern = regex.compile(SPLIT_PATTERN)
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def fragments(self, found: list[str]) -> list[bytes]:
        """Ids of each fragment as little-endian 32-bit numbers."""
        pieces: list[str] = []
        marks: list[int] = []  # fragment of each piece
        fixed: dict[int, int] = {}  # piece -> special id
        for i, text in enumerate(found):
            for part in self.special.split(text) if self.special and self.special.search(text) else (text,):
                if part in self.vocabulary.special:
                    fixed[len(pieces)] = self.vocabulary.special[part]
                    pieces.append("")
                    marks.append(i)
                else:
                    got = self.pattern.findall(part)
                    pieces += got
                    marks += [i] * len(got)
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        ids, owner = self._merge(raw, np.array(marks, np.int64), fixed)
        cuts = np.searchsorted(owner, np.arange(len(found) + 1)) * 4
        data = ids.astype("<u4").tobytes()
        return [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _merge(self, raw: list[bytes], marks: np.ndarray, fixed: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their fragment numbers, in order."""
        flat = np.frombuffer(b"".join(raw), np.uint8)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        piece = np.repeat(np.arange(len(raw)), size)
        fragment = marks[piece] if len(piece) else np.zeros(0, np.int64)
        # A new segment starts with each piece and at each pair that no token holds.
        start = np.ones(len(flat), bool)
        if len(flat) > 1:
            start[1:] = (piece[1:] != piece[:-1]) | ~self.vocabulary.inside[flat[:-1], flat[1:]]
        segment = np.cumsum(start) - 1
        place = np.arange(len(flat))
        ids = self.vocabulary.byte_ids[flat]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        length = np.bincount(segment) if len(segment) else np.zeros(0, np.int64)
        for s in np.flatnonzero(length > LONG_PIECE):
            rows = np.flatnonzero(segment == s)
            kept, merged = self._merge_long(ids[rows].tolist())
            done.append((place[rows][kept], np.array(merged, np.int64)))
        if len(done):
            short = length[segment] <= LONG_PIECE
            ids, segment, place = ids[short], segment[short], place[short]
        rank = self._ranks(ids, segment)
        while len(ids):
            begin = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
            least = np.minimum.reduceat(rank, begin)
            over = least == NONE
            count = np.diff(np.concatenate((begin, [len(ids)])))
            if over.any():
                rows = np.repeat(over, count)
                done.append((place[rows], ids[rows]))
                ids, segment, place, rank = (x[~rows] for x in (ids, segment, place, rank))
                if not len(ids):
                    break
                least, count = least[~over], count[~over]
                begin = np.concatenate(([0], np.cumsum(count)[:-1]))
            # The leftmost pair of the lowest rank in every segment.
            at = np.flatnonzero(rank == np.repeat(least, count))
            at = at[np.concatenate(([True], segment[at][1:] != segment[at][:-1]))]
            ids[at] = self.pairs.made[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            ids, segment, place, rank = (x[keep] for x in (ids, segment, place, rank))
            for near in (at, at[at > 0] - 1):
                rank[near] = self._ranks_at(ids, segment, near)
        order = np.concatenate([p for p, _ in done]) if done else np.zeros(0, np.int64)
        values = np.concatenate([v for _, v in done]) if done else np.zeros(0, np.int64)
        sort = np.argsort(order, kind="stable")
        values, owner = values[sort], fragment[order[sort]]
        if fixed:
            first = np.concatenate(([0], np.cumsum(size)))
            where = np.searchsorted(order[sort], first[list(fixed)])
            values = np.insert(values, where, list(fixed.values()))
            owner = np.insert(owner, where, marks[list(fixed)])
        return values, owner

    def _ranks_at(self, ids: np.ndarray, segment: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.full(len(at), NONE, np.int64)
        inner = at + 1 < len(ids)
        inner[inner] = segment[at[inner]] == segment[at[inner] + 1]
        rows = at[inner]
        out[inner] = self.pairs.rank(ids[rows], ids[rows + 1])
        return out

    def _ranks(self, ids: np.ndarray, segment: np.ndarray) -> np.ndarray:
        return self._ranks_at(ids, segment, np.arange(len(ids)))

    def _merge_long(self, ids: list[int]) -> tuple[list[int], list[int]]:
        """Positions kept and their ids, for one long segment."""
        merges = self.vocabulary.merges
        size = len(ids)
        after, before = [*range(1, size), -1], [*range(-1, size - 1)]
        live = [True] * size
        heap = [(merges[p][0], i, p) for i in range(size - 1) if (p := (ids[i], ids[i + 1])) in merges]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if live[i] else -1
            if j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], live[j] = merges[pair][1], False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] >= 0 and (p := (ids[x], ids[after[x]])) in merges:
                    heapq.heappush(heap, (merges[p][0], x, p))
        kept = [i for i in range(size) if live[i]]
        return kept, [ids[i] for i in kept]


class FragmentCache:
    """Cuts texts before spaces that are forced boundaries and keeps the ids of the fragments.

    ``encode`` turns fragments into ids; it sees each distinct fragment of a group once.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], cuts_at_space: bool = True):
        self.encode = encode
        self.cuts_at_space = cuts_at_space
        self.known: dict[str, bytes] = {}
        self.white = re.compile(r"\s ")
        self.cut = re.compile(r"(?<=\S) ")

    def _parts(self, text: str) -> list[str]:
        """The first fragment, then the others without the space that they start with."""
        if not self.cuts_at_space:
            return [text]
        return self.cut.split(text) if self.white.search(text) else text.split(" ")

    def ids(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        group: list[list[str]] = []
        chars = 0
        for text in texts:
            group.append(self._parts(text or ""))
            chars += len(text or "")
            if chars >= GROUP_CHARS:
                yield from self._group(group)
                group, chars = [], 0
        yield from self._group(group)

    def _group(self, group: list[list[str]]) -> list[bytes]:
        if len(self.known) > TABLE_ENTRIES:
            self.known.clear()
        known = self.known
        firsts = list({parts[0] for parts in group})
        first = dict(zip(firsts, self.encode(firsts)))
        # "- known.keys()" would walk through the whole table for every group.
        need = list(set().union(*[parts[1:] for parts in group]).difference(known))
        known.update(zip(need, self.encode([" " + p for p in need])))
        long = [p for p in need if len(p) > TABLE_CHARS]
        out = [b"".join([first[parts[0]], *map(known.__getitem__, parts[1:])]) for parts in group]
        for p in long:
            del known[p]
        return out


_caches: dict[str, tuple[FragmentCache, ForcedBoundaryEncoder]] = {}


def encoder(path: str) -> tuple[FragmentCache, ForcedBoundaryEncoder]:
    """The worker's encoder for a vocabulary file, built once."""
    if path not in _caches:
        made = ForcedBoundaryEncoder(path)
        _caches[path] = (FragmentCache(made.fragments, made.vocabulary.cuts_at_space), made)
    return _caches[path]


def decode_ids(ids: np.ndarray, tokens: list[bytes]) -> str:
    """Text of ids; bytes that are not UTF-8 become the replacement character."""
    return b"".join(map(tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


def encode(text: Column, path: str) -> Column:
    """Ids of a text column as array<int>."""

    @F.arrow_udf("array<int>")
    def of(texts: pa.Array) -> pa.Array:
        cache, _ = encoder(path)
        found = list(cache.ids(t.as_py() for t in texts))
        ends = np.cumsum([0] + [len(x) // 4 for x in found]).astype(np.int32)
        return pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(found), "<u4").astype(np.int32))

    return of(text)


def decode(ids: Column, path: str) -> Column:
    """Text of a column of id arrays; null gives the empty text."""

    @F.arrow_udf("string")
    def of(arrays: pa.Array) -> pa.Array:
        _, made = encoder(path)
        empty = np.zeros(0, np.int64)
        return pa.array(
            [decode_ids(np.array(a.as_py(), np.int64) if a.is_valid else empty, made.vocabulary.tokens) for a in arrays],
            pa.string(),
        )

    return of(ids)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The ids stay in the worker, where both digests are taken, so the long arrays are never
    sent back to the JVM. The digests are of whole texts.
    """

    text_batches(docs.sparkSession)

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def of(texts: pa.Array) -> pa.Array:
        cache, made = encoder(path)
        counts, ids_sha, text_sha = [], [], []
        for found in cache.ids(t.as_py() for t in texts):
            ids = np.frombuffer(found, "<u4")
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(found).hexdigest())
            back = decode_ids(ids, made.vocabulary.tokens)
            text_sha.append(hashlib.sha256(back.encode("utf-8")).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    trip = hidden("trip")
    return docs.select(F.col(id_col), of(F.col(text_col)).alias(trip)).select(
        id_col, *[F.col(trip)[c].alias(c) for c in ("n_tokens", "ids_sha256", "decoded_sha256")]
    )
