"""Ids by the tokenizers library, which sees each word about once.

Most words of a text were seen before, so a worker keeps their ids in a bounded table. A batch is taken as
the bytes of its texts: numpy cuts them into pieces, Arrow numbers the distinct ones, only those that are not
in the table go to the library, and the ids of all texts are gathered from the table at once.

Where texts are cut. The library's byte-level split looks at white space, letters, digits and other signs, and at contractions
after an apostrophe; nothing is merged across its cuts. A text is cut

- before a space that follows no white space: such fragments never depend on each other;
- inside a fragment, where the kind of character changes (a space stays with what follows), if the fragment has nothing but letters of
  blocks without gaps, digits, ASCII signs and single line feeds. An apostrophe, "<" (special tokens), other white space, two white
  spaces in a row or any other character leave the whole fragment to the library.

If the vocabulary file is not of that kind, whole texts go to the library.

Bounds. The table holds some ``TABLE_ENTRIES`` pieces of at most ``TABLE_BYTES`` bytes (more only by those of one group), then
starts anew; texts are worked through in groups of about ``GROUP_BYTES``, or one longer text.

Defined cases. A null text is empty. The special token's own text becomes its id.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TABLE_ENTRIES = 500_000
TABLE_BYTES = 64
GROUP_BYTES = 4_000_000
JOIN_BYTES = 100_000

# Kinds of bytes. From SPACE on they are white space; WIDE is the first byte of characters some of which are.
LETTER, DIGIT, SIGN, OTHER, WIDE, SPACE, LINE, WHITE = range(8)


def _kinds() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    for span, kind in (
        (b"AZ", LETTER), (b"az", LETTER), (b"09", DIGIT), (b"!&", SIGN), (b"(;", SIGN), (b"=@", SIGN), (b"[`", SIGN), (b"{~", SIGN),
        (b"\x09\x0d", WHITE), (b"\x1c\x20", WHITE), (b"\xe1\xe3", WIDE),
        (b"\x80\xbf", LETTER),  # further bytes of a character: its first byte decides
        (b"\xc3\xc9", LETTER),  # U+00C0 to U+024F; the signs for times and divided by are seen to below
        (b"\xd0\xd1", LETTER),  # U+0400 to U+047F
    ):
        kinds[span[0] : span[1] + 1] = kind
    kinds[ord("0") : ord("9") + 1] = DIGIT  # "(;" spans them
    kinds[ord(" ")], kinds[ord("\n")], kinds[0xC2] = SPACE, LINE, WIDE
    return kinds


KINDS = _kinds()


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... size[0] of them, then those of first[1], and so on."""
    stop = np.cumsum(size)
    return np.repeat(first - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)


def _wide_spaces(data: np.ndarray, kind: np.ndarray) -> None:
    """Mark the white space beyond ASCII."""
    at = np.flatnonzero(kind == WIDE)
    if not len(at):
        return
    last = len(data) - 1
    a, b, c = data[at], data[np.minimum(at + 1, last)], data[np.minimum(at + 2, last)]
    two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    general = (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    three = general | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    for i, which in enumerate((two | three, two | three, three)):
        kind[np.minimum(at[which] + i, last)] = WHITE


def piece_starts(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places where pieces start. ``data`` has the UTF-8 bytes of texts that start at ``rows``."""
    kind = KINDS[data]
    at = np.flatnonzero(data[:-1] == 0xC3)
    kind[at[(data[at + 1] | 0x20) == 0xB7]] = OTHER
    _wide_spaces(data, kind)
    white = kind >= SPACE
    head = np.zeros(len(data), bool)
    head[rows[rows < len(data)]] = True
    fragment = data == ord(" ")
    fragment[1:] &= ~white[:-1]
    fragment |= head
    start = fragment.copy()
    start[1:] |= (kind[1:] != kind[:-1]) & (kind[:-1] != SPACE)
    whole = (kind == OTHER) | (kind == WIDE) | (kind == WHITE)
    whole[1:] |= white[1:] & white[:-1] & ~head[1:]
    at = np.flatnonzero(whole)
    if len(at):
        first = np.flatnonzero(fragment)
        size = np.diff(np.append(first, len(data)))
        kept = np.unique(np.searchsorted(first, at, "right") - 1)
        start[_spans(first[kept] + 1, size[kept] - 1)] = False
    return np.flatnonzero(start)


def _listed(found: pa.LargeBinaryArray, cuts: bool) -> tuple[list[bytes], np.ndarray]:
    """The pieces, and of each: 0 without white space, 1 with none but a space at its start, 2 all others (all if not ``cuts``)."""
    _, ends, data = found.buffers()
    ends = np.frombuffer(ends, np.int64)[: len(found) + 1] if len(found) else np.zeros(1, np.int64)
    raw = (data or pa.py_buffer(b"")).to_pybytes()
    at = ends.tolist()
    pieces = [raw[a:b] for a, b in zip(at[:-1], at[1:])]
    if not cuts:
        return pieces, np.full(len(pieces), 2)
    flat = np.frombuffer(raw, np.uint8)[: at[-1]]
    kind = KINDS[flat]
    _wide_spaces(flat, kind)
    white = np.concatenate(([0], np.cumsum(kind >= SPACE)))[ends]
    size = np.diff(white)
    spaced = (size == 1) & (np.diff(ends) > 1) & (flat[ends[:-1]] == ord(" "))
    return pieces, np.where(size == 0, 0, np.where(spaced, 1, 2))


class LibraryTable:
    """The library of one vocabulary file, and the ids of the pieces that it has encoded."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.cuts = self._cuts_as_described()
        if self.cuts:
            space = self.library.pre_tokenizer.pre_tokenize_str(" ")[0][0]
            size = self.library.get_vocab_size()
            self.spaced = np.array([(self.library.id_to_token(i) or "").startswith(space) for i in range(size)])
            (self.line,) = self._encode(["\n"])[0].tolist()
        self._clear()

    def _cuts_as_described(self) -> bool:
        doc = json.loads(self.library.to_str())
        split = doc["pre_tokenizer"] or {}
        return (
            doc["normalizer"] is None
            and doc["model"]["type"] == "BPE"
            and not doc["model"].get("dropout")
            and (split.get("type"), split.get("add_prefix_space"), split.get("use_regex")) == ("ByteLevel", False, True)
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in doc["added_tokens"])
            and all(set(t["content"]) & set("<'") and t["content"].split() == [t["content"]] for t in doc["added_tokens"])
            and len(self._encode(["\n"])[0]) == 1
        )

    def _clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.ids_kept = np.zeros(0, "<u4")
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, pieces: list[bytes], line: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and sizes of pieces without white space but a space at their start, or, with ``line``, without any.

        They go to the library as one text, each behind its space or before a line feed, whose tokens tell where its ids end.
        """
        upto = np.cumsum([len(p) for p in pieces])
        at = 0
        while at < len(pieces):
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + JOIN_BYTES, "right")))
            text = (b"\n" if line else b"").join(pieces[at:stop]) + b"\n"
            (ids,) = self._encode([text.decode("utf-8")])
            ends = np.flatnonzero(ids == self.line) if line else np.append(np.flatnonzero(self.spaced[ids])[1:], len(ids) - 1)
            if len(ends) != stop - at:
                raise RuntimeError("a piece was not cut at its end")
            sizes = np.diff(ends, prepend=-1 if line else 0)
            yield (np.delete(ids, ends), sizes - 1) if line else (ids[:-1], sizes)
            at = stop

    def _learn(self, pieces: list[bytes], spaces: np.ndarray) -> np.ndarray:
        """Encode pieces and store their ids; the place of each in ``first`` and ``size``. ``spaces``: as :func:`_spaces` has it."""
        spaced, bare, other = (np.flatnonzero(spaces == x).tolist() for x in (1, 0, 2))
        alone = self._encode([pieces[i].decode("utf-8") for i in other])
        got = [
            *self._joined([pieces[i] for i in spaced], line=False),
            *self._joined([pieces[i] for i in bare], line=True),
            *((ids, np.array([len(ids)])) for ids in alone),
        ]
        slot = np.zeros(len(pieces), np.int64)
        slot[spaced + bare + other] = len(self.first) + np.arange(len(pieces))
        sizes = np.concatenate([np.zeros(0, np.int64), *(s for _, s in got)])
        self.first = np.concatenate((self.first, len(self.ids_kept) + np.cumsum(sizes) - sizes))
        self.size = np.concatenate((self.size, sizes))
        self.ids_kept = np.concatenate([self.ids_kept, *(ids for ids, _ in got)])
        return slot

    def ids(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, offsets, data = texts.buffers()
        if not len(texts):
            return
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data or b"", np.uint8)
        row = 0
        while row < len(texts):
            upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + GROUP_BYTES, "right")) - 1)
            yield from self._group(data[offsets[row] : offsets[upto]], offsets[row : upto + 1] - offsets[row])
            row = upto

    def _group(self, data: np.ndarray, rows: np.ndarray) -> Iterator[bytes]:
        starts = piece_starts(data, rows) if self.cuts else np.unique(rows[rows < len(data)])
        ends = np.append(starts, len(data))
        found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        pieces, spaces = _listed(found.dictionary, self.cuts)
        if len(self.slots) > TABLE_ENTRIES:
            self._clear()
        slot = np.fromiter(map(self.slots.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(slot < 0).tolist()
        short = [i for i in missing if len(pieces[i]) <= TABLE_BYTES]
        slot[short] = self._learn([pieces[i] for i in short], spaces[short])
        self.slots.update(zip([pieces[i] for i in short], slot[short].tolist()))
        kept = len(self.first), len(self.ids_kept)
        if len(short) < len(missing):
            long = [i for i in missing if len(pieces[i]) > TABLE_BYTES]
            slot[long] = self._learn([pieces[i] for i in long], spaces[long])
        number = found.indices.to_numpy()
        size = self.size[slot][number]
        ids = self.ids_kept[_spans(self.first[slot][number], size)].tobytes()
        self.first, self.size, self.ids_kept = self.first[: kept[0]], self.size[: kept[0]], self.ids_kept[: kept[1]]
        stops = 4 * np.concatenate(([0], np.cumsum(size)))[np.searchsorted(starts, rows)]
        for a, b in zip(stops[:-1].tolist(), stops[1:].tolist()):
            yield ids[a:b]


_tables: dict[str, LibraryTable] = {}


def library_table(path: str) -> LibraryTable:
    """The worker's table for a vocabulary file, built once."""
    if path not in _tables:
        _tables[path] = LibraryTable(path)
    return _tables[path]
