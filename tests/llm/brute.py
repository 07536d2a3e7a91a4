"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies(rows):
    """[(doc_id, fingerprint, component_id)] of [(doc_id, text)]."""
    prints = [fingerprint(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    first = {}
    for i, f in enumerate(prints):
        up[root(i)] = root(first.setdefault(f, i))
    distinct = list(first.items())
    for x, (f, i) in enumerate(distinct):
        for g, j in distinct[:x]:
            if (f ^ g).bit_count() <= 4:
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = root(i)
            least[r] = min(least.get(r, doc), doc)
    return [(doc, f"{prints[i]:016x}", least.get(root(i))) for i, (doc, _) in enumerate(rows)]


ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def secrets(text):
    """(n_assign, n_access, n_hex, base_sha256)."""
    spans = base_spans(text)
    names = ("assign", "access", "hex")
    listed = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
    return (*[sum(k == i for _, k, _ in spans) for i in range(3)], sha(listed))


ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination(docs, items):
    """[(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)]."""
    windows = []
    for item, text in items:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        size = min(10, len(words))
        windows += [(item, words[i : i + size]) for i in range(len(words) - size + 1) if size]
    by_first = {}
    for item, w in windows:
        by_first.setdefault(w[0], []).append((item, w))
    out = []
    for doc, text in docs:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for i, word in enumerate(words):
            for item, w in by_first.get(word, ()):
                if words[i : i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    found.add(item)
        names = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((doc, len(words), len(hit), len(found), sha(names), bool(hit)))
    return out


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def little(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def round_trip(text):
    ids = ids_of(text)
    return len(ids), hashlib.sha256(little(ids)).hexdigest(), sha(LIBRARY.decode(ids, skip_special_tokens=False))


def token_files(rows):
    """[(doc_id, start, n_tokens, ids_crc32)]; nulls first, ties by the bytes of their ids."""
    data = sorted(((doc is not None, doc or 0), little([*ids_of(t), 2]), doc) for doc, t in rows)
    out, start = [], 0
    for _, ids, doc in data:
        out.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    many = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + d for i, w in enumerate(windows) if w in many for d in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed
