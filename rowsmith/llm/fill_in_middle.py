"""Fill-in-middle: cut a text in three by one match of a repeated unit and put its middle last.

One ``fullmatch`` of ``(unit)*`` by the regex library keeps every repetition of the group: ``match.ends(1)``
has as many entries as the text has units, and its k-th entry is the offset behind k units. So the number of units and both cuts
come out of one match; nothing walks through the text. Code points are matched in blocks of ``BLOCK_CHARS``,
which bounds the memory of very long texts; a code point never lies across two blocks. Other units are matched
over the whole text.

The cuts and the form hang on the id alone: with h1 to h4 the first four 32-bit groups of the SHA-256 of
``<seed>:<id>``, the prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) units and the middle after the larger.
A text is left plain if it is empty, holds one of the marks, or if h3 % 100 >= ``RATE``; the others are
suffix first (spm) if h4 % 100 < ``SPM_RATE``, else prefix first (psm). As no cut text holds a mark,
:func:`restore` finds the pieces by the marks and gives the text back exactly.

Defined cases. A null text is the empty text. A null id counts as the empty id, so all rows without one get the same
draws. Repeated rows give the same output, extra columns stay, an empty table gives no rows. A text that the unit can't
match whole is left plain, with a null n.
"""

from __future__ import annotations

from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.llm.common import hidden, sha256_hex, text_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = "<[PSM]>"
CODE_POINT = r"[\s\S]"
GRAPHEME = r"\X"
LINE = r"[^\n]*\n|[^\n]+"
SEED = 1
RATE = 90
SPM_RATE = 20
BLOCK_CHARS = 1 << 18


@cache
def _units(unit: str) -> regex.Pattern:
    return regex.compile(f"(?:({unit}))*")


def unit_cuts(text: str, unit: str, draw: int, other: int) -> tuple[int, int, int] | None:
    """Units of a text and the offsets of both cuts; None if the units do not make up the text."""
    size = BLOCK_CHARS if unit == CODE_POINT else max(1, len(text))
    ends: list[list[int]] = []
    for begin in range(0, len(text), size):
        match = _units(unit).fullmatch(text, begin, min(begin + size, len(text)))
        if match is None:
            return None
        ends.append(match.ends(1))
    n = sum(map(len, ends))
    first, second = sorted((draw % (n + 1), other % (n + 1)))

    def offset(units: int) -> int:
        for block in ends:
            if units <= len(block):
                return block[units - 1] if units else 0
            units -= len(block)
        return 0

    return n, offset(first), offset(second)


def draws(id_col: Column, seed: int = SEED) -> list[Column]:
    """Four 32-bit numbers from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


CUT = "n long, prefix string, middle string, suffix string"


def cut(text: Column, draw: Column, other: Column, unit: str = CODE_POINT) -> Column:
    """Struct of a text's units and its three pieces."""

    @F.arrow_udf(CUT)
    def of(texts: pa.Array, firsts: pa.Array, seconds: pa.Array) -> pa.Array:
        counts, pieces = [], ([], [], [])
        for text, x, y in zip(texts, firsts.to_pylist(), seconds.to_pylist()):
            text = text.as_py() or ""
            found = unit_cuts(text, unit, x, y)
            n, a, b = found or (None, None, None)
            counts.append(n)
            for out, piece in zip(pieces, (slice(None, a), slice(a, b), slice(b, None))):
                out.append(None if n is None else text[piece])
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), *[pa.array(p, pa.string()) for p in pieces]], ["n", "prefix", "middle", "suffix"]
        )

    return of(text, draw, other)


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = CODE_POINT,
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """Add a struct column ``fim``: n, form, prefix_chars, middle_chars, output."""
    text_batches(docs.sparkSession)
    pieces = hidden("pieces")
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2, h3, h4 = draws(F.col(id_col), seed)
    rows = docs.withColumn(pieces, cut(F.col(text_col), h1, h2, unit))
    n, prefix, middle, suffix = (F.col(pieces)[c] for c in ("n", "prefix", "middle", "suffix"))
    plain = (text == "") | n.isNull() | F.regexp_like(text, F.lit(MARKS)) | (h3 % 100 >= rate)
    form = F.when(plain, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    output = (
        F.when(form == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(form == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(text)
    )
    chars = [F.when(form != "plain", F.length(c)).cast("long") for c in (prefix, middle)]
    made = F.struct(
        n.alias("n"), form.alias("form"), chars[0].alias("prefix_chars"), chars[1].alias("middle_chars"), output.alias("output")
    )
    return rows.withColumn("fim", made).drop(pieces)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    part = F.split(output, MARKS)
    return (
        F.when(form == "psm", F.concat(F.get(part, 1), F.get(part, 3), F.get(part, 2)))
        .when(form == "spm", F.concat(F.get(part, 2), F.get(part, 3), F.get(part, 1)))
        .otherwise(output)
    )


def transform_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: units, form, lengths of prefix and middle, digests of the output and of the restored text."""
    rows = transform(docs.select(id_col, text_col), id_col, text_col)
    fim = F.col("fim")
    return rows.select(
        id_col,
        *[fim[c].alias(c) for c in ("n", "form", "prefix_chars", "middle_chars")],
        sha256_hex(fim["output"]).alias("output_sha256"),
        sha256_hex(restore(fim["output"], fim["form"])).alias("restored_sha256"),
    )
