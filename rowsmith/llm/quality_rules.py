"""Quality rules, line first: judge every line, drop the failures, then judge what is left.

A line with a word fails as navigation (two or more separators between short entries), as
boilerplate (phrases of banners, menus and legal notes make up ``PHRASE_SHARE`` of its words), or for its
punctuation (symbols or repeated marks on a large share of its words and on two at least, sentence marks
after almost every word of four or more, or no letter or digit at all). The mark of a list, heading or quotation
at the start of a line does not count. A line of more than ``LONG_WORDS``
words is judged for phrases sentence by sentence and loses only the sentences that fail. A document goes if the base rules reject it (too few words, or too
many of them in three-word windows that repeat) or if the failed lines and sentences hold more than
``MAX_LOST`` of its words' characters.

Everything is an expression over one row: no shuffle, no Python. Repeated windows are looked for
only where hashes of windows repeat; equal hashes are compared by their words.

Defined cases. A null text has no words: all counts are zero and base_failed is true. Blank lines are
neither judged nor counted and stay. Repeated rows are judged each on its own, extra columns stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.llm.common import hidden, settled

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST = 0.3
MARKED_SHARE = 0.3  # of a line's words that carry symbols or doubled marks
MARKED_WORDS = 2  # and at least so many
TERSE_SHARE = 0.8  # of a line's words that end with a sentence mark
TERSE_WORDS = 4  # in a line of so many words or more
ENTRIES = 2  # separators of a menu, at least
ENTRY_SHARE = 0.25  # of a line's words that are separators of a menu
PHRASE_SHARE = 0.25  # of a line's or sentence's words that are in boilerplate phrases
LONG_WORDS = 25  # a longer line is judged for phrases by its sentences
SYMBOLS = "#*$%&|<>"

# White space of the word rule, and phrases of boilerplate lines in lower case.
SPACE = r"[\x20\x09-\x0D]"
BOILERPLATE = (
    "cookie policy",
    "accept all cookies",
    "privacy policy",
    "terms of use",
    "terms of service",
    "all rights reserved",
    "javascript is disabled",
    "enable javascript",
    "lorem ipsum",
    "subscribe to our newsletter",
    "sign up for our newsletter",
    "log in to continue",
    "skip to content",
    "back to top",
    "share this page",
    "click here to",
)
PHRASE = "(" + "|".join(BOILERPLATE) + ")"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]"
LEAD = rf"^{GAP}*(?:#{{1,6}}|[*+>»•·-]|[0-9]+[.)])(?={GAP})"  # of a list, heading or quotation
EMPHASIS = r"(\*{1,3}|_{1,3})([\p{L}\p{N}](?:[^*_]*[^*_\x20])?)\1"
# The rest of the word is taken too, so a word counts once. A sign after a number is part of it.
MARKED = rf"(?:[#*$%&<>~^=_]{{2,}}|[!?]{{2,}}|(?:[#*&<>]|(?<![0-9])[$%])(?={GAP}|$))[^\x20\x09-\x0D]*"
# A dash separates entries only where the next one begins with a capital or a number.
ENTRY = rf"(?<={GAP})(?:-*[|>»•·/][|>»•·/-]*|-+(?={GAP}+[\p{{Lu}}\p{{N}}]))(?={GAP}+[^\x20\x09-\x0D])"
TERSE = rf"[.!?][\"')\]]*(?={GAP}|$)"
SENTENCE_END = r"(?<=[.!?])(?=[\x20\x09-\x0D])"  # the space stays with the sentence that follows


def _strip(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _solid(text: Column) -> Column:
    """Number of characters that are in words."""
    return F.length(_strip(text, " \t\n\x0b\f\r"))


def words_of(text: Column) -> Column:
    """Words of a text; empty pieces at its ends are left out."""
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def _repeat_words(words: str, hashes: str) -> Column:
    """Words inside three-word windows that occur twice or more.

    Windows are sorted by hash; neighbours with the same hash and words are repeats. The places of
    all repeated windows, in order, give the number of words that they cover.
    """
    w = F.col(words)
    same = lambda a, b: (F.get(w, a) == F.get(w, b)) & (F.get(w, a + 1) == F.get(w, b + 1)) & (F.get(w, a + 2) == F.get(w, b + 2))
    ordered = F.array_sort(F.transform(F.col(hashes), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(rows: Column) -> Column:
        size = F.size(rows)
        meets = lambda x, other: (x["h"] == other["h"]) & same(x["i"], other["i"])
        kept = F.filter(
            rows,
            lambda x, i: ((i > 0) & F.coalesce(meets(x, F.get(rows, i - 1)), F.lit(False)))
            | ((i + 1 < size) & F.coalesce(meets(x, F.get(rows, i + 1)), F.lit(False))),
        )
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    found = F.transform(F.array(F.struct(ordered.alias("rows"))), lambda r: places(r["rows"]))[0]
    return F.aggregate(
        found,
        F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda s, p: F.struct(
            (p + 3).alias("upto"), (s["n"] + F.least(F.lit(3), p + 3 - s["upto"])).alias("n")
        ),
        lambda s: s["n"],
    )


def _n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def _boilerplate(text: Column) -> Column:
    """True when phrases make up enough of the words of a line or sentence."""
    lower = F.lower(text)
    inside = F.aggregate(
        F.regexp_extract_all(lower, F.lit(PHRASE), F.lit(1)), F.lit(0), lambda s, p: s + F.size(F.split(p, " "))
    )
    return F.regexp_like(lower, F.lit(PHRASE)) & (inside >= PHRASE_SHARE * _n_words(text))


def _bad_line(line: Column, phrases: Column) -> Column:
    """True for a line to drop; blank lines are never bad. ``phrases``: whether the text has any phrase."""
    phrase = phrases & (_n_words(line) <= LONG_WORDS) & _boilerplate(line)
    words = _n_words(line)
    body = F.regexp_replace(F.regexp_replace(line, F.lit(LEAD), F.lit("")), F.lit(EMPHASIS), F.lit("$2"))
    marked = F.regexp_count(body, F.lit(MARKED))
    entries = F.regexp_count(line, F.lit(ENTRY))
    suspect = F.regexp_like(line, F.lit(r"[#*$%&<>|»•·~^=_/-]|[!?]{2}"))
    empty = ~F.regexp_like(line, F.lit(r"[\p{L}\p{N}]"))
    symbols = (marked >= MARKED_WORDS) & (marked > MARKED_SHARE * words)
    menu = (entries >= ENTRIES) & (entries >= ENTRY_SHARE * words)
    # Two marked words in a row first: hardly any line has them.
    terse = (
        F.regexp_like(line, F.lit(rf"[.!?]{GAP}+[^\x20\x09-\x0D]+[.!?][\"')\]]*(?:{GAP}|$)"))
        & (words >= TERSE_WORDS)
        & (F.regexp_count(line, F.lit(TERSE)) >= TERSE_SHARE * words)
    )
    return phrase | (suspect & (symbols | menu | empty)) | terse


def with_quality(docs: DataFrame, name: str = "quality", text_col: str = "text") -> DataFrame:
    """Add a struct column ``name``: counts, base_failed, kept, and the text without failed lines and sentences."""
    names = ("text", "words", "lines", "marks", "hashes", "counts", "phrases", "parts")
    text, words, lines, marks, hashes, counts, phrases, parts = (hidden(x) for x in names)
    read = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    read = read.withColumn(words, words_of(F.col(text)))
    has_word = lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))
    solid_lines = F.filter(F.split(F.col(text), "\n", -1), has_word)
    w = F.col(words)
    read = read.withColumn(
        hashes,
        F.when(
            F.size(w) >= 3,
            F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
        ).otherwise(F.array().cast("array<bigint>")),
    ).withColumn(lines, solid_lines)
    lower = F.lower(F.col(text))
    read = read.withColumn(phrases, reduce(lambda a, b: a | b, [F.contains(lower, F.lit(p)) for p in BOILERPLATE]))
    # Every line is judged once, where it stands; later steps read the mark.
    fails = lambda x: F.coalesce(has_word(x) & _bad_line(x, F.col(phrases)), F.lit(False))
    read = read.withColumn(
        marks, F.transform(F.split(F.col(text), "\n", -1), lambda x: F.struct(x.alias("line"), fails(x).alias("bad")))
    )
    # What stays of long lines whose sentences are judged one by one; null for other lines.
    good = lambda x: F.array_join(F.filter(F.split(x, SENTENCE_END, -1), lambda p: ~_boilerplate(p)), "")
    cut = lambda m: F.col(phrases) & ~m["bad"] & (_n_words(m["line"]) > LONG_WORDS)
    read = read.withColumn(
        parts,
        F.transform(
            F.col(marks),
            lambda m: F.struct(m["line"].alias("line"), m["bad"].alias("bad"), F.when(cut(m), good(m["line"])).alias("rest")),
        ),
    )
    lost = lambda m: F.when(m["bad"], _solid(m["line"])).when(
        m["rest"].isNotNull(), _solid(m["line"]) - _solid(m["rest"])
    ).otherwise(0)
    h = F.col(hashes)
    repeats = F.when(F.size(F.array_distinct(h)) < F.size(h), _repeat_words(words, hashes)).otherwise(F.lit(0))
    solid = _solid(F.col(text))
    read = read.withColumn(
        counts,
        F.struct(
            F.size(w).cast("long").alias("n_words"),
            solid.cast("long").alias("word_chars"),
            (F.length(F.col(text)) - F.length(_strip(F.col(text), SYMBOLS))).cast("long").alias("n_symbols"),
            (F.size(F.col(lines)) - F.size(F.array_distinct(F.col(lines)))).cast("long").alias("n_dup_lines"),
            repeats.cast("long").alias("n_repeat_words"),
            F.aggregate(F.col(parts), F.lit(0).cast("long"), lambda s, m: s + lost(m)).alias("lost_chars"),
        ),
    )
    c = F.col(counts)
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
    # A long line of which no sentence stays goes whole.
    stays = lambda m: F.when(~m["bad"], F.when(m["rest"].isNotNull(), F.nullif(m["rest"], F.lit(""))).otherwise(m["line"]))
    left = F.filter(F.transform(F.col(parts), stays), lambda x: x.isNotNull())
    clean = F.when(c["lost_chars"] > 0, F.array_join(left, "\n")).otherwise(F.col(text_col))
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars")
    return read.withColumn(
        name,
        F.struct(
            *[c[f].alias(f) for f in fields],
            failed.alias("base_failed"),
            settled(~failed & (c["lost_chars"] <= MAX_LOST * c["word_chars"])).alias("kept"),
            clean.alias("clean"),
        ),
    ).drop(text, words, lines, marks, hashes, counts, phrases, parts)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, base_failed and kept."""
    q = hidden("quality")
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars")
    return with_quality(docs.select(id_col, text_col), q, text_col).select(id_col, *[F.col(q)[f].alias(f) for f in fields])


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents that are kept, without their failed lines and sentences."""
    q = hidden("quality")
    marked = with_quality(docs, q, text_col).filter(F.col(q)["kept"])
    return marked.withColumn(text_col, F.col(q)["clean"]).select(*docs.columns)
