"""Periodic runs of words: found online, one diagonal per lag, and cut down to one period.

A run is a stretch of words with smallest period q and a length of at least ``MIN_WORDS`` and ``MIN_PERIODS``
times q that neither neighbour extends. In the table of matches (word i against word i - lag) it is a
diagonal of consecutive matches. Words are read once from left to right. Each position looks up its
earlier occurrences; each of them adds one to the match length of its lag, and lags without a match at
this position end there. A diagonal that ends long enough is emitted at once.

Two facts keep the table sparse without losing a run.

* A run has at least ``MIN_WORDS`` words and three periods, so its diagonal has at least ``WINDOW`` = 16
  consecutive matches. An occurrence is therefore one of the 16 words that start at a position, not of
  one word; texts without a repeated window are done after one sort.
* While a run of period p that began at word s goes on, longer lags q are followed only if they matched before s.
  A run of period q that ends inside must have begun before s and matched when the run of p was first known:
  else the two periods share a stretch as long as their sum, and their greatest common divisor is a period of both.
  When the run of p ends all lags are followed again; a lag without a known length is compared backwards,
  so lengths are always exact.

Windows are told apart by 64-bit mixes, and every diagonal is started by comparing the words themselves.
State per text: its word numbers and the lags active now. Work grows with the words and the pairs of equal windows
that do not lie in one common run; texts are whole, whatever their length.

Defined cases. Null and empty texts have no words, no runs and collapse to the empty text. Repeated rows are
answered each on its own, null ids stay, extra columns are ignored, an empty table gives no rows. Of two
runs with equal exponent the first counts as greatest, then the one with the smaller period.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.llm.common import hidden, sha256_hex, text_batches

MIN_WORDS = 24
MIN_PERIODS = 3
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def window_words(min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> int:
    """Consecutive matches that the diagonal of any run has, as a power of two."""
    least = min(max(min_words - q, (min_periods - 1) * q) for q in range(1, min_words + 1))
    return 1 << (max(1, least).bit_length() - 1)


def _divisors(q: int) -> list[int]:
    """Divisors below q."""
    small = [d for d in range(1, int(q**0.5) + 1) if q % d == 0]
    return sorted({*small, *[q // d for d in small]} - {q})


def _repeated(ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose window occurs more than once, in order, and a number for each window."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    step = 1
    while step < window:
        mixed = mixed[:-step] * np.uint64(0xBF58476D1CE4E5B9) + mixed[step:]
        mixed ^= mixed >> np.uint64(31)
        step *= 2
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    many = np.zeros(len(mixed), bool)
    many[1:] = same
    many[:-1] |= same
    group = np.empty(len(mixed), np.int64)
    group[order] = np.cumsum(np.concatenate(([0], ~same)))
    at = np.sort(order[many])
    return at, group[at]


def find_runs(ids: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start and period."""
    n = len(ids)
    window = window_words(min_words, min_periods)
    if n < min_words:
        return []
    places, groups = _repeated(ids, window)
    if not len(places):
        return []
    word = ids.tolist()
    most = n // min_periods  # longer lags can't repeat often enough
    seen: dict[int, list[int]] = {}
    active: dict[int, int] = {}  # lag -> words matched in a row
    found: list[tuple[int, int, int]] = []
    period = 0  # of the run that is going on, if there is one
    last = -2

    def ended(lags: dict[int, int], table: dict[int, int], end: int) -> None:
        """``lags`` do not match at word ``end``; ``table`` has all lags that matched before it."""
        for lag, matched in lags.items():
            length = matched + lag
            if length >= min_words and length >= min_periods * lag:
                if not any(table.get(d, 0) >= length - d for d in _divisors(lag)):
                    found.append((end - length, length, lag))

    for k, group in zip(places.tolist(), groups.tolist()):
        if k != last + 1 and active:
            ended(active, active, last + window)
            active, period = {}, 0
        last = k
        at = k + window - 1  # the word that this window adds
        if period and word[at] != word[at - period]:
            period = 0
        earlier = seen.setdefault(group, [])
        now = {lag: m + 1 for lag, m in active.items() if lag > period and word[at] == word[at - lag]} if period else {}
        for j in earlier[bisect_left(earlier, k - (period or most)) :]:
            lag = k - j
            matched = active.get(lag)
            if matched is not None:
                if word[at] == word[at - lag]:
                    now[lag] = matched + 1
            elif word[j : j + window] == word[k : k + window]:
                back = 0
                while j > back and word[j - 1 - back] == word[k - 1 - back]:
                    back += 1
                now[lag] = window + back
        gone = {lag: m for lag, m in active.items() if lag not in now}
        if gone:
            ended(gone, active, at)
        earlier.append(k)
        active = now
        if not period:
            long = [lag for lag, m in active.items() if m >= (min_periods - 1) * lag and m + lag >= min_words]
            if long:
                period = min(long)
                begin = at + 1 - active[period] - period
                active = {lag: m for lag, m in active.items() if lag <= period or at + 1 - m - lag < begin}
    ended(active, active, last + window)
    return sorted(set(found), key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def kept_words(count: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False for words that a run holds after its first period."""
    change = np.zeros(count + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:count]) == 0


def scan(text: Column) -> Column:
    """Struct of a text's ``runs`` and its ``collapsed`` form: kept words joined by one space."""

    @F.arrow_udf(f"runs array<{RUN}>, collapsed string")
    def of(texts: pa.Array) -> pa.Array:
        runs, collapsed = [], []
        for text in texts:
            # Bytes are split at the six ASCII white spaces only.
            words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
            found = find_runs(numbered(words))
            if found:
                words = [words[i] for i in np.flatnonzero(kept_words(len(words), found))]
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
            collapsed.append(b" ".join(words))
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        return pa.StructArray.from_arrays(
            [pa.array(runs, pa.list_(run)), pa.array(collapsed, pa.binary()).cast(pa.string())], ["runs", "collapsed"]
        )

    return of(text)


def with_runs(docs: DataFrame, runs: str = "runs", collapsed: str = "collapsed", text_col: str = "text") -> DataFrame:
    """Add the runs of every text and the text without their repetitions."""
    text_batches(docs.sparkSession)
    found = hidden("found")
    return (
        docs.withColumn(found, scan(F.col(text_col)))
        .withColumn(runs, F.col(found)["runs"])
        .withColumn(collapsed, F.col(found)["collapsed"])
        .drop(found)
    )


def greatest_run(runs: Column) -> Column:
    """The run with the greatest length over period; ties: the first in order. Null without runs."""

    def larger(best: Column, run: Column) -> Column:
        # length / period compared as a product, so that nothing is rounded
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), larger)


def run_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its number of runs, the greatest one, and digests of all runs and the collapsed text."""
    runs, collapsed, top = hidden("runs"), hidden("collapsed"), hidden("top")
    rows = with_runs(docs.select(id_col, text_col), runs, collapsed, text_col).withColumn(top, greatest_run(F.col(runs)))
    run = F.col(top)
    lines = F.transform(F.col(runs), lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.select(
        id_col,
        F.size(runs).cast("long").alias("n_runs"),
        *[run[c].alias(c) for c in ("start", "length", "period")],
        F.floor(F.lit(1000) * run["length"] / run["period"]).cast("long").alias("exponent_milli"),
        sha256_hex(F.array_join(lines, "")).alias("runs_sha256"),
        sha256_hex(F.col(collapsed)).alias("collapsed_sha256"),
    )


def plant_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Repeat a stretch of every tenth text by the CRC-32 of its id, so that there are runs to find.

    With h the checksum, g = floor(h / 10) and n words, texts with h % 10 = 0 get word a + (i - a) % p in
    place of every word i >= a, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). A null id plants nothing.
    """
    check = F.crc32(F.col(id_col).cast("string").cast("binary"))
    chosen, words, a, p = (hidden(x) for x in ("chosen", "words", "a", "p"))
    n, g = F.size(words).cast("long"), F.floor(check / 10).cast("long")
    # Only chosen texts are split.
    split = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.withColumn(chosen, F.coalesce(check % 10 == 0, F.lit(False)))
    rows = rows.withColumn(words, F.when(F.col(chosen), split)).withColumn(a, F.when(n > 0, g % n))
    rows = rows.withColumn(p, 1 + F.floor((n - F.col(a)) / (3 + g % 8)))
    repeated = F.transform(
        F.sequence(F.lit(0).cast("long"), n - 1),
        lambda i: F.get(F.col(words), F.when(i >= F.col(a), F.col(a) + (i - F.col(a)) % F.col(p)).otherwise(i).cast("int")),
    )
    planted = F.when(F.col(chosen) & (n > 0), F.array_join(repeated, " ")).otherwise(F.col(text_col))
    return rows.withColumn(text_col, planted).drop(chosen, words, a, p)
