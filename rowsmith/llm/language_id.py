"""Language of a text by a small convolutional network over bytes, in numpy.

Bytes of a window are embedded, filters of several widths slide over them, each filter's
largest answer in the window is kept, and a softmax layer turns these into languages. A text is
cut into windows of fixed length, all of it, and its prediction is the mean of its windows'
log-probabilities. The network is trained on the driver on a bounded sample of labelled rows;
tasks apply it to batches of windows.

Bounds. Training takes at most ``SAMPLE_TEXTS`` distinct texts of a language, those of the lowest hashes, and
``SAMPLE_WINDOWS`` windows of each, spread over it. At most ``BATCH_WINDOWS`` windows are worked on at once.

Defined cases. A null text or one without a letter is ``und`` with score 0; so is every text when there are no
labelled rows to learn from. A null id counts as the empty text for the held-out rule. Labels
that are null teach nothing. Repeated rows teach once and are predicted each on its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.llm.common import hidden, text_batches

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 4
SAMPLE_TEXTS = 400
SAMPLE_WINDOWS = 6
HASHES = float(1 << 53)
STEPS = 900
BATCH = 64
BATCH_WINDOWS = 512
SEED = 5
UNKNOWN = "und"


def windows_of(data: bytes, window: int = WINDOW) -> np.ndarray:
    """All windows of a text, the last one filled up with zeros."""
    rows = -(-len(data) // window)
    out = np.zeros(rows * window, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(rows, window)


class ByteNetwork:
    """Embedding, filters of several widths, max pooling and softmax."""

    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.reach = max(WIDTHS)
        filters = FILTERS * len(WIDTHS)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.weights = {
            "embed": draw(256, EMBEDDING, scale=0.5),
            "filter": draw(self.reach * EMBEDDING, filters, scale=0.4),
            "bias": np.zeros(filters, np.float32),
            "out": draw(filters, len(languages), scale=0.2),
            "out_bias": np.zeros(len(languages), np.float32),
        }
        # A filter of width w sees the first w places only.
        self.mask = np.concatenate(
            [np.repeat((np.arange(self.reach) < w)[:, None], FILTERS, axis=1) for w in WIDTHS], axis=1
        ).repeat(EMBEDDING, axis=0).astype(np.float32)
        self.weights["filter"] *= self.mask

    def _patches(self, rows: np.ndarray) -> np.ndarray:
        """(windows, places, reach * embedding): what every place sees, zeros beyond the end."""
        padded = np.pad(rows, ((0, 0), (0, self.reach - 1)))
        seen = self.weights["embed"][padded]
        width = rows.shape[1]
        return np.concatenate([seen[:, o : o + width] for o in range(self.reach)], axis=2)

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        w = self.weights
        answers = self._patches(rows).reshape(-1, self.reach * EMBEDDING) @ w["filter"]
        pooled = np.maximum(answers.reshape(len(rows), rows.shape[1], -1).max(axis=1) + w["bias"], 0)
        scores = pooled @ w["out"] + w["out_bias"]
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))

    def _gradients(self, rows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        n, width = rows.shape
        patches = self._patches(rows)
        answers = (patches.reshape(-1, self.reach * EMBEDDING) @ w["filter"]).reshape(n, width, -1)
        place = answers.argmax(axis=1)
        top = np.take_along_axis(answers, place[:, None], axis=1)[:, 0] + w["bias"]
        pooled = np.maximum(top, 0)
        scores = pooled @ w["out"] + w["out_bias"]
        share = np.exp(scores - scores.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        share[np.arange(n), labels] -= 1
        share /= n
        back = (share @ w["out"].T) * (top > 0)
        seen = patches[np.arange(n)[:, None], place]  # (windows, filters, reach * embedding)
        to_seen = back[:, :, None] * w["filter"].T[None]
        embed = np.zeros_like(w["embed"])
        padded = np.pad(rows, ((0, 0), (0, self.reach - 1)))
        for o in range(self.reach):
            byte = padded[np.arange(n)[:, None], place + o]
            np.add.at(embed, byte.reshape(-1), to_seen[:, :, o * EMBEDDING : (o + 1) * EMBEDDING].reshape(-1, EMBEDDING))
        return {
            "embed": embed,
            "filter": np.einsum("nfk,nf->kf", seen, back) * self.mask,
            "bias": back.sum(axis=0),
            "out": pooled.T @ share,
            "out_bias": share.sum(axis=0),
        }

    def train(self, rows: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> ByteNetwork:
        """Adam on batches that hold every language equally often."""
        rng = np.random.default_rng(seed)
        groups = [np.flatnonzero(labels == i) for i in range(len(self.languages))]
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(g, max(1, BATCH // len(groups))) for g in groups])
            rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in self._gradients(rows[pick], labels[pick]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                self.weights[k] = (self.weights[k] - rate * move).astype(np.float32)
        return self

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """Language and probability of each text that is not empty."""
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts))
        held: list[np.ndarray] = []
        owner: list[np.ndarray] = []

        def flush() -> None:
            rows, who = np.concatenate(held), np.concatenate(owner)
            for at in range(0, len(rows), BATCH_WINDOWS):
                part = who[at : at + BATCH_WINDOWS]
                np.add.at(total, part, self.log_probabilities(rows[at : at + BATCH_WINDOWS]))
                np.add.at(count, part, 1)
            held.clear()
            owner.clear()

        waiting = 0
        for i, data in enumerate(texts):
            rows = windows_of(data)
            held.append(rows)
            owner.append(np.full(len(rows), i))
            waiting += len(rows)
            if waiting >= 4 * BATCH_WINDOWS:
                flush()
                waiting = 0
        if held:
            flush()
        mean = total / np.maximum(count, 1)[:, None]
        share = np.exp(mean - mean.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        return [self.languages[b] for b in best], [float(share[i, b]) for i, b in enumerate(best)]


def held_out(id_col: str = "doc_id") -> Column:
    """True for ids whose CRC-32 leaves 1 when divided by three."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def training_sample(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", texts: int = SAMPLE_TEXTS
) -> list[tuple[str, str]]:
    """(language, text) of at most ``texts`` distinct texts of each language: those with the lowest hashes.

    Copies count once, so a language of many rows and few texts gives all its texts. The number of distinct
    texts is only estimated; the share of hashes looked at grows until every language has enough or all.
    """
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.shiftrightunsigned(F.xxhash64(F.lit(SEED), text_col), 11).alias("h")
    )
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()  # a row per language
    limits = {r["lang"]: HASHES * min(1.0, 4.0 * texts / max(1, r["n"])) for r in counts}
    cuts: dict[str, int] = {}
    while limits.keys() - cuts.keys():
        waiting = {k: v for k, v in limits.items() if k not in cuts}
        low = labelled.filter(F.col("h") < _by_language(waiting)).groupBy("lang", "h").agg(F.lit(1))
        for r in low.groupBy("lang").agg(F.sort_array(F.collect_list("h")).alias("h")).collect():
            if len(r["h"]) >= texts or limits[r["lang"]] >= HASHES:
                cuts[r["lang"]] = r["h"][: texts][-1]
        limits = {k: v if k in cuts else min(HASHES, 8 * v) for k, v in limits.items()}
    if not cuts:
        return []
    few = labelled.filter(F.col("h") <= _by_language(cuts))
    chosen = few.groupBy("lang", "h").agg(F.min("text").alias("text")).collect()
    return [(r["lang"], r["text"]) for r in sorted(chosen, key=lambda r: (r["lang"], r["h"]))]


def _by_language(values: dict) -> Column:
    """The value of a row's language; null for others."""
    return F.coalesce(*[F.when(F.col("lang") == k, F.lit(v)) for k, v in values.items()])


def fit(sample: list[tuple[str, str]]) -> ByteNetwork | None:
    languages = sorted({lang for lang, _ in sample})
    rows, labels = [], []
    for lang, text in sample:
        found = windows_of(text.encode("utf-8", "surrogatepass"))
        if len(found):
            pick = np.unique(np.linspace(0, len(found) - 1, SAMPLE_WINDOWS).astype(int))
            rows.append(found[pick])
            labels.append(np.full(len(pick), languages.index(lang)))
    if not rows:
        return None
    return ByteNetwork(languages).train(np.concatenate(rows), np.concatenate(labels))


def with_language(docs: DataFrame, network: ByteNetwork | None, name: str = "language", text_col: str = "text") -> DataFrame:
    """Add a struct column ``name``: lang_pred and score."""
    text_batches(docs.sparkSession)

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        data = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in texts]
        langs, scores = network.predict(data)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    letters = F.regexp_like(F.col(text_col), F.lit(r"\p{L}"))
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if network is None:
        return docs.withColumn(name, unknown)
    read = hidden("read")
    return (
        docs.withColumn(read, predict(F.when(letters, F.col(text_col))))
        .withColumn(name, F.when(letters, F.col(read)).otherwise(unknown))
        .drop(read)
    )


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score. Learns from rows that are not held out."""
    network = fit(training_sample(docs.filter(~held_out(id_col)), text_col, lang_col))
    found = hidden("found")
    read = with_language(docs.select(id_col, text_col), network, found, text_col)
    return read.select(
        id_col, held_out(id_col).alias("held_out"), F.col(found)["lang_pred"].alias("lang_pred"), F.col(found)["score"].alias("score")
    )
