"""Language ID with a byte convolutional network, trained in numpy.

A text's UTF-8 bytes are cut into fixed-length windows. Each byte is embedded, filters of
several widths run over the window, every filter's maximum over the window is kept, and a
softmax layer turns the maxima into language probabilities. A text's language has the highest
mean probability over all its windows, weighted by their bytes; that mean is the score.

The network is fitted on a bounded sample: about ``PER_LANGUAGE`` documents of each language, up
to ``WINDOWS_PER_TEXT`` windows of each, from rows with a language whose fold is not 0. Language,
source and id are never inputs of a prediction. Prediction is narrow and works in batches of
windows, so memory does not grow with a text's length beyond the text itself.

Defined results: null texts and texts without a letter get ``und`` and score 0; so does every text if
there is nothing to learn from; a null id is not held out and not learned from; of tied languages
the first in order is taken; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.llm.samples import labelled_sample
from eventweir.llm.tables import fold, fresh, table

UNDETERMINED = "und"
FOLDS = 5
PER_LANGUAGE = 400
WINDOWS_PER_TEXT = 8
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
EPOCHS = 4
BATCH = 128
RATE = 0.01
#: Windows of short texts that are judged together.
JOINED = 4096
#: Windows per matrix product when predicting.
CHUNK = 256
PADDING = 256


@dataclass
class ByteNetwork:
    """``embedding`` (257 x EMBEDDING), ``filters`` (widest x EMBEDDING, all filters; zero where a
    filter is narrower), ``bias``, ``softmax`` and ``prior``."""

    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    softmax: np.ndarray
    prior: np.ndarray

    @classmethod
    def blank(cls, languages: list[str], rng: np.random.Generator) -> ByteNetwork:
        widest, total = max(WIDTHS), len(WIDTHS) * FILTERS
        inputs = widest * EMBEDDING
        filters = rng.normal(0, (2 / inputs) ** 0.5, (inputs, total))
        arrays = rng.normal(0, 0.5, (257, EMBEDDING)), filters * _reach(), np.zeros(total), rng.normal(0, 0.1, (total, len(languages))), np.zeros(len(languages))
        return cls(languages, *[a.astype(np.float32) for a in arrays])

    @property
    def arrays(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.softmax, self.prior]

    def patches(self, windows: np.ndarray) -> np.ndarray:
        """The embedded bytes under the widest filter, at every position of every window."""
        embedded = self.embedding[windows].reshape(len(windows), -1)
        spans = np.lib.stride_tricks.sliding_window_view(embedded, max(WIDTHS) * EMBEDDING, axis=1)
        return spans[:, ::EMBEDDING]

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        patches = self.patches(windows)
        flat = np.ascontiguousarray(patches).reshape(-1, patches.shape[2])
        return patches, (flat @ self.filters).reshape(*patches.shape[:2], -1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        found = []
        for at in range(0, len(windows), CHUNK):
            _, maps = self.pooled(windows[at : at + CHUNK])
            found.append(_softmax(np.maximum(maps.max(axis=1) + self.bias, 0) @ self.softmax + self.prior))
        return np.concatenate(found)

    def gradients(self, windows: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
        patches, maps = self.pooled(windows)
        places = maps.argmax(axis=1)
        maxima = np.take_along_axis(maps, places[:, None], axis=1)[:, 0] + self.bias
        hidden = np.maximum(maxima, 0)
        error = _softmax(hidden @ self.softmax + self.prior)
        error[np.arange(len(truth)), truth] -= 1
        error /= len(truth)
        back = (error @ self.softmax.T) * (maxima > 0)
        under = patches[np.arange(len(windows))[:, None], places]  # what each maximum saw
        d_filters = np.einsum("wf,wfi->if", back, under) * _reach()
        d_under = (back[:, :, None] * self.filters.T).reshape(len(windows), -1, max(WIDTHS), EMBEDDING)
        seen = windows[np.arange(len(windows))[:, None, None], places[:, :, None] + np.arange(max(WIDTHS))]
        d_embedding = np.zeros_like(self.embedding)
        np.add.at(d_embedding, seen.ravel(), d_under.reshape(-1, EMBEDDING))
        return [d_embedding, d_filters, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]


def _reach() -> np.ndarray:
    """1 where a filter of its width has a weight, else 0."""
    rows = np.repeat(np.arange(max(WIDTHS)), EMBEDDING)[:, None]
    return (rows < np.repeat(WIDTHS, FILTERS)[None, :]).astype(np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, the last one padded, and their bytes."""
    raw = np.frombuffer(text.encode(), np.uint8)
    rows = -(-raw.size // WINDOW)
    padded = np.full(rows * WINDOW, PADDING, np.int16)
    padded[: raw.size] = raw
    sizes = np.full(rows, WINDOW)
    sizes[-1:] = raw.size - (rows - 1) * WINDOW
    return padded.reshape(rows, WINDOW), sizes


def trained(sample: list[tuple[list[str], str]], seed: int = 0) -> ByteNetwork | None:
    """A network fitted with Adam on labelled pieces of texts, a window each; None without any."""
    languages = sorted({label for _, label in sample})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    parts, truth = [], []
    for pieces, label in sample:
        parts += [windows_of(piece)[0][:1] for piece in pieces]
        truth += [languages.index(label)] * len(pieces)
    windows, truth = np.concatenate(parts), np.array(truth)
    network = ByteNetwork.blank(languages, rng)
    mean, spread = [np.zeros_like(a) for a in network.arrays], [np.zeros_like(a) for a in network.arrays]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            step += 1
            for i, (array, g) in enumerate(zip(network.arrays, network.gradients(windows[some], truth[some]), strict=True)):
                mean[i] = 0.9 * mean[i] + 0.1 * g
                spread[i] = 0.999 * spread[i] + 0.001 * g * g
                array -= (RATE * (mean[i] / (1 - 0.9**step)) / (np.sqrt(spread[i] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return network


def predicted(text: Column, network: ByteNetwork) -> Column:
    """``struct<language string, score double, clarity double>`` of texts that are not empty."""
    languages = network.languages

    @F.arrow_udf("struct<language: string, score: double, clarity: double>")
    def classify(texts: pa.Array) -> pa.Array:
        names, scores, clear = [], [], []
        for means, best in _judged([t.as_py() or " " for t in texts], network):
            top = int(means.argmax())
            names.append(languages[top])
            scores.append(float(min(means[top], 1.0)))
            clear.append(float(min(best, 1.0)))
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(clear, pa.float64())], names=["language", "score", "clarity"]
        )

    return classify(text)


def _judged(texts: list[str], network: ByteNetwork) -> Iterator[tuple[np.ndarray, float]]:
    """Per text the mean probability of each language, and the mean of each window's best one; both
    weighted by bytes. Windows of many short texts share a matrix product."""
    at = 0
    while at < len(texts):
        parts, n = [], 0
        while at < len(texts) and (not parts or n < JOINED):
            parts.append(windows_of(texts[at]))
            n += len(parts[-1][1])
            at += 1
        p = network.probabilities(np.concatenate([w for w, _ in parts])).astype(np.float64)
        sizes = np.concatenate([s for _, s in parts]).astype(np.float64)
        starts = np.concatenate([[0], np.cumsum([len(s) for _, s in parts])[:-1]])
        total = np.add.reduceat(sizes, starts)
        means = np.add.reduceat(p * sizes[:, None], starts, axis=0) / total[:, None]
        best = np.add.reduceat(p.max(axis=1) * sizes, starts) / total
        yield from zip(means, best.tolist(), strict=True)


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang; others are kept) with ``held_out, lang_pred, score, clarity``;
    underscores are added to names already taken. ``clarity`` is the mean of what the best language of
    each window has, so that a text in several languages, each of them clear, is clear too."""
    held_out, name, score, clarity, both = fresh(docs, "held_out", "lang_pred", "score", "clarity", "language_and_score")
    tests = F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False))
    known = docs.select("doc_id", "text", F.col("lang").alias("label")).where(fold(F.col("doc_id"), FOLDS) != 0)
    network = trained(labelled_sample(known, PER_LANGUAGE, WINDOWS_PER_TEXT, WINDOW))
    rows = docs.withColumn(held_out, tests)
    if network is None:
        return rows.withColumns({name: F.lit(UNDETERMINED), score: F.lit(0.0), clarity: F.lit(0.0)})
    worded = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = rows.withColumn(both, predicted(F.col("text"), network))
    return rows.withColumns(
        {
            name: F.when(worded, F.col(f"{both}.language")).otherwise(UNDETERMINED),
            score: F.when(worded, F.col(f"{both}.score")).otherwise(0.0),
            clarity: F.when(worded, F.col(f"{both}.clarity")).otherwise(0.0),
        }
    ).drop(both)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = identified(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return rows.select("doc_id", "held_out", "lang_pred", "score")
