"""Toxicity by compression distance: zstandard with a toxic and an ordinary dictionary.

Both dictionaries hold the same common words at the same places. Before them, the toxic one has
all segments (words and word beginnings) whose document frequency tells toxic training texts
significantly from ordinary ones, by the likelihood ratio, and the ordinary one has as many bytes
of ordinary words. They are chosen rather than trained by zstandard, whose dictionaries of both
labels differ mostly in ordinary words; near-copies count once, so that no copied text's words
pass for evidence. A text is cut into windows of a few words; a window's distance is the
difference of its two compressed lengths, ordinary minus toxic. A text's features are its largest
distances, how many windows reach the calibrated threshold and how many there are; a logistic curve fitted on
training texts that the dictionaries have not seen turns them into the score.

Fitted on a bounded sample of labelled rows (``PER_LABEL`` of each label) whose fold is not 1.
Scoring is narrow: every whole text, all its windows, no shuffle.

Defined results: null, empty and word-less texts score like a text without distances; without
both labels to learn from every score is 0; a null id is not held out and not learned from; an id
that is marked toxic and not toxic is toxic, and a mark holds for all rows of its id;
repeated rows each get a row; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.llm.samples import labelled_sample
from eventweir.llm.tables import fold, fresh, table

FOLDS = 3
HELD_OUT_FOLD = 1
PREDICTED_FROM = 0.7
PER_LABEL = 1500
#: Of a sampled text, so many pieces of so many characters at most; all of a text that is not longer.
PIECES = 20
PIECE = 1000
WINDOW_WORDS = 3
#: Characters of a word beginning that may be a segment.
SEGMENTS = range(4, 9)
#: Evidence (root of the likelihood ratio) that a segment needs.
LEAST_EVIDENCE = 4.0
COMMON_BYTES = 512
#: A text is a near-copy if earlier ones have half of its so many smallest hashes of three words.
SKETCH = 4
#: Stands after each window and at the end of both dictionaries: it always matches, so a window's
#: fixed costs are the same for both, and all of a window's words are searched for.
END = b" <0123456789#>"


def words_of(text: str) -> list[str]:
    return [word for token in text.lower().split() if (word := token.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))]


def windows_of(text: str) -> list[bytes]:
    words = words_of(text)
    return [f" {' '.join(words[at : at + WINDOW_WORDS])}".encode() + END for at in range(0, len(words), WINDOW_WORDS)]


def segments_of(text: str) -> set[str]:
    found = set()
    for word in set(words_of(text)):
        found.update(word[:n] for n in SEGMENTS if n < len(word))
        found.add(word)
    return found


def without_near_copies(texts: list[str]) -> list[str]:
    """The first text of every group of near-copies."""
    seen: set[int] = set()
    kept = []
    for text in texts:
        words = words_of(text)
        sketch = sorted({zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))})[:SKETCH]
        if 2 * sum(h in seen for h in sketch) < len(sketch):
            kept.append(text)
        seen.update(sketch)
    return kept


def evidence(a: int, n: int, b: int, m: int) -> float:
    """Root of the likelihood ratio of ``a`` of ``n`` against ``b`` of ``m``, signed."""

    def fit(k: int, of: int, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((of - k) * math.log(1 - p) if of > k else 0.0)

    pooled = (a + b) / (n + m)
    ratio = fit(a, n, a / n) + fit(b, m, b / m) - fit(a, n, pooled) - fit(b, m, pooled)
    return math.copysign(math.sqrt(max(0.0, 2 * ratio)), a / n - b / m)


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the toxic and the ordinary dictionary. Segments are taken by evidence, of equal
    ones the longest first; one that begins like a chosen one, or the reverse, adds nothing."""
    toxic, ordinary = without_near_copies(toxic), without_near_copies(ordinary)
    counts = {True: Counter(), False: Counter()}
    for label, texts in ((True, toxic), (False, ordinary)):
        for text in texts:
            counts[label].update(segments_of(text))
    score = {s: evidence(k, len(toxic), counts[False][s], len(ordinary)) for s, k in counts[True].items() if k > 2}
    chosen: list[str] = []
    for segment in sorted((s for s in score if score[s] >= LEAST_EVIDENCE), key=lambda s: (-score[s], -len(s), s)):
        if not any(segment.startswith(c) or c.startswith(segment) for c in chosen):
            chosen.append(segment)
    words = Counter()
    for text in ordinary:
        words.update(set(words_of(text)))
    usual = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0])) if score.get(w, 0.0) < 1.5]
    common = _filled(usual, COMMON_BYTES)
    special = _filled(chosen)
    rest = _filled([w for w in usual if len(w) > 4 and f" {w} ".encode() not in common], len(special))
    return special + common + END * 2, rest.rjust(len(special)) + common + END * 2


def _filled(words: list[str], most: float = math.inf) -> bytes:
    """The first words that fit, the first of them last, where matches cost least."""
    taken, size = [], 1
    for word in words:
        size += len(word.encode()) + 1
        if size > most:
            break
        taken.append(word)
    return f" {' '.join(reversed(taken))} ".encode() if taken else b" "


class Compressor:
    """Compressed lengths with one dictionary; frames without headers that only add noise."""

    def __init__(self, content: bytes) -> None:
        import zstandard

        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        log = max(12, len(content).bit_length())  # the tables hold every place of the dictionary
        settings = zstandard.ZstdCompressionParameters(
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
            window_log=log + 3, hash_log=log, chain_log=log, search_log=5, min_match=4, strategy=zstandard.STRATEGY_LAZY2,
        )
        dictionary.precompute_compress(compression_params=settings)
        self.compress = zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings).compress

    def lengths(self, windows: list[bytes]) -> np.ndarray:
        compress = self.compress
        return np.array([len(compress(w)) for w in windows], np.int64)


@dataclass
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    threshold: int = 0
    weights: tuple[float, ...] = ()

    def scorer(self):
        toxic, ordinary = Compressor(self.toxic), Compressor(self.ordinary)
        return lambda text: self.score(self.features(distances(text, toxic, ordinary)))

    def features(self, found: np.ndarray) -> np.ndarray:
        top = np.sort(np.append(found, [0, 0]))[-2:]
        reached = int((found >= self.threshold).sum())
        return np.array([1.0, top[1], top[0], math.log1p(reached), math.log1p(len(found))])

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(features @ np.array(self.weights)))))))


def distances(text: str, toxic: Compressor, ordinary: Compressor) -> np.ndarray:
    windows = windows_of(text)
    return ordinary.lengths(windows) - toxic.lengths(windows)


def best_threshold(largest: np.ndarray, truth: np.ndarray) -> int:
    """The distance that, as least value of a text's largest, has the highest sum of hit rates."""
    cuts = np.arange(1, max(2, int(largest.max(initial=0)) + 1))
    gains = [(largest[truth] >= c).mean() - (largest[~truth] >= c).mean() for c in cuts]
    return int(cuts[int(np.argmax(gains))])


def fitted_curve(features: np.ndarray, truth: np.ndarray, ridge: float = 0.5) -> tuple[float, ...]:
    """Logistic regression by Newton's method, both labels weighted alike."""
    share = np.where(truth, 0.5 / max(1, truth.sum()), 0.5 / max(1, (~truth).sum())) * len(truth)
    w = np.zeros(features.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (features.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        slope = features.T @ (share * (truth - p)) - penalty @ w
        bend = (features * (share * p * (1 - p))[:, None]).T @ features + penalty + 1e-6 * np.eye(len(w))
        w = w + np.linalg.solve(bend, slope)
    return tuple(map(float, w))


def trained(sample: list[tuple[str, int]]) -> ToxicityModel | None:
    """Dictionaries from two thirds of the sample, threshold and curve from the rest."""
    learn, calibrate = [x for i, x in enumerate(sample) if i % 3], sample[::3]
    toxic, ordinary = ([t for t, y in learn if y == label] for label in (1, 0))
    truth = np.array([y == 1 for _, y in calibrate], bool)
    if not toxic or not ordinary or truth.all() or not truth.any():
        return None
    model = ToxicityModel(*dictionaries(toxic, ordinary))
    one, other = Compressor(model.toxic), Compressor(model.ordinary)
    found = [distances(t, one, other) for t, _ in calibrate]
    model.threshold = best_threshold(np.array([d.max(initial=0) for d in found]), truth)
    model.weights = fitted_curve(np.stack([model.features(d) for d in found]), truth)
    return model


def toxicity(text: Column, model: ToxicityModel) -> Column:
    held: list = []  # the compressors, made once per worker

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(model.scorer())
        return pa.array([held[0](t.as_py() or "") for t in texts], pa.float64())

    return score(text)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text; others are kept) with ``held_out, score, predicted``; underscores
    are added to names already taken. ``labels`` has ``doc_id, toxic``."""
    held_out, score, predicted = fresh(docs, "held_out", "score", "predicted")
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(fold(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    sample = labelled_sample(docs.select("doc_id", "text"), PER_LABEL, PIECES, PIECE, known)
    model = trained([("".join(pieces) if len(pieces) < PIECES else " ".join(pieces), label) for pieces, label in sample])
    rows = docs.withColumn(held_out, F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD, F.lit(False)))
    rows = rows.withColumn(score, F.lit(0.0) if model is None else toxicity(F.col("text"), model))
    return rows.withColumn(predicted, (F.col(score) >= PREDICTED_FROM).cast("int"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "held_out", "score", "predicted")
