"""Quality scores by Bradley-Terry pairwise ranking.

Each preference says that one document is better than another. A document's raw score is w.x of its
text features x; the chance that document i is preferred to j is sigmoid(w.x_i - w.x_j). The weights
minimise the logistic loss on feature differences over the preference pairs, with a small ridge.
Raw scores are then cut at a score quantile: the share of unwanted documents among the labelled
ones. The score given out is a logistic curve through that cut, so it rises with the raw score and
equals ``THRESHOLD`` exactly at the quantile.

Features are shares and ratios of the whole text, none of its length alone, language, source or id.
They come from one pass with bounded memory per text beyond the words of the text itself.

The fit uses a bounded sample of labelled rows (``SAMPLE``, taken in hash order, so the same rows on
any partitioning) and a bounded number of preference pairs (``PAIRS``); scoring is map-only over all
documents.

Defined results: a null text is scored like an empty one; labels of unknown documents, null labels
and labels of null ids teach nothing; a document with several labels teaches each once; without
labels of both kinds every score is 1.0, since nothing is known against any document; repeated rows
are scored one by one; all columns stay.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreline.llm.common import claim, utf8

#: Labelled rows and preference pairs a fit may use.
SAMPLE, PAIRS = 20_000, 200_000
#: Pairs whose feature differences are held at a time.
PAIR_BLOCK = 8_192
#: Score at which a document is kept.
THRESHOLD = 0.3
RIDGE = 1e-3

FEATURES = (
    "upper share of letters",
    "digit share",
    "sign share",
    "sign runs per word",
    "bars per word",
    "exclamation marks per word",
    "word mean length",
    "very long words",
    "commonest word beyond chance",
    "equal neighbours",
    "distinct words, length-corrected",
    "distinct lines",
    "commonest line share",
    "sentence marks per word",
    "bytes beyond ASCII",
    "compressed share",
    "empty",
)
_UPPER, _LOWER, _DIGIT = (bytes(range(a, b + 1)) for a, b in ((0x41, 0x5A), (0x61, 0x7A), (0x30, 0x39)))
_SIGNS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
_RUN = re.compile(rb"([!-/:-@\[-`{-~])\1{1,}")
#: The text is compressed in blocks of so many bytes, each with a fixed overhead that is taken off.
_BLOCK, _OVERHEAD = 4096, 11


def _kept(text: bytes, keep: bytes) -> int:
    return len(text) - len(text.translate(None, keep))


def features(text: bytes) -> list[float]:
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    lowered = Counter(words)
    top = lowered.most_common(1)[0][1]
    lines = [x for x in text.split(b"\n") if x]
    line_counts = Counter(lines)
    upper = _kept(text, _UPPER)
    letters = upper + _kept(text, _LOWER)
    wide = size - len(text.translate(None, bytes(range(0x80, 0x100))))
    packed = sum(len(zlib.compress(text[i : i + _BLOCK], 1)) - _OVERHEAD for i in range(0, size, _BLOCK))
    equal = sum(map(bytes.__eq__, words, words[1:]))
    return [
        upper / (letters + 1),
        _kept(text, _DIGIT) / size,
        _kept(text, _SIGNS) / size,
        len(_RUN.findall(text)) / n,
        words.count(b"|") / n,
        text.count(b"!") / n,
        min(20.0, (size - n) / n) / 20,
        sum(len(w) > 40 for w in lowered) / n,
        max(0.0, (top - 2 - 0.1 * n) / n),
        equal / n,
        np.log(len(lowered) + 1) / np.log(n + 1),
        len(line_counts) / max(1, len(lines)),
        (max(line_counts.values()) - 1) / max(1, len(lines)),
        min(0.3, (text.count(b".") + text.count(b"?")) / n),
        wide / size,
        min(0.6, packed / size),
        0.0,
    ]


def _matrix(texts) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


def feature_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def compute(column: pa.Array) -> pa.Array:
        return pa.array([features(t) for t in utf8(column)], pa.list_(pa.float64()))

    return compute(text)


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float
    shift: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -35, 35)))


def _newton(width: int, sums, ridge: float, steps: int = 40) -> np.ndarray:
    """Newton's method on a mean logistic loss plus a ridge; ``sums(w)`` gives the loss's mean slope and curvature."""
    w = np.zeros(width)
    for _ in range(steps):
        slope, curve = sums(w)
        step = np.linalg.solve(curve + ridge * np.eye(width), slope + ridge * w)
        w -= step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-9:
            break
    return w


def _chance(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = _chance(x @ w)
        return x.T @ (p - y) / len(y), (x * (p * (1 - p))[:, None]).T @ x / len(y)

    return _newton(x.shape[1], sums, ridge)


def fit_preferences(z: np.ndarray, better: np.ndarray, worse: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Bradley-Terry weights: row ``better[k]`` of ``z`` is preferred to row ``worse[k]``. Differences exist a block of
    ``PAIR_BLOCK`` pairs at a time."""

    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slope, curve = np.zeros(z.shape[1]), np.zeros((z.shape[1], z.shape[1]))
        for at in range(0, len(better), PAIR_BLOCK):
            diff = z[better[at : at + PAIR_BLOCK]] - z[worse[at : at + PAIR_BLOCK]]
            p = _chance(diff @ w)
            slope += diff.T @ (p - 1)
            curve += (diff * (p * (1 - p))[:, None]).T @ diff
        return slope / len(better), curve / len(better)

    return _newton(z.shape[1], sums, ridge)


def fit(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = 10, ridge: float = RIDGE, threshold: float = THRESHOLD) -> Ranker | None:
    """A ranker from labelled feature rows; every good row is preferred to every bad row."""
    good = good.astype(bool)
    if good.all() or not good.any():
        return None
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.clip((x - mean) / scale, -8, 8)
    a, b = np.flatnonzero(good), np.flatnonzero(~good)
    if len(a) * len(b) <= pairs:
        i, j = np.repeat(a, len(b)), np.tile(b, len(a))
    else:
        rng = np.random.default_rng(seed)
        i, j = rng.choice(a, pairs), rng.choice(b, pairs)
    w = fit_preferences(z, i, j, ridge)
    raw = z @ w
    cut = float(np.quantile(raw, len(b) / len(x)))
    # the curve's steepness: logistic fit of the labels on the distance from the cut
    spread = max(float(raw.std()), 1e-9)
    slope = max(float(_logistic(((raw - cut) / spread)[:, None], good.astype(float), 1e-3)[0]), 1e-3) / spread
    return Ranker(mean, scale, w, slope, float(np.log(threshold / (1 - threshold)) - slope * cut))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True where crc32 of the id as text leaves no rest; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Ranker | None:
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.select(F.col(id_col).alias("k"), (F.col(label) == 1).alias("good")).distinct()
    known = F.broadcast(known.orderBy(F.xxhash64("k"), "k", "good").limit(sample))  # at most ``sample`` ids
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).join(known, "k")
    rows = rows.select("k", "good", feature_column(F.col("t")).alias("x")).groupBy("k", "good").agg(F.min("x").alias("x"))
    rows = rows.orderBy("k", "good").select("good", "x").toArrow()  # at most ``sample`` small rows
    if not rows.num_rows:
        return None
    x = rows["x"].combine_chunks()
    flat = pa.concat_arrays([c.flatten() for c in x.chunks]) if isinstance(x, pa.ChunkedArray) else x.flatten()
    return fit(flat.to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1), rows["good"].to_numpy())


def score_quality(docs: DataFrame, ranker: Ranker | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus ``out``, which must be a free name."""
    claim(docs, out)
    if ranker is None:
        return docs.withColumn(out, F.lit(1.0))

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array(ranker.score(_matrix(utf8(column))), pa.float64())

    return docs.withColumn(out, score(F.col(text_col)))
