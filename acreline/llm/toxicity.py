"""Toxicity categories by a chain of linear classifiers.

Categories are predicted one after the other. The model of a category sees the text's words and the
probabilities of all categories before it. In training those probabilities are out of fold: each
labelled text gets them from models that were fitted without it, so a later model meets the same kind of
input as in scoring. Scoring runs the chain in the same order.

Words are runs of letters and digits after lowering A-Z. Terms are whole words and pieces of 3 to 5
bytes inside words, so that inflected forms of a stem count too. A model uses up to ``TERMS`` terms whose
presence tells its category apart best (log-likelihood ratio), found in ``MIN_TEXTS`` of its texts or
more; a term that occurs in nearly the same texts as a better one is left out.

The labels table has one toxic mark per document. The chain here is ``toxic``, as marked, then ``repeated``
and ``dense``: toxic with at least ``REPEATED`` marking terms, and toxic with one in ``DENSE`` words at least.
Marking terms are those that a first model of ``toxic`` weighs above ``STRONG``. A document is flagged at the
probability of ``toxic`` that separates the out-of-fold predictions best (F1), 0.3 at least.

The fit uses a bounded sample of labelled rows in hash order (``SAMPLE``); scoring is map-only.

Defined results: a null text has no words and gets what the constants give; null labels and labels of
unknown documents teach nothing; with labels of one kind only, a category's probability is the share of
that kind; repeated rows are scored one by one; an empty table gives an empty table; all columns stay.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.llm.common import claim, utf8
from acreline.llm.decontaminate import words_of

SAMPLE = 6_000
#: The ridge is that of a third of a labelled text, however many there are.
TERMS, MIN_TEXTS, FOLDS, RIDGE = 96, 3, 4, 0.3
#: Candidates of a model, and the share of common texts at which the weaker of two terms is left out.
CANDIDATES, OVERLAP = 800, 0.9
PIECES = (3, 4, 5)
REPEATED, DENSE, STRONG = 3, 100, 1.0
CATEGORIES = ("toxic", "repeated", "dense")


def normal_form(words: Iterable[bytes]) -> bytes:
    """Words with one blank around each: a whole word is the term ``b" word "``."""
    return b" %s " % b" ".join(words)


def _terms(words: Iterable[bytes]) -> set[bytes]:
    out = set()
    for w in words:
        out.add(b" %s " % w)
        out.update(w[i : i + n] for n in PIECES for i in range(len(w) - n + 1))
    return out


class Postings:
    """In which labelled texts each term occurs."""

    def __init__(self, texts: list[Counter]):
        found: dict[bytes, list[int]] = defaultdict(list)
        for i, words in enumerate(texts):
            for term in _terms(words):
                found[term].append(i)
        kept = sorted((t, p) for t, p in found.items() if len(p) >= MIN_TEXTS)
        self.terms = [t for t, _ in kept]
        self.flat = np.fromiter((i for _, p in kept for i in p), np.int64)
        self.starts = np.cumsum([0, *(len(p) for _, p in kept)])
        self.rows = len(texts)

    def counts(self, chosen: np.ndarray) -> np.ndarray:
        return np.add.reduceat(chosen[self.flat].astype(np.int64), self.starts[:-1]) if self.terms else np.zeros(0, np.int64)

    def column(self, term: int) -> np.ndarray:
        out = np.zeros(self.rows, np.float32)
        out[self.flat[self.starts[term] : self.starts[term + 1]]] = 1
        return out

    def best(self, inside: np.ndarray, outside: np.ndarray) -> list[int]:
        a, b = self.counts(inside), self.counts(outside)
        n1, n0 = max(1, int(inside.sum())), max(1, int(outside.sum()))
        with np.errstate(divide="ignore", invalid="ignore"):
            p, q, r = a / n1, b / n0, (a + b) / (n1 + n0)
            gain = np.where(a > 0, a * np.log(p / r), 0) + np.where(b > 0, b * np.log(q / r), 0)
        gain[(a < MIN_TEXTS) | (p <= q)] = -1
        # equal gain: the longer term says more
        order = sorted(np.flatnonzero(gain > 2), key=lambda k: (-round(float(gain[k]), 6), -len(self.terms[k]), self.terms[k]))[:CANDIDATES]
        if not order:
            return []
        columns = np.stack([self.column(k) for k in order]) * (inside | outside)
        size = columns.sum(axis=1)
        open_, chosen = np.ones(len(order), bool), []
        for k in range(len(order)):
            if open_[k]:
                chosen.append(order[k])
                if len(chosen) == TERMS:
                    break
                open_ &= columns @ columns[k] < OVERLAP * np.minimum(size, size[k])
        return chosen


@dataclass
class Link:
    """One model of the chain: weights of terms, of earlier probabilities, and a constant."""

    terms: dict[bytes, float] = field(default_factory=dict)
    earlier: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0

    def probability(self, text: bytes, before: list[float]) -> float:
        z = self.bias + sum(w for t, w in self.terms.items() if t in text)
        z += sum(w * p for w, p in zip(self.earlier, before))
        return float(1 / (1 + np.exp(-min(35.0, max(-35.0, z)))))


def fit_link(postings: Postings, before: np.ndarray, y: np.ndarray, rows: np.ndarray) -> tuple[Link, np.ndarray]:
    """A model from the texts where ``rows`` is true, and its probabilities for all texts."""
    y = y.astype(bool)
    n = int(rows.sum())
    mark = y[rows]
    if not n or mark.all() or not mark.any():
        share = min(max(float(mark.mean()) if n else 0.5, 1e-4), 1 - 1e-4)
        link = Link(earlier=np.zeros(before.shape[1]), bias=float(np.log(share / (1 - share))))
        return link, np.full(len(y), share)
    chosen = postings.best(y & rows, ~y & rows)
    x = np.column_stack([*(postings.column(k) for k in chosen), before, np.ones(len(y))])
    ridge = np.full(x.shape[1], RIDGE / n)
    ridge[-1] = 1e-9
    w, part = np.zeros(x.shape[1]), x[rows]
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
        slope = part.T @ (p - mark) / n + ridge * w
        step = np.linalg.solve((part * (p * (1 - p))[:, None]).T @ part / n + np.diag(ridge), slope)
        w -= step / max(1.0, np.abs(step).max() / 3)
        if np.abs(step).max() < 1e-6:
            break
    terms = dict(zip((postings.terms[k] for k in chosen), w[: len(chosen)].tolist()))
    return Link(terms, w[len(chosen) : -1], float(w[-1])), 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))


@dataclass
class Chain:
    names: tuple[str, ...]
    links: list[Link]
    threshold: float = 0.5

    def probabilities(self, words: list[bytes]) -> list[float]:
        text, out = normal_form(words), []
        for link in self.links:
            out.append(link.probability(text, out))
        return out


def _best_cut(p: np.ndarray, y: np.ndarray) -> float:
    if not y.any() or y.all():
        return 0.5
    cuts = np.linspace(0.3, 0.95, 66)
    f1 = [2 * (y & (p >= c)).sum() / max(1, y.sum() + (p >= c).sum()) for c in cuts]
    best = np.flatnonzero(np.isclose(f1, max(f1)))
    return float(cuts[best[len(best) // 2]])  # the middle of the best stretch


def fit_chain(names: tuple[str, ...], postings: Postings, marks: np.ndarray, folds: np.ndarray) -> Chain:
    """``marks``: a column per category. ``folds``: fold number of each text."""
    links: list[Link] = []
    before = np.zeros((len(marks), 0))
    for k in range(len(names)):
        links.append(fit_link(postings, before, marks[:, k], np.ones(len(marks), bool))[0])
        out = np.zeros(len(marks))
        for fold in np.unique(folds):
            out[folds == fold] = fit_link(postings, before, marks[:, k], folds != fold)[1][folds == fold]
        before = np.column_stack([before, out])
    return Chain(names, links, _best_cut(before[:, 0], marks[:, 0].astype(bool)) if len(marks) else 0.5)


def categories(texts: list[Counter], postings: Postings, toxic: np.ndarray) -> np.ndarray:
    """toxic, repeated, dense: the last two by the terms that mark toxic texts."""
    if not len(texts):
        return np.zeros((0, 3), bool)
    first, _ = fit_link(postings, np.zeros((len(texts), 0)), toxic, np.ones(len(texts), bool))
    strong = [t for t, weight in first.terms.items() if weight > STRONG]
    marking = lambda w: any(t in b" %s " % w for t in strong)
    hits = np.array([sum(n for w, n in words.items() if marking(w)) if mark else 0 for words, mark in zip(texts, toxic)], np.int64)
    sizes = np.array([max(1, sum(words.values())) for words in texts], np.int64)
    return np.column_stack([toxic, toxic & (hits >= REPEATED), toxic & (hits * DENSE >= sizes)])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Chain:
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("k"), (F.col(label) == 1).alias("mark")).distinct()
    known = known.orderBy(F.xxhash64("k"), "k", "mark").limit(sample)

    @F.arrow_udf("binary")
    def packed(column: pa.Array) -> pa.Array:
        """Distinct words and their counts; only these reach the driver, not the texts."""
        rows = []
        for t in utf8(column):
            counts = Counter(words_of(t))
            rows.append(zlib.compress(b"\n".join(b"%s %d" % x for x in sorted(counts.items()))))
        return pa.array(rows, pa.binary())

    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).join(known, "k").select("k", "mark", packed(F.col("t")).alias("w"))
    rows = rows.groupBy("k", "mark").agg(F.min("w").alias("w")).orderBy("k", "mark").collect()  # at most ``sample`` rows
    texts, toxic, folds = [], [], []
    for row in rows:
        pairs = (x.rsplit(b" ", 1) for x in zlib.decompress(bytes(row["w"])).split(b"\n") if x)
        texts.append(Counter({w: int(n) for w, n in pairs}))
        toxic.append(row["mark"])
        folds.append(zlib.crc32(str(row["k"]).encode()) % FOLDS)
    postings = Postings(texts)
    marks = categories(texts, postings, np.array(toxic, bool))
    return fit_chain(CATEGORIES, postings, marks, np.array(folds, np.int64))


def score_toxicity(docs: DataFrame, chain: Chain, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """The documents plus ``out``, a free name: one probability per category, in chain order, and the flag."""
    claim(docs, out)
    fields = [(n, pa.float64()) for n in chain.names] + [("flagged", pa.bool_())]
    kind = f"struct<{', '.join(f'{n}: double' for n in chain.names)}, flagged: boolean>"

    @F.arrow_udf(kind)
    def score(column: pa.Array) -> pa.Array:
        rows = []
        for t in utf8(column):
            p = chain.probabilities(words_of(t))
            rows.append({**dict(zip(chain.names, p)), "flagged": p[0] >= chain.threshold})
        return pa.array(rows, pa.struct(fields))

    return docs.withColumn(out, score(F.col(text_col)))
