"""Toxicity by cumulative-link ordinal regression.

P(grade <= k) = logistic(theta_k - w . x): one weight vector for all ordered
thresholds theta. x are sparse text features, the words of a text and their
first four to eight letters, as indicators. The result is the expected grade.

Labels say toxic or not, so the grades above 0 are made from the labels
themselves: toxic rows are cut into thirds by how many different words they have
with a feature that marks toxic rows. Training uses a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import by_value, col, mapped
from tidemark.llm.labelled import sample

by_value(__name__)

GRADES = 4
WORDS = re.compile(r"[^\W\d_]+")


def parts(word: str) -> tuple[str, ...]:
    """A word's features: itself, and its beginnings (marked by a hyphen)."""
    return (word, *(word[:n] + "-" for n in range(4, 9) if len(word) > n))


@dataclass
class Model:
    #: feature -> weight
    weights: dict[str, float]
    #: rising thresholds, one fewer than grades
    theta: np.ndarray


def logistic(z):
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def thresholds(state: np.ndarray, names: int) -> np.ndarray:
    """After the weights, a state holds the first threshold and the steps' logarithms, so that they stay in order."""
    return state[names] + np.concatenate([[0.0], np.cumsum(np.exp(state[names + 1 :]))])


def objective(
    state: np.ndarray, names: int, row: np.ndarray, at: np.ndarray, grade: np.ndarray, weight: np.ndarray, ridge: float
) -> tuple[float, np.ndarray]:
    """Weighted negative log-likelihood of the grades plus half the ridge term, and its gradient.

    ``row`` and ``at`` are text and feature of each occurrence. The chance of grade
    k is logistic(theta[k] - z) - logistic(theta[k - 1] - z), z the text's sum of weights.
    """
    w, steps, theta = state[:names], np.exp(state[names + 1 :]), thresholds(state, names)
    z = np.bincount(row, w[at], len(grade))
    edge = np.concatenate([[-np.inf], theta, [np.inf]])
    upper, lower = logistic(edge[grade + 1] - z), logistic(edge[grade] - z)
    p = np.maximum(upper - lower, 1e-12)
    up, low = upper * (1 - upper) / p * weight, lower * (1 - lower) / p * weight
    by_theta = np.array([-up[grade == k].sum() + low[grade == k + 1].sum() for k in range(GRADES - 1)])
    grad = [
        np.bincount(at, (up - low)[row], names) + ridge * w,
        [by_theta.sum()],
        np.cumsum(by_theta[::-1])[::-1][1:] * steps,
    ]
    return float(-(weight * np.log(p)).sum() + 0.5 * ridge * (w**2).sum()), np.concatenate(grad)


def fit(
    texts: list[str], labels: np.ndarray, *, features: int = 4096, rounds: int = 300, ridge: float = 1e-3
) -> Model:
    """Features by likelihood ratio, grades, then weights and thresholds by gradient descent (Adam)."""
    if len(set(labels.tolist())) < 2:
        # Nothing to tell apart: every text gets the grade of the labels there are.
        only = float(labels[0]) if len(labels) else 0.0
        return Model({}, np.linspace(8.0, 10.0, GRADES - 1) * (1 if only == 0 else -1))
    # Words and features as numbers: a text's own strings are not kept.
    index: dict[str, int] = {}
    number: dict[str, int] = {}
    features_of: list[tuple[int, ...]] = []
    words, marks = [], []
    for text, y in zip(texts, labels.tolist()):
        own = []
        ws = set(WORDS.findall(text.lower()))
        for w in ws:
            if w not in number:
                number[w] = len(number)
                features_of.append(tuple(index.setdefault(f, len(index)) for f in parts(w)))
            own.append(number[w])
        words.append(np.array(own, np.int32))
        marks.append((y, *(min((zlib.crc32(w.encode(), start) for w in ws), default=0) for start in (0, 1))))
    # Near copies would make any of their words look like a mark: of rows with the same two least
    # word hashes one is used.
    alone = sorted({m: i for i, m in reversed(list(enumerate(marks)))}.values())
    words, labels = [words[i] for i in alone], labels[alone]
    found = [
        np.fromiter(sorted({f for w in ws.tolist() for f in features_of[w]}), np.int32) for ws in words
    ]
    seen, total = [], []
    for v in (0, 1):
        own = [x for x, y in zip(found, labels) if y == v]
        seen.append(np.bincount(np.concatenate(own), minlength=len(index)))
        total.append(len(own))
    p = [(seen[v] + 0.5) / (total[v] + 1.0) for v in (0, 1)]
    both = (seen[0] + seen[1] + 1.0) / (sum(total) + 2.0)
    gain = sum(
        seen[v] * np.log(p[v] / both) + (total[v] - seen[v]) * np.log((1 - p[v]) / (1 - both)) for v in (0, 1)
    )
    # Others are chance, or length alone.
    telling = (seen[0] + seen[1] >= 5) & (gain >= 8) & (np.maximum(*p) > 2 * np.minimum(*p))
    every = list(index)
    chosen = sorted(np.flatnonzero(telling).tolist(), key=lambda f: (-gain[f], every[f]))[:features]
    names = [every[f] for f in chosen]
    place = np.full(len(every), -1)
    place[chosen] = np.arange(len(chosen))
    marked = telling & (p[1] > p[0]) & (place >= 0)

    uses = np.array([sum(any(marked[f] for f in features_of[w]) for w in ws.tolist()) for ws in words])
    cuts = np.quantile(uses[labels == 1], [1 / 3, 2 / 3], method="higher")
    grade = np.where(labels == 1, 1 + np.searchsorted(cuts, uses, side="left"), 0)

    kept = [place[x][place[x] >= 0] for x in found]
    row = np.repeat(np.arange(len(kept)), [len(x) for x in kept])
    at = np.concatenate(kept)
    n = len(words)
    weight = np.where(labels == 1, 0.5 / total[1], 0.5 / total[0])
    state = np.concatenate([np.zeros(len(names)), [1.0], np.zeros(GRADES - 2)])
    m, v = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, rounds + 1):
        _, grad = objective(state, len(names), row, at, grade, weight, ridge)
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        state = state - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    theta = thresholds(state, len(names))
    return Model({f: float(x) for f, x in zip(names, state) if abs(x) > 1e-4}, theta)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    *,
    each: int = 4000,
    where: str = "true",
) -> Model:
    """Fits on at most ``each`` labelled rows of either label, in one task."""
    rows = sample(docs, labels, id_col, text_col, label_col, each=each, where=where)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        rows.sort(key=lambda r: (r[1], r[2] or ""))
        model = fit([r[2] or "" for r in rows], np.array([r[0] for r in rows], int))
        names = sorted(model.weights)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None] * len(model.theta) + names, pa.string()),
                pa.array([*model.theta.tolist(), *(model.weights[f] for f in names)], pa.float64()),
            ],
            ["feature", "value"],
        )

    out = rows.repartition(1).mapInArrow(run, "feature string, value double").collect()  # 4,099 rows at most
    if not out:
        return fit([], np.zeros(0, int))
    theta = np.array([r[1] for r in out if r[0] is None])
    return Model({r[0]: r[1] for r in out if r[0] is not None}, theta)


class Scorer:
    """Scores texts in a task; remembers which features a word has."""

    def __init__(self, model: Model):
        names = sorted(model.weights)
        self.index = {f: i for i, f in enumerate(names)}
        self.weights = np.array([model.weights[f] for f in names])
        self.theta = model.theta
        self.known: dict[str, tuple[int, ...]] = {}

    def above(self, texts: Iterator[str | None]) -> np.ndarray:
        """P(grade > k) by text and k."""
        z = []
        for text in texts:
            hits: set[int] = set()
            for w in set(WORDS.findall((text or "").lower())):
                own = self.known.get(w)
                if own is None:
                    own = tuple(self.index[f] for f in parts(w) if f in self.index)
                    if len(w) <= 64 and len(self.known) < 500_000:
                        self.known[w] = own
                if own:
                    hits.update(own)
            z.append(self.weights[sorted(hits)].sum() if hits else 0.0)
        return 1.0 - logistic(self.theta[None, :] - np.array(z)[:, None])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """doc_id, severity (expected grade, 0 to 3), p_toxic (of a grade above 0), grade, toxic, row by row.

    ``toxic`` is p_toxic >= ``least``; ``grade`` the likeliest grade. The whole
    text counts, null as empty; a text without known features has the thresholds
    alone. Repeated rows each get a row, an empty table none; other columns are
    not read.
    """
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            if not batch.num_rows:
                continue
            above = scorer.above(t.as_py() for t in batch.column(1))
            edge = np.ones((len(above), 1))
            p = -np.diff(np.concatenate([edge, above, 0 * edge], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(above.sum(axis=1)),
                    pa.array(np.ascontiguousarray(above[:, 0])),
                    pa.array(p.argmax(axis=1).astype(np.int32)),
                    pa.array((above[:, 0] >= least).astype(np.int32)),
                ],
                ["doc_id", "severity", "p_toxic", "grade", "toxic"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, severity double, p_toxic double, grade int, toxic int")


def survivors(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose p_toxic is below ``least``, with the columns of ``docs``; nothing is shuffled.

    The whole text is read. Null and empty texts have no features and get what the
    thresholds alone say; repeated rows each stay or go, and equal texts alike; an
    empty table gives none. Columns of any name pass through.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            if batch.num_rows:
                above = scorer.above(t.as_py() for t in batch.column(at))
                yield batch.filter(pa.array(above[:, 0] < least))

    return mapped(docs, run, docs.schema)
