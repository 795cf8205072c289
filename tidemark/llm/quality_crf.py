"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad, judged by its own features, those of the lines before
and after it, and the labels beside it. Forward-backward gives each line's
probability of being good, and the mean of these, weighted by length, says how
good the document is; a logistic curve turns it into a probability of label 1.

Labels are for documents. Training begins with every line of a document labelled
like it, then lines of bad documents that the field takes for good are labelled
good (one line at least stays bad), and the field is trained once more.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, col
from tidemark.llm.hmm import Layout
from tidemark.llm.labelled import sample

by_value(__name__)

#: Code points of text that are looked at together.
TEXT = 4_000_000
UPPER, LETTER, DIGIT, SPACE, SHOUT, BAR, SIGN, POINT, OTHER = range(9)


def _kinds() -> np.ndarray:
    """Kind of each code point below 0x3000; the others count as letters."""
    table = np.full(0x3000, OTHER, np.uint8)
    for c in map(chr, range(0x3000)):
        if c.isspace():
            kind = SPACE
        elif c.isupper():
            kind = UPPER
        elif c.isalpha():
            kind = LETTER
        elif c.isdigit():
            kind = DIGIT
        elif c == "!":
            kind = SHOUT
        elif c == "|":
            kind = BAR
        elif c in "#$%&*+/<=>@\\^_`{}[]~":
            kind = SIGN
        elif c in ".,;:?'\"()-":
            kind = POINT
        else:
            continue
        table[ord(c)] = kind
    return table


KINDS = _kinds()
#: A line's measures, and where they are cut into indicators.
CUTS = {
    "length": (1, 20, 80, 300),
    "words": (1, 4, 12, 50),
    "upper": (0.02, 0.1, 0.3, 0.6),
    "digit": (0.01, 0.1, 0.3),
    "shout": (0.005, 0.03),
    "bar": (0.005, 0.03),
    "sign": (0.005, 0.03, 0.1),
    "point": (0.001, 0.01, 0.03, 0.08),
    "other": (0.01, 0.1),
    "word_length": (2.5, 4.0, 5.5, 7.0, 9.0),
    "different": (0.3, 0.5, 0.7, 0.9),
    "copies": (1.5, 3.5),
}
WIDTH = sum(map(len, CUTS.values()))


def measure(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of all lines: indicators with those of their neighbours, lengths; and each text's line numbers."""
    lines, counts, rows, different, copies = [], [], [], [], []
    for t in texts:
        own = t.split("\n")
        rows.append(np.arange(len(lines), len(lines) + len(own)))
        lines.extend(own)
        met = Counter(own)
        copies.extend(met[x] for x in own)
        for x in own:
            words = x.split()
            counts.append(len(words))
            different.append(len(set(words)) / len(words) if words else 1.0)
    lengths = np.array([len(x) for x in lines])
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = np.where(codes < len(KINDS), KINDS[np.minimum(codes, len(KINDS) - 1)], LETTER)
    line = np.repeat(np.arange(len(lines)), lengths)
    share = np.bincount(line * 9 + kinds, minlength=9 * len(lines)).reshape(-1, 9) / np.maximum(lengths, 1)[:, None]
    words = np.array(counts)
    values = {
        "length": lengths, "words": words, "upper": share[:, UPPER], "digit": share[:, DIGIT],
        "shout": share[:, SHOUT], "bar": share[:, BAR], "sign": share[:, SIGN], "point": share[:, POINT],
        "other": share[:, OTHER], "word_length": (1 - share[:, SPACE]) * lengths / np.maximum(words, 1),
        "different": np.array(different), "copies": np.array(copies),
    }
    own = np.concatenate([values[k][:, None] >= np.array(cuts) for k, cuts in CUTS.items()], axis=1)
    first, last = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
    for r in rows:
        first[r[0]] = last[r[-1]] = True
    before = np.where(first[:, None], False, np.roll(own, 1, axis=0))
    after = np.where(last[:, None], False, np.roll(own, -1, axis=0))
    x = np.concatenate([own, before, after, first[:, None], last[:, None], np.ones((len(lines), 1), bool)], axis=1)
    return x.astype(np.float32), lengths, rows


@dataclass
class Model:
    weights: np.ndarray  # for good, against bad
    moves: np.ndarray  # (2, 2): bad or good, then bad or good
    slope: float = 1.0  # of the curve from the mean to a probability
    level: float = 0.0


def marginals(model: Model, x: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of each line; expected transitions; log of the sum over labellings, all texts."""
    unary = x @ model.weights.astype(np.float32)
    emit = np.stack([np.zeros_like(unary), unary], axis=1).astype(np.float64)[layout.tokens]
    top = emit.max(axis=1, keepdims=True)
    emit, total = np.exp(emit - top), float(top.sum())
    moves = np.exp(model.moves)
    kept, went = np.empty_like(emit), np.zeros((2, 2))
    alpha = np.ones((len(layout.order), 2))
    for t, m in enumerate(layout.active):
        at = layout.start[t]
        alpha = (alpha[:m] if t == 0 else alpha[:m] @ moves) * emit[at : at + m]
        scale = alpha.sum(axis=1, keepdims=True)
        alpha = alpha / scale
        total += float(np.log(scale).sum())
        kept[at : at + m] = alpha
    beta = np.ones((len(layout.order), 2))
    for t in range(len(layout.active) - 1, -1, -1):
        m, at = layout.active[t], layout.start[t]
        if t + 1 < len(layout.active):
            k, after = layout.active[t + 1], layout.start[t + 1]
            ahead = emit[after : after + k] * beta[:k]
            back = ahead @ moves.T
            scale = (kept[at : at + k] * back).sum(axis=1, keepdims=True)
            went += moves * (kept[at : at + k].T @ (ahead / scale))
            beta[:k] = back / scale
        both = kept[at : at + m] * beta[:m]
        kept[at : at + m] = both / both.sum(axis=1, keepdims=True)
    good = np.empty(len(x))
    good[layout.tokens] = kept[:, 1]
    return good, went, total


def learn(x: np.ndarray, layout: Layout, labels: np.ndarray, weight: np.ndarray, model: Model, rounds: int) -> Model:
    """Conditional likelihood of the line labels by gradient descent (Adam); ``weight`` by line."""
    state = np.concatenate([model.weights, model.moves.ravel()])
    m, v = np.zeros_like(state), np.zeros_like(state)
    seen = np.zeros((2, 2))
    for t in range(1, len(layout.active)):
        k = layout.active[t]
        a = labels[layout.tokens[layout.start[t - 1] : layout.start[t - 1] + k]]
        b = labels[layout.tokens[layout.start[t] : layout.start[t] + k]]
        seen += np.bincount(2 * a + b, minlength=4).reshape(2, 2)
    n = len(x)
    for step in range(1, rounds + 1):
        now = Model(state[:-4], state[-4:].reshape(2, 2))
        good, went, _ = marginals(now, x, layout)
        grad = np.concatenate([x.T @ ((good - labels) * weight).astype(np.float32), (went - seen).ravel()]) / n
        grad += 1e-4 * state
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        state = state - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Model(state[:-4], state[-4:].reshape(2, 2))


def means(good: np.ndarray, lengths: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Length-weighted mean by text; an empty line weighs like one character."""
    weight = np.maximum(lengths, 1)
    return np.array([np.average(good[r], weights=weight[r]) for r in rows])


def fit(texts: list[str], labels: np.ndarray, rounds: int = 150) -> Model:
    model = Model(np.zeros(3 * WIDTH + 3), np.zeros((2, 2)))
    if not texts:
        return model
    x, lengths, rows = measure(texts)
    layout = Layout(rows)
    line = np.zeros(len(x), int)
    for r, y in zip(rows, labels):
        line[r] = y
    weight = np.ones(len(x))
    for _ in range(2):
        model = learn(x, layout, line, weight, model, rounds)
        good, _, _ = marginals(model, x, layout)
        for r, y in zip(rows, labels):
            if y == 0:
                line[r] = good[r] >= max(0.5, good[r].min() + 1e-9)
    good, _, _ = marginals(model, x, layout)
    mean = means(good, lengths, rows)
    a, b = 1.0, 0.0
    for _ in range(2000):
        p = 0.5 * (1 + np.tanh(0.5 * (a * (2 * mean - 1) + b)))
        a -= 2.0 * (((p - labels) * (2 * mean - 1)).mean() + 1e-3 * a)
        b -= 2.0 * (p - labels).mean()
    model.slope, model.level = max(a, 1e-3), b
    return model


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    *,
    each: int = 3000,
    where: str = "true",
) -> Model:
    """Fits on at most ``each`` labelled rows of either label, in one task."""
    rows = sample(docs, labels, id_col, text_col, label_col, each=each, where=where)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        rows.sort(key=lambda r: (r[1], r[2] or ""))
        model = fit([r[2] or "" for r in rows], np.array([r[0] for r in rows], int))
        flat = np.concatenate([[model.slope, model.level], model.moves.ravel(), model.weights])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], ["at", "value"])

    out = dict(map(tuple, rows.repartition(1).mapInArrow(run, "at int, value double").collect()))
    if not out:
        return fit([], np.zeros(0, int))
    flat = np.array([out[i] for i in range(len(out))])
    return Model(flat[6:], flat[2:6].reshape(2, 2), flat[0], flat[1])


def score(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    cut: float = 0.3,
    held_part: int = 0,
    held_of: int = 5,
) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (score >= ``cut``), good_share, by row.

    The whole text counts and nothing else; null as empty, which is one empty
    line. ``held_out`` says whether crc32(identifier as text) mod ``held_of`` is
    ``held_part`` (a null identifier as empty text). Repeated rows each get a
    row, an empty table none; other columns are not read.
    """
    name = F.coalesce(col(id_col).cast("string"), F.lit(""))
    rows = docs.select(
        col(id_col).alias("doc_id"),
        (F.crc32(name.cast("binary")) % held_of == held_part).alias("held_out"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, size, at = [], 0, 0
            for i in range(batch.num_rows):
                texts.append(batch.column(2)[i].as_py())
                size += len(texts[-1])
                if size < TEXT and i + 1 < batch.num_rows:
                    continue
                x, lengths, lines = measure(texts)
                good, _, _ = marginals(model, x, Layout(lines))
                mean = means(good, lengths, lines)
                value = 0.5 * (1 + np.tanh(0.5 * (model.slope * (2 * mean - 1) + model.level)))
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:2],
                        pa.array(value),
                        pa.array((value >= cut).astype(np.int32)),
                        pa.array(mean),
                    ],
                    ["doc_id", "held_out", "score", "predicted", "good_share"],
                )
                texts, size, at = [], 0, i + 1

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, good_share double")
