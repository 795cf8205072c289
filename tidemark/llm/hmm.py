"""Scoring texts with a hidden Markov language model.

A text is a sequence of tokens and one end token. A latent state emits a class,
a class emits a word: p(word | state) = p(class | state) p(word | class). A word
with at least a ``1 / HEADS`` part of all training tokens is a class of its own
(so there are at most ``HEADS`` of those, whatever the corpus); any other word
falls into one of ``SHAPES`` classes by its ending, and within its class it has
the add-one share of its training count, unknown words together one count. So
the model has a bounded size, though every count of the vocabulary is in use.

1. Each task codes its documents against a dictionary of its own, cut into
   chunks of bounded size; dictionaries, not texts, meet in the count shuffle.
2. Counts and classes go back to each chunk's dictionary, and a chunk's documents
   become class sequences, with what depends on counts alone summed up.
3. Baum-Welch: every pass runs forward-backward over all whole training
   sequences; expected counts are added up per task and then across tasks.
4. The scaled forward recursion gives the exact likelihood of every sequence.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, col, least_hashed, stored

by_value(__name__)

HEADS = 65_536
SHAPES = 4_096
#: Bytes of text in a chunk; a longer document is a chunk of its own.
CHUNK = 16_000_000
#: Tokens that go through the recursions together.
TOKENS = 1_000_000
END = b""  # no word is empty
CODED = (
    "chunk bigint, doc_id {kind}, held_out boolean, codes binary, "
    "words array<binary>, counts array<bigint>"
)


def pack(codes: np.ndarray) -> bytes:
    """Codes as compressed byte planes."""
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(codes).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").reshape(-1).astype(np.int64)


def coded(docs: DataFrame, id_col: str, text_col: str, part: int, of: int) -> DataFrame:
    """A row per document with its codes, and one per chunk with its dictionary and training counts."""
    name = F.coalesce(col(id_col).cast("string"), F.lit(""))
    rows = docs.select(
        col(id_col).alias("doc_id"),
        (F.crc32(name.cast("binary")) % of == part).alias("held_out"),
        col(text_col).cast("string").alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = CODED.format(kind=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        shape = None

        def fresh():
            return defaultdict(count().__next__), [], [], [], 0

        def rows_of(chunk, index, ids, held, codes):
            nonlocal shape
            seen = np.zeros(len(index), np.int64)
            for own, h in zip(codes, held):
                if not h:
                    seen += np.bincount(own, minlength=len(index))
            n = len(ids)
            step = 2000
            for at in range(0, n, step):
                m = len(ids[at : at + step])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * m, pa.int64()),
                        pa.array(ids[at : at + step], shape),
                        pa.array(held[at : at + step], pa.bool_()),
                        pa.array([pack(c) for c in codes[at : at + step]], pa.binary()),
                        pa.nulls(m, pa.list_(pa.binary())),
                        pa.nulls(m, pa.list_(pa.int64())),
                    ],
                    names,
                )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk], pa.int64()),
                    pa.nulls(1, shape),
                    pa.nulls(1, pa.bool_()),
                    pa.nulls(1, pa.binary()),
                    pa.array([list(index)], pa.list_(pa.binary())),
                    pa.array([seen], pa.list_(pa.int64())),
                ],
                names,
            )

        names = ["chunk", "doc_id", "held_out", "codes", "words", "counts"]
        chunk = 0
        index, ids, held, codes, size = fresh()
        for batch in batches:
            shape = batch.column(0).type
            for i in range(batch.num_rows):
                data = (batch.column(2)[i].as_py() or "").encode("utf-8", "surrogatepass")
                words = data.lower().split()
                words.append(END)
                codes.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)).astype(np.int32))
                ids.append(batch.column(0)[i].as_py())
                held.append(batch.column(1)[i].as_py())
                size += len(data)
                if size >= CHUNK:
                    yield from rows_of(first + chunk, index, ids, held, codes)
                    chunk += 1
                    index, ids, held, codes, size = fresh()
        if ids:
            yield from rows_of(first + chunk, index, ids, held, codes)

    return rows.mapInArrow(run, schema)


class Layout:
    """Sequences side by side, longest first, their tokens ordered by time."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        #: How many sequences have a token at each time.
        self.active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        self.start = np.concatenate([[0], np.cumsum(self.active)])
        self.tokens = np.empty(self.start[-1], np.int64)
        for i, k in enumerate(self.order):
            self.tokens[self.start[: lengths[i]] + i] = sequences[k]


def forward(model, layout: Layout, keep: bool = False):
    """log likelihood of each sequence (natural), in the layout's order; and the scaled forward values."""
    initial, moves, emits = model
    n, states = len(layout.order), len(initial)
    logs = np.zeros(n)
    kept = np.empty((len(layout.tokens), states), np.float32) if keep else None
    alpha = np.broadcast_to(initial, (n, states))
    for t, m in enumerate(layout.active):
        at = layout.start[t]
        alpha = (alpha[:m] if t == 0 else alpha[:m] @ moves) * emits[layout.tokens[at : at + m]]
        scale = alpha.sum(axis=1)
        alpha = alpha / scale[:, None]
        logs[:m] += np.log(scale)
        if keep:
            kept[at : at + m] = alpha
    return logs, kept


def expected(model, layout: Layout):
    """Baum-Welch: expected initial, transition and emission counts of the sequences."""
    initial, moves, emits = model
    _, gamma = forward(model, layout, keep=True)
    n, states = len(layout.order), len(initial)
    went = np.zeros((states, states))
    beta = np.ones((n, states))
    for t in range(len(layout.active) - 1, -1, -1):
        m, at = layout.active[t], layout.start[t]
        alpha = gamma[at : at + m].astype(np.float64)
        if t + 1 < len(layout.active):
            k, after = layout.active[t + 1], layout.start[t + 1]
            ahead = emits[layout.tokens[after : after + k]] * beta[:k]
            back = ahead @ moves.T
            scale = (alpha[:k] * back).sum(axis=1, keepdims=True)
            went += moves * (alpha[:k].T @ (ahead / scale))
            beta[:k] = back / scale
        both = alpha * beta[:m]
        gamma[at : at + m] = both / both.sum(axis=1, keepdims=True)
    first = gamma[:n].sum(axis=0, dtype=np.float64)
    classes = len(emits)
    sent = np.stack([np.bincount(layout.tokens, gamma[:, s], classes) for s in range(states)], axis=1)
    return first, went, sent


def mixture(sequences: list[np.ndarray], classes: int, states: int, rounds: int, seed: int) -> np.ndarray:
    """Class counts per state, (classes, states): documents clustered by their class counts."""
    rng = np.random.default_rng(seed)
    who, what, many = [], [], []
    for i, s in enumerate(sequences):
        value, n = np.unique(s, return_counts=True)
        who.append(np.full(len(value), i))
        what.append(value)
        many.append(n)
    who, what, many = (np.concatenate(x) for x in (who, what, many))
    n = len(sequences)
    sums = np.bincount(what, many, classes)
    backing = (sums + 0.01) / (sums.sum() + 0.01 * classes)
    # Centres one after the other: each the document that the ones before explain worst, of some drawn.
    best = np.full(n, -np.inf)
    lengths = np.bincount(who, many, n)
    resp = np.zeros((n, states))
    centre = int(rng.integers(n))
    for s in range(states):
        mine = who == centre
        own = np.bincount(what[mine], many[mine], classes)
        p = 0.5 * backing + 0.5 * own / max(own.sum(), 1)
        best = np.maximum(best, np.bincount(who, many * np.log(p[what] / backing[what]), n) / np.sqrt(lengths))
        resp[:, s] = np.bincount(who, many * np.log(p[what]), n)
        drawn = rng.choice(n, min(n, 200), replace=False)
        centre = int(drawn[np.argmin(best[drawn] / np.sqrt(lengths[drawn]))])
    for _ in range(rounds):
        resp = np.exp(resp - resp.max(axis=1, keepdims=True))
        resp /= resp.sum(axis=1, keepdims=True)
        weight = resp.mean(axis=0) + 1e-6
        table = np.stack([np.bincount(what, many * resp[who, s], classes) for s in range(states)], axis=1)
        p = (table + backing[:, None]) / (table.sum(axis=0) + 1)
        logs = np.log(p)[what] * many[:, None]
        resp = np.stack([np.bincount(who, logs[:, s], n) for s in range(states)], axis=1) + np.log(weight)
    return table


def normalised(first: np.ndarray, went: np.ndarray, sent: np.ndarray, pull: np.ndarray, mass: float):
    """Counts to probabilities; ``pull`` is the overall share of each class, with ``mass`` counts a state."""
    initial = (first + 0.1) / (first + 0.1).sum()
    moves = (went + 0.1) / (went + 0.1).sum(axis=1, keepdims=True)
    emits = (sent + mass * pull[:, None]) / (sent.sum(axis=0) + mass)
    return initial, moves, emits


def grouped(batches: Iterator[pa.RecordBatch], column: int):
    """(batch, rows, sequences) in pieces of about ``TOKENS`` tokens."""
    for batch in batches:
        rows, held, size = [], [], 0
        for i in range(batch.num_rows):
            rows.append(i)
            held.append(unpack(batch.column(column)[i].as_py()))
            size += len(held[-1])
            if size >= TOKENS:
                yield batch, rows, held
                rows, held, size = [], [], 0
        if rows:
            yield batch, rows, held


def train(sequences: DataFrame, shares: np.ndarray, states: int, passes: int, sample: int, seed: int):
    """The model from training sequences (column ``classes``), ``shares`` being each class's share of tokens.

    The start comes from clustering ``sample`` documents, drawn by hash; each of
    the ``passes`` goes over all of ``sequences``.
    """
    classes = len(shares)
    shape = "class int, " + ", ".join(f"s{i} double" for i in range(states))

    def rows_of(at: np.ndarray, values: np.ndarray):
        return pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), *(pa.array(np.ascontiguousarray(values[:, s])) for s in range(states))],
            ["class", *(f"s{i}" for i in range(states))],
        )

    def start(batches):
        held = [unpack(b) for b in sorted(b for batch in batches for b in batch.column(0).to_pylist())]
        if held:
            yield rows_of(np.arange(classes), mixture(held, classes, states, 12, seed))

    drawn = least_hashed(sequences.select("doc_id", "classes"), sample, "doc_id", "classes", seed=seed)
    table = np.zeros((classes, states))
    for row in drawn.select("classes").repartition(1).mapInArrow(start, shape).toLocalIterator():
        table[row[0]] = row[1:]
    stay = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(stay, 0.9)
    model = normalised(np.ones(states), 1000 * stay, table, shares, 100.0)

    for _ in range(passes):
        initial, moves, emits = model

        def step(batches, model=(initial, moves, emits)):
            first, went, sent = np.zeros(states), np.zeros((states, states)), np.zeros((classes, states))
            for _, _, held in grouped(batches, 0):
                a, b, c = expected(model, Layout(held))
                first += a
                went += b
                sent += c
            at = np.flatnonzero(sent.any(axis=1))
            # Below zero: the initial counts, then a row of transitions for each state.
            yield rows_of(
                np.concatenate([-1 - np.arange(states + 1), at]), np.concatenate([first[None, :], went, sent[at]])
            )

        sums = sequences.select("classes").mapInArrow(step, shape).groupBy("class").agg(
            *(F.sum(f"s{i}").alias(f"s{i}") for i in range(states))
        )
        first, went, sent = np.zeros(states), np.zeros((states, states)), np.zeros((classes, states))
        for row in sums.collect():  # at most HEADS + SHAPES + states + 2 rows
            if row[0] >= 0:
                sent[row[0]] = row[1:]
            elif row[0] == -1:
                first[:] = row[1:]
            else:
                went[-2 - row[0]] = row[1:]
        model = normalised(first, went, sent, shares, 10.0)
    return model


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    held_part: int = 2,
    held_of: int = 7,
    states: int = 8,
    passes: int = 2,
    sample: int = 2000,
    seed: int = 1,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of ``docs``.

    Learns from rows whose crc32(identifier as text) mod ``held_of`` is not
    ``held_part`` (a null identifier counts as empty text). ``score`` is the log10
    probability of the text's words, lower-cased A-Z, and one end token;
    ``base_score`` that of add-one unigrams. Null and empty texts have the end
    token alone. Repeated rows each count and each get a row. Without training
    rows all tokens are unknown. An empty table gives no rows; other columns
    are not read.
    """
    rows = stored(coded(docs, id_col, text_col, held_part, held_of), "lm-codes")
    words = rows.where("words IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("words", "counts")))
    words = words.select("chunk", F.col("pos").alias("code"), F.col("col.words").alias("word"), F.col("col.counts").alias("n"))
    known = words.where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))
    known = stored(known, "lm-counts")

    total, distinct = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least = max(1, -(-total // HEADS))
    heads = known.where((F.col("n") >= least) | (F.col("word") == F.lit(bytearray(END))))
    heads = sorted((bytes(r[0]), r[1]) for r in heads.collect())  # at most HEADS words and the end
    if not heads or heads[0][0] != END:
        heads.insert(0, (END, 0))
    spark = docs.sparkSession
    head = spark.createDataFrame(
        [(bytearray(w), i) for i, (w, _) in enumerate(heads)], "head binary, class int"
    )
    shape = F.pmod(F.xxhash64(F.substring("word", -3, 3)), F.lit(SHAPES)).cast("int") + len(heads)
    tail = known.join(head, F.col("word") == F.col("head"), "left_anti").withColumn("class", shape)
    sizes = {r[0]: (r[1], r[2]) for r in tail.groupBy("class").agg(F.sum("n"), F.count(F.lit(1))).collect()}
    classes = len(heads) + SHAPES
    tokens, kinds = np.zeros(classes), np.zeros(classes)
    for c, (n, v) in sizes.items():
        tokens[c], kinds[c] = n, v
    shares = tokens.copy()
    shares[: len(heads)] = [n for _, n in heads]
    shares = (shares + 0.1) / (shares + 0.1).sum()

    # Each chunk's dictionary gets counts and classes; a head's class comes by a second, small join.
    counted = words.join(known.withColumnRenamed("n", "c"), "word", "left").select(
        "chunk", "code", "word", F.coalesce("c", F.lit(0)).alias("c")
    )
    looked = counted.join(head, F.col("word") == F.col("head"), "left").select(
        F.col("chunk").alias("of"), "code", "c", F.coalesce("class", shape).alias("class")
    )
    given = rows.where("codes IS NOT NULL").select("chunk", "doc_id", "held_out", "codes")
    kind = rows.schema["doc_id"].dataType.simpleString()
    denominator = math.log10(total + distinct + 1)
    n_heads = len(heads)

    def sequence(left: pa.Table, right: pa.Table) -> pa.Table:
        code = right.column("code").to_numpy()
        c = np.zeros(len(code), np.int64)
        c[code] = right.column("c").to_numpy()
        cls = np.zeros(len(code), np.int64)
        cls[code] = right.column("class").to_numpy()
        base = np.log10(c + 1.0) - denominator
        inner = np.where(cls < n_heads, 0.0, np.log10(c + 1.0) - np.log10(tokens[cls] + kinds[cls] + 1.0))
        out = []
        for blob in left.column("codes").to_pylist():
            own = unpack(blob)
            out.append((pack(cls[own]), len(own), int((c[own] > 0).sum()), base[own].sum(), inner[own].sum()))
        parts = list(zip(*out))
        return pa.table(
            [
                left.column("doc_id"),
                left.column("held_out"),
                pa.array(parts[0], pa.binary()),
                pa.array(parts[1], pa.int64()),
                pa.array(parts[2], pa.int64()),
                pa.array(parts[3], pa.float64()),
                pa.array(parts[4], pa.float64()),
            ],
            ["doc_id", "held_out", "classes", "n_tokens", "n_known", "base_score", "inner"],
        )

    sequences = given.groupBy("chunk").cogroup(looked.groupBy("of")).applyInArrow(
        sequence,
        f"doc_id {kind}, held_out boolean, classes binary, n_tokens bigint, n_known bigint, base_score double, inner double",
    )
    sequences = stored(sequences, "lm-classes")
    model = train(sequences.where("NOT held_out"), shares, states, passes, sample, seed)

    def likelihood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, at, held in grouped(batches, 5):
            layout = Layout(held)
            logs, _ = forward(model, layout)
            values = np.empty(len(at))
            values[layout.order] = logs / math.log(10)
            taken = batch.take(pa.array(at))
            inner = taken.column(6).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*taken.columns[:5], pa.array(values + inner)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    scored = sequences.select("doc_id", "held_out", "n_tokens", "n_known", "base_score", "classes", "inner").mapInArrow(
        likelihood, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
