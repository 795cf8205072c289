"""Short codes for vectors: a product quantiser fitted exactly over Hilbert-sorted blocks.

Components become integers, floor(scale * x), and a vector is cut into ``parts``
equal consecutive pieces. All pieces of one part position are sorted along a
Hilbert curve, so that neighbours in the order are neighbours in space, and the
order is cut into flat blocks. A block keeps its pieces beside their number,
their componentwise sum, and the corners (least and greatest component) of the
box around them.

A round has to find the nearest codebook entry of every piece. For a block, an
entry whose least distance to the box exceeds the greatest distance of some
other entry is nearest to none of its pieces; what is left is the block's
shortlist. If that is one entry, the whole block goes to it by its stored sum,
without a look at its pieces. Otherwise a kernel over integers compares the
pieces with the shortlist alone. All of it is exact: the shortlist keeps entries
that tie, sums are decimals, and magnitudes that could pass 64 bits are reckoned
with Python's integers.

Only sums per (part, entry, component) leave a round's tasks; the driver gets
as many rows as the codebooks have components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, col, settled, stored

by_value(__name__)

#: Pieces in a block.
BLOCK = 256
#: Integers beyond this are reckoned with Python's, whose squares and sums have no end.
SAFE = 1 << 26


@dataclass(frozen=True)
class Codebooks:
    """``entries[part][entry]`` is a piece of integers."""

    scale: int
    dimension: int  # of the vectors
    entries: tuple[tuple[tuple[int, ...], ...], ...]

    @property
    def parts(self) -> int:
        return len(self.entries)

    def sha256(self) -> str:
        """Of all components as decimal text, by part, entry and position, with commas between."""
        every = (x for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(map(str, every)).encode()).hexdigest()


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exactly: int64 where the result is small, else Python integers."""
    scaled = values.astype(np.float64) * scale
    if scale & (scale - 1) == 0 and np.abs(scaled).max(initial=0.0) < SAFE:  # a power of two scales exactly
        return np.floor(scaled).astype(np.int64)
    exact = [_floor(float(x), scale) for x in values.reshape(-1)]
    out = np.empty(len(exact), object)
    out[:] = exact
    out = out.reshape(values.shape)
    return out.astype(np.int64) if all(abs(x) < SAFE for x in exact) else out


def _floor(x: float, scale: int) -> int:
    top, bottom = x.as_integer_ratio()
    return top * scale // bottom


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points with coordinates below 2**bits, a row each.

    The gray-code walk from the highest bit to the lowest: at each bit the
    axes seen so far are exchanged or turned round, so that the cell entered
    is crossed in the direction in which the curve arrives.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = np.int64((1 << b) - 1)
        for i in range(n):
            on = (x[i] >> b) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        turn = np.where((x[n - 1] >> b) & 1 == 1, turn ^ np.int64((1 << b) - 1), turn)
    x ^= turn
    place = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << 1 | (x[i] >> b) & 1
    return place


def curve_keys(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hilbert places of real points within the corners given; 63 bits at most, leading axes first."""
    axes = min(points.shape[1], 63)
    bits = min(63 // axes, 16)
    width = np.where(high > low, high - low, 1.0)[:axes]
    cells = np.floor((points[:, :axes] - low[:axes]) / width * (1 << bits))
    return hilbert(np.clip(cells, 0, (1 << bits) - 1).astype(np.int64), bits)


def valid(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None, parts: int) -> DataFrame:
    """(row, vec_id, label, vector) of the rows that are coded, with a number of its own for each.

    Rows go whose vector is null or empty, holds a null or a component that is
    not finite, or has another length than that of the first vector (by
    identifier, nulls last, then by components). Written once, so that the
    numbers stay what they are when tasks run again.
    """
    label = F.lit(None).cast("int") if label_col is None else col(label_col)
    rows = vectors.select(
        col(id_col).alias("vec_id"), label.alias("label"), col(vector_col).cast("array<double>").alias("vector")
    )
    rows = rows.where(valid(F.col("vector")) & (F.size("vector") > 0))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vector-rows")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(F.size("vector")).limit(1).first()
    if first is not None and first[0] % parts:
        raise ValueError(f"vectors of {first[0]} components have no {parts} equal parts")
    return rows.where(F.size("vector") == (first[0] if first else 0))


def _first_books(rows: DataFrame, scale: int, parts: int, entries: int) -> Codebooks:
    """The pieces of the least identifiers (nulls last, then by components)."""
    chosen = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not chosen:
        return Codebooks(scale, 0, tuple(() for _ in range(parts)))
    whole = integers(np.array([r.vector for r in chosen]), scale)
    cut = np.split(whole, parts, axis=1)
    books = tuple(tuple(tuple(int(x) for x in entry) for entry in part) for part in cut)
    return Codebooks(scale, whole.shape[1], books)


def blocks(rows: DataFrame, dimension: int, parts: int, scale: int, size: int = BLOCK) -> DataFrame:
    """Blocks of the vectors' pieces: part, members (row numbers), n, pieces, and sums and corners.

    Ranges are cut by (part, place, row), so copies of one vector, however
    many, are dealt over as many tasks as other rows. Numbers are text where
    they may be too large for 64 bits, which is the caller's affair alone.
    """
    width = dimension // parts
    ends = rows.select(
        *(F.min(F.col("vector")[i]).alias(f"lo{i}") for i in range(dimension)),
        *(F.max(F.col("vector")[i]).alias(f"hi{i}") for i in range(dimension)),
    ).first()
    low, high = np.array(ends[:dimension], np.float64), np.array(ends[dimension:], np.float64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0)
            whole = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            for p in range(parts):
                axes = slice(p * width, (p + 1) * width)
                piece = np.ascontiguousarray(whole[:, axes])
                place = curve_keys(piece, low[axes], high[axes])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(piece), p, np.int32)),
                        pa.array(place),
                        numbers,
                        pa.array([v.tobytes() for v in piece], pa.binary()),
                    ],
                    ["part", "place", "row", "piece"],
                )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        at = -1
        for batch in batches:
            part = batch.column(0).to_numpy()
            for p, number, piece in zip(part.tolist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if held and (p != at or len(held) == size):
                    yield _block(at, held, scale, width)
                    held = []
                at = p
                held.append((number, piece))
        if held:
            yield _block(at, held, scale, width)

    pieces = rows.select("row", "vector").mapInArrow(cut, "part int, place bigint, row bigint, piece binary")
    pieces = pieces.repartitionByRange("part", "place", "row").sortWithinPartitions("part", "place", "row")
    shape = "part int, members array<bigint>, n bigint, large boolean, pieces binary, sums binary, low binary, high binary"
    return stored(pieces.mapInArrow(gather, shape), "vector-blocks")


def _block(part: int, held: list[tuple[int, bytes]], scale: int, width: int) -> pa.RecordBatch:
    reals = np.frombuffer(b"".join(piece for _, piece in held), np.float64).reshape(-1, width)
    points = integers(reals, scale)
    large = points.dtype == object
    made = [points, points.sum(axis=0), points.min(axis=0), points.max(axis=0)]
    names = ["part", "members", "n", "large", "pieces", "sums", "low", "high"]
    values = [
        pa.array([part], pa.int32()),
        pa.array([[number for number, _ in held]], pa.list_(pa.int64())),
        pa.array([len(held)], pa.int64()),
        pa.array([large], pa.bool_()),
        *(pa.array([_packed(x)], pa.binary()) for x in made),
    ]
    return pa.RecordBatch.from_arrays(values, names)


def _packed(x: np.ndarray) -> bytes:
    return " ".join(map(str, x.reshape(-1))).encode() if x.dtype == object else x.tobytes()


def _unpacked(data: bytes, large: bool, width: int) -> np.ndarray:
    if not large:
        return np.frombuffer(data, np.int64).reshape(-1, width)
    out = np.array([int(x) for x in data.split()], object)
    return out.reshape(-1, width)


def shortlist(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entries that may be nearest to a point of the box, in order."""
    under, over = low - book, book - high
    outside = np.maximum(np.maximum(under, over), 0)
    least = (outside * outside).sum(axis=1)
    across = np.maximum(np.abs(book - low), np.abs(book - high))
    most = (across * across).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def nearest(points: np.ndarray, book: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every point the nearest of the entries ``among`` (the lower of equals), and its squared distance."""
    best, entry = None, np.zeros(len(points), np.int64)
    for e in among:
        gap = points - book[e]
        far = (gap * gap).sum(axis=1)
        if best is None:
            best, entry[:] = far, e
            continue
        nearer = (far < best).astype(bool)
        best = np.where(nearer, far, best)
        entry[nearer] = e
    return entry, best


def _books(books: Codebooks) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each part's entries as int64, if they fit, and as Python integers."""
    out = []
    for part in books.entries:
        exact = np.array(part, object).reshape(len(part), -1)
        small = all(abs(x) < SAFE for x in exact.reshape(-1))
        out.append((exact.astype(np.int64) if small else exact, exact))
    return out


def _opened(batches: Iterator[pa.RecordBatch], books: Codebooks):
    """Block by block: its row, its part's entries in the fitting sort of integers, and its width."""
    ready = _books(books)
    width = books.dimension // books.parts
    for batch in batches:
        for row in batch.to_pylist():
            small, exact = ready[row["part"]]
            yield row, exact if row["large"] else small, width


def _counted(found: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after a round over the blocks."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[tuple[int, int], int] = {}
        total: dict[tuple[int, int], np.ndarray] = {}

        def add(part: int, entry: int, n: int, sums: np.ndarray) -> None:
            key = (part, entry)
            number[key] = number.get(key, 0) + n
            total[key] = total[key] + sums if key in total else sums

        for row, book, width in _opened(batches, books):
            low, high, sums = (_unpacked(row[c], row["large"], width)[0] for c in ("low", "high", "sums"))
            among = shortlist(low, high, book)
            if len(among) == 1:
                add(row["part"], int(among[0]), row["n"], sums.astype(object))
                continue
            points = _unpacked(row["pieces"], row["large"], width)
            entry, _ = nearest(points, book, among)
            for e in among:
                mine = points[entry == e]
                if len(mine):
                    add(row["part"], int(e), len(mine), mine.sum(axis=0).astype(object))
        keys = [(p, e, i) for p, e in total for i in range(len(total[p, e]))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _, _ in keys], pa.int32()),
                pa.array([e for _, e, _ in keys], pa.int32()),
                pa.array([i for _, _, i in keys], pa.int32()),
                pa.array([number[p, e] for p, e, _ in keys], pa.int64()),
                pa.array([str(total[p, e][i]) for p, e, i in keys], pa.string()),
            ],
            ["part", "entry", "axis", "n", "total"],
        )

    sums = found.mapInArrow(step, "part int, entry int, axis int, n bigint, total string")
    sums = sums.groupBy("part", "entry", "axis").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    new = [[list(entry) for entry in part] for part in books.entries]
    for r in sums.collect():  # one row per component of the codebooks at most
        new[r.part][r.entry][r.axis] = int(r.total) // r.n
    return Codebooks(books.scale, books.dimension, tuple(tuple(map(tuple, part)) for part in new))


def _assigned(found: DataFrame, books: Codebooks) -> DataFrame:
    """(row, part, entry, far): the nearest entry of every piece and its squared distance."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, book, width in _opened(batches, books):
            low, high = (_unpacked(row[c], row["large"], width)[0] for c in ("low", "high"))
            points = _unpacked(row["pieces"], row["large"], width)
            entry, far = nearest(points, book, shortlist(low, high, book))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["members"], pa.int64()),
                    pa.array(np.full(len(points), row["part"], np.int32)),
                    pa.array(entry),
                    pa.array([int(x) for x in far], pa.int64()),
                ],
                ["row", "part", "entry", "far"],
            )

    return found.mapInArrow(step, "row bigint, part int, entry bigint, far bigint")


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    *,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error) for each vector that is kept, and the codebooks.

    ``code`` has two hex digits a part, in order; ``error`` is the squared
    distance, in integers, between the vector and what its code stands for.
    See ``kept`` for vectors that are left out. Codebooks begin with the pieces
    of the ``entries`` least identifiers, null identifiers after all others and
    equal ones by their components; with fewer vectors there are fewer entries.
    Repeated rows are rows. An error beyond 64 bits (components beyond some
    100,000) is Spark's arithmetic error. Without vectors there are no rows,
    and the books are empty. ``parts`` is 8 at most and ``entries`` 256.
    """
    if not 1 <= parts <= 8 or not 1 <= entries <= 256:
        raise ValueError("parts: 1 to 8; entries: 1 to 256")
    rows = kept(vectors, id_col, vector_col, label_col, parts)
    books = _first_books(rows, scale, parts, entries)
    if not books.dimension:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), books
    found = blocks(rows, books.dimension, parts, scale)
    for _ in range(rounds):
        books = _counted(found, books)
    # A part's number is a byte of the code: parts meet by bit_or, in any order.
    byte = F.call_function("shiftleft", F.col("entry"), F.lit(8) * (F.lit(parts - 1) - F.col("part")))
    codes = _assigned(found, books).groupBy("row").agg(F.bit_or(byte).alias("bits"), F.sum("far").alias("error"))
    coded = rows.select("row", "vec_id", "label").join(codes, "row")
    text = F.lower(F.substring(F.lpad(F.hex("bits"), 16, "0"), 17 - 2 * parts, 2 * parts))
    return coded.select("vec_id", "label", text.alias("code"), "error"), books


def decode(codes: DataFrame, books: Codebooks, code_col: str = "code", name: str = "vector") -> DataFrame:
    """``codes`` with the vector (of doubles) that a code stands for; null where the code is null."""
    tables = F.array(*(
        F.array(*(F.array(*(F.lit(x / books.scale) for x in entry)) for entry in part)) for part in books.entries
    ))
    numbers = F.transform(
        F.sequence(F.lit(0), F.lit(books.parts - 1)),
        lambda p: F.conv(F.substring(col(code_col), p * 2 + 1, F.lit(2)), 16, 10).cast("int"),
    )
    pieces = F.transform(numbers, lambda e, p: F.element_at(F.element_at(tables, p + 1), e + 1))
    return codes.withColumn(name, F.when(col(code_col).isNotNull(), F.flatten(pieces)))


def report(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    **options,
) -> DataFrame:
    """vec_id, code, error, label_error (summed over a label, nulls together) and codebooks_sha256."""
    coded, books = compress(vectors, id_col, vector_col, label_col, **options)
    coded = settled(coded)
    labels = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    # A sum per label: the small side of the join, whichever label is frequent.
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
