"""Near duplicates by SimHash, found with tables of distances to reference fingerprints.

Two fingerprints that differ in at most ``bits`` bits have distances to any
reference that differ by at most ``bits``. Each fingerprint gets a row of
distances to two sorts of references:

* structured ones: zero, and for each pair of neighbouring bits the word with
  just these two bits set. d(x, 0) - d(x, pair) + 2 is twice the number of bits
  of x in the pair, so a differing bit moves one such coordinate only. Cut into
  ``groups`` groups of coordinates, at least ``groups - bits`` groups are equal
  throughout for every pair to be found. Every choice of that many groups is a
  join key: nothing is missed.
* scattered ones, fixed pseudo-random words. Among fingerprints with a common
  key, pairs whose distances to any of them differ by more than ``bits`` are
  discarded, and what is left is verified by its exact distance.

Fingerprints are made unique first, so copies of a text cost nothing. A key's
members are held by one task as numbers; a key with more than ``LARGE`` members
is cut again by the same pigeonhole on its unequal coordinates, so the work
stays small also where thousands of near copies share their keys. Only the
edges of a spanning forest leave a task, never all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, col, freed, own, settled, whole
from tidemark.llm.components import components

by_value(__name__)

#: Members of one key that are compared as a block.
LARGE = 4096
PAIRS = np.uint64(3) << np.arange(0, 64, 2, dtype=np.uint64)
STRUCTURED = np.concatenate([np.zeros(1, np.uint64), PAIRS])
SCATTERED = np.array(
    [xxhash.xxh64_intdigest(str(i), seed=7) for i in range(16)], dtype=np.uint64
)


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash over word shingles; 0 without words. Text of any length, null as empty."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    if len(parts) < words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(parts), seed=42)]
    else:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(words))))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(s, 42) for s in shingles]
    counts = np.zeros(64, np.int64)
    every = np.array(hashes, dtype="<u8")
    for at in range(0, len(every), 1 << 16):
        part = every[at : at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    on = np.packbits(2 * counts > len(every), bitorder="little")
    return int(on.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int = 3) -> DataFrame:
    """doc_id, mark (a hash of the text) and the fingerprint as a signed long, row by row."""
    rows = docs.select(
        col(id_col).alias("doc_id"),
        F.xxhash64(whole(col(text_col))).alias("mark"),
        col(text_col).cast("string").alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            texts = batch.column(2)
            prints = np.array([fingerprint(t.as_py(), words) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(prints.view(np.int64))], ["doc_id", "mark", "print"]
            )

    return rows.mapInArrow(run, f"doc_id {kind}, mark bigint, print bigint")


def distances(prints: np.ndarray, references: np.ndarray) -> np.ndarray:
    """The table of Hamming distances, a row per fingerprint."""
    return np.bitwise_count(prints[:, None] ^ references[None, :]).astype(np.int8)


def coordinates(prints: np.ndarray) -> np.ndarray:
    """0 to 2 for each pair of bits, from the distances to the structured references."""
    table = distances(prints, STRUCTURED)
    return (table[:, :1] - table[:, 1:] + 2) // 2


def keys(coords: np.ndarray, groups: int, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """For every choice of ``groups - bits`` groups of coordinates: its number, and a key per row."""
    parts = np.array_split(np.arange(coords.shape[1]), groups)
    codes = [coords[:, p].astype(np.int64) @ (3 ** np.arange(len(p), dtype=np.int64)) for p in parts]
    for number, chosen in enumerate(itertools.combinations(range(groups), max(groups - bits, 1))):
        key = np.zeros(len(coords), np.int64)
        for g in chosen:
            key = key * np.int64(3 ** len(parts[g])) + codes[g]
        yield number, key


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each of n members' components, under links a[i] - b[i]."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        differ = root[a] != root[b]
        a, b = a[differ], b[differ]
    return root


def verified(prints: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, bits: int):
    """Of the candidate pairs, those within ``bits``: first by the table, then exactly."""
    for r in range(table.shape[1]):
        near = np.abs(table[i, r] - table[j, r]) <= bits
        i, j = i[near], j[near]
    near = np.bitwise_count(prints[i] ^ prints[j]) <= bits
    return i[near], j[near]


def forest(prints: np.ndarray, bits: int, free: np.ndarray | None = None) -> np.ndarray:
    """The least member of each member's component, for the distinct members of one key.

    ``free``: the coordinates that may differ. Beyond ``LARGE`` members they are
    cut into 2 * bits + 2 groups, all but ``bits`` of which are equal for a pair.
    """
    n = len(prints)
    if free is None:
        free = np.arange(32)
    if n > LARGE and len(free) > 2 * bits + 2:
        a, b = [], []
        coords = coordinates(prints)[:, free]
        parts = np.array_split(np.arange(len(free)), 2 * bits + 2)
        codes = [coords[:, p].astype(np.int64) @ (3 ** np.arange(len(p), dtype=np.int64)) for p in parts]
        for chosen in itertools.combinations(range(len(parts)), len(parts) - bits):
            key = np.zeros(n, np.int64)
            for g in chosen:
                key = key * np.int64(3 ** len(parts[g])) + codes[g]
            rest = free[np.concatenate([p for g, p in enumerate(parts) if g not in chosen])]
            order = np.argsort(key, kind="stable")
            ends = np.flatnonzero(np.diff(key[order])) + 1
            for members in np.split(order, ends):
                if len(members) > 1:
                    found = forest(prints[members], bits, rest)
                    a.append(members)
                    b.append(members[found])
        return roots(n, np.concatenate([np.zeros(0, int), *a]), np.concatenate([np.zeros(0, int), *b]))
    table = distances(prints, SCATTERED)
    order = np.argsort(table[:, 0], kind="stable")
    first = table[order, 0].astype(np.int64)
    a, b = [], []
    for at in range(0, n, 256):
        stop = np.searchsorted(first, first[min(at + 255, n - 1)] + bits, side="right")
        here, there = np.arange(at, min(at + 256, n)), np.arange(at, stop)
        i, j = np.nonzero(here[:, None] < there[None, :])
        i, j = verified(prints, table, order[here[i]], order[there[j]], bits)
        a.append(i)
        b.append(j)
    return roots(n, np.concatenate([np.zeros(0, int), *a]), np.concatenate([np.zeros(0, int), *b]))


def linked(key: np.ndarray, prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a forest over the fingerprints of several keys; rows are sorted by key."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    sizes = np.diff(np.append(starts, len(key)))
    a, b = [np.zeros(0, int)], [np.zeros(0, int)]
    small = np.repeat((sizes > 1) & (sizes <= 64), sizes)
    at = np.flatnonzero(small)
    if len(at):
        table = np.zeros((len(key), len(SCATTERED)), np.int8)
        table[at] = distances(prints[at], SCATTERED)
        last = np.repeat(starts + sizes, sizes)
        for step in range(1, int(sizes[(sizes <= 64)].max(initial=1))):
            i = at[at + step < last[at]]
            if not len(i):
                break
            i, j = verified(prints, table, i, i + step, bits)
            a.append(i)
            b.append(j)
    for s, n in zip(starts[sizes > 64], sizes[sizes > 64]):
        a.append(np.arange(s, s + n))
        b.append(s + forest(prints[s : s + n], bits))
    values, place = np.unique(prints, return_inverse=True)
    root = roots(len(values), place[np.concatenate(a)], place[np.concatenate(b)])
    moved = root != np.arange(len(values))
    return values[moved], values[root[moved]]


def links(prints: DataFrame, bits: int = 3, groups: int = 6) -> DataFrame:
    """(a, b): edges that connect all distinct ``print`` values within ``bits`` of each other."""
    choices = len(list(itertools.combinations(range(groups), max(groups - bits, 1))))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            coords = coordinates(values.view(np.uint64))
            for number, key in keys(coords, groups, bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key * choices + number), pa.array(values)], ["key", "print"]
                )

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held_key = np.concatenate([held_key, batch.column(0).to_numpy(zero_copy_only=False)])
                held = np.concatenate([held, batch.column(1).to_numpy(zero_copy_only=False)])
                if len(held_key) < 200_000:
                    continue
                # The last key may go on in the next batch.
                cut = int(np.searchsorted(held_key, held_key[-1], side="left"))
            else:
                cut = len(held_key)
            if cut:
                a, b = linked(held_key[:cut], held[:cut].view(np.uint64), bits)
                held_key, held = held_key[cut:], held[cut:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
                )

    keyed = prints.select("print").mapInArrow(emit, "key bigint, print bigint")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(pair, "a bigint, b bigint")


def _labelled(docs: DataFrame, id_col: str, text_col: str, words: int, bits: int, groups: int):
    """Fingerprints by row, and (of, label) for each distinct one; both settled."""
    prints = settled(fingerprints(docs, id_col, text_col, words))
    unique = settled(prints.groupBy("print").agg(F.min("doc_id").alias("least")))
    labels = components(links(unique, bits, groups))
    named = unique.join(labels, F.col("print") == F.col("node"), "left").select(
        F.col("print").alias("of"), "least", F.coalesce("label", "print").alias("label")
    )
    return prints, settled(named)


def near(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    words: int = 3,
    bits: int = 3,
    groups: int = 6,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for each row of ``docs``.

    Fingerprints within ``bits`` bits are linked, and component_id is the
    smallest doc_id reachable (null if all ids there are null). Null and empty
    texts have fingerprint zero, which is linked like any other. Repeated rows
    are rows of one fingerprint. ``groups`` must be above ``bits``; more groups
    mean longer keys, in larger number, for larger corpora. An empty table
    gives no rows; other columns are not read.
    """
    prints, named = _labelled(docs, id_col, text_col, words, bits, groups)
    # A label is a fingerprint; the least id of all that bear it names the component.
    merged = named.groupBy("label").agg(F.min("least").alias("least_of_all"), F.count(F.lit(1)).alias("n"))
    merged = merged.where("n > 1").select(F.col("label").alias("by"), "least_of_all")
    named = named.join(merged, F.col("label") == F.col("by"), "left").select(
        "of", F.when(F.isnotnull("by"), F.col("least_of_all")).otherwise(F.col("least")).alias("component_id")
    )
    return prints.join(named, F.col("print") == F.col("of")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def survivors(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    words: int = 3,
    bits: int = 3,
    groups: int = 6,
) -> DataFrame:
    """One row of ``docs`` of each component: that with the smallest identifier.

    A null identifier comes last. Where rows share the smallest, one stays.
    """
    prints, named = _labelled(docs, id_col, text_col, words, bits, groups)
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "mark")).alias("first")
    # One row per fingerprint before the components come in: no key is hot in the join.
    firsts = prints.groupBy("print").agg(first).join(named, F.col("print") == F.col("of"))
    firsts = firsts.groupBy("label").agg(F.min("first").alias("first"))
    id_key, mark, wanted = own(docs, "id_key", "mark", "wanted")
    keyed = lambda c: F.xxhash64(c, F.isnull(c))
    firsts = firsts.select(
        keyed(F.col("first.doc_id")).alias(id_key),
        F.col("first.mark").alias(mark),
        F.col("first.doc_id").alias(wanted),
    ).distinct()
    found = docs.withColumns({id_key: keyed(col(id_col)), mark: F.xxhash64(whole(col(text_col)))})
    found = found.join(firsts, [id_key, mark]).where(col(id_col).eqNullSafe(F.col(wanted)))
    return found.dropDuplicates([id_key, mark]).select(*(col(c) for c in docs.columns))
