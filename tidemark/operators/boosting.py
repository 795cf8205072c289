"""Boosted regression trees over all series at once.

Every series is divided by its own level, so that one set of trees serves all.
Inputs are cut into quantile bins once. A level of a tree is one aggregation:
the sum of what is still unexplained, and the number of rows, for each (node,
input, bin). The driver sees that table only (nodes x inputs x bins rows,
whatever the number of training rows) and picks each node's best cut.

What is unexplained is summed as whole millionths, so sums are exact, and the
trees do not depend on how the rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = 1_000_000


@dataclass(frozen=True)
class Tree:
    """A full binary tree: node i has the children 2i + 1 and 2i + 2; rows above the cut go right.

    A node without a useful cut has input -1; its rows all go left.
    """

    inputs: tuple[int, ...]
    cuts: tuple[int, ...]  # the highest bin that goes left
    leaves: tuple[float, ...]


@dataclass(frozen=True)
class Forest:
    names: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]  # of the bins of each input: bin b lies above edges[b - 1]
    base: float
    trees: tuple[Tree, ...]
    gains: dict[str, float] = field(default_factory=dict)  # what each input's cuts explained


def quantile_edges(
    rows: DataFrame, inputs: Sequence[Column], answer: Column, bins: int, accuracy: int = 10_000
) -> tuple[list[tuple[float, ...]], float | None]:
    """Distinct inner quantiles of each input, and the mean answer, in one pass of bounded memory."""
    at = [i / bins for i in range(1, bins)]
    found = rows.agg(
        F.round(F.avg(answer), 6).alias("base"),
        *(F.percentile_approx(x, at, accuracy).alias(f"q{i}") for i, x in enumerate(inputs)),
        *(F.max(x).alias(f"m{i}") for i, x in enumerate(inputs)),
    ).first()
    # Nothing lies above the greatest value, so a cut there is none.
    edges = [
        tuple(sorted({e for e in (found[f"q{i}"] or ()) if e < found[f"m{i}"]})) for i in range(len(inputs))
    ]
    return edges, found.base


def bin_of(x: Column, edges: Sequence[float]) -> Column:
    return reduce(add, ((x > F.lit(e)).cast("int") for e in edges), F.lit(0))


def _walk(test: Callable[[int, int], Column], tree: Tree, node: int, end: Callable[[int], Column]) -> Column:
    """``end`` of the leaf that a row reaches. ``test(input, cut)``: whether it lies above the cut."""
    inner = len(tree.inputs)
    if node >= inner:
        return end(node - inner)
    left = _walk(test, tree, 2 * node + 1, end)
    if tree.inputs[node] < 0:
        return left
    right = _walk(test, tree, 2 * node + 2, end)
    return F.when(test(tree.inputs[node], tree.cuts[node]), right).otherwise(left)


def _cases(tree: Tree, node: int, end: Callable[[int], str]) -> str:
    """``_walk`` over the bins ``b0``, ``b1``, ... as SQL: one text is built much faster than its many columns."""
    inner = len(tree.inputs)
    if node >= inner:
        return end(node - inner)
    left = _cases(tree, 2 * node + 1, end)
    if tree.inputs[node] < 0:
        return left
    right = _cases(tree, 2 * node + 2, end)
    return f"CASE WHEN b{tree.inputs[node]} > {tree.cuts[node]} THEN {right} ELSE {left} END"


def value(forest: Forest, inputs: Sequence[Column]) -> Column:
    """The forest's answer from raw inputs."""

    def test(i: int, cut: int) -> Column:
        return inputs[i] > F.lit(forest.edges[i][cut])

    parts = (_walk(test, t, 0, lambda leaf, t=t: F.lit(t.leaves[leaf])) for t in forest.trees)
    return reduce(add, parts, F.lit(forest.base))


def best_cuts(histogram: dict[tuple[int, int, int], tuple[int, int]], nodes: int, penalty: float) -> list[tuple]:
    """For each node (input, cut, gain), or (-1, 0, 0.0): the greatest gain, then the lowest input and cut.

    ``histogram``: (node, input, bin) -> (rows, sum in units).
    """
    by_node: dict[tuple[int, int], dict[int, tuple[int, int]]] = {}
    for (node, i, b), cell in histogram.items():
        by_node.setdefault((node, i), {})[b] = cell
    out: list[tuple] = [(-1, 0, 0.0)] * nodes
    for (node, i), cells in sorted(by_node.items()):
        n, total = (sum(c[k] for c in cells.values()) for k in (0, 1))
        whole = total * total / (n + penalty)
        left_n = left = 0
        for b in sorted(cells)[:-1]:
            left_n, left = left_n + cells[b][0], left + cells[b][1]
            right_n, right = n - left_n, total - left
            gain = left * left / (left_n + penalty) + right * right / (right_n + penalty) - whole
            gain /= UNIT * UNIT
            if gain > out[node][2] + 1e-9:
                out[node] = (i, b, gain)
    return out


def train_together(
    parts: Sequence[DataFrame], names: Sequence[str], target: str, keep: Callable[[DataFrame], DataFrame], **how
) -> list[Forest]:
    """The forest of each table. Their jobs run side by side, for a level's job on few rows is mostly its start."""
    # Each thread has a copy of this one's local properties.
    threads = [inheritable_thread_target(part.sparkSession)(train) for part in parts]
    with ThreadPoolExecutor(len(parts)) as pool:
        growing = [pool.submit(run, part, names, target, keep, **how) for run, part in zip(threads, parts)]
    return [forest.result() for forest in growing]


def train(
    rows: DataFrame,
    names: Sequence[str],
    target: str,
    keep: Callable[[DataFrame], DataFrame],
    *,
    trees: int = 15,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 32,
    penalty: float = 10.0,
    settle: int = 5,
    otherwise: float = 0.0,
) -> Forest:
    """Trees that explain ``target`` by the columns ``names``; nulls count as 0.

    ``keep`` writes a frame to shared storage and returns a reader of it. The
    binned rows are written once, and the sums explained so far again every
    ``settle`` trees, so plans stay short. An empty table gives a forest that
    answers ``otherwise``.
    """
    raw = [F.coalesce(F.col(f"`{n}`").cast("double"), F.lit(0.0)) for n in names]
    answer = F.coalesce(F.col(target).cast("double"), F.lit(0.0))
    edges, base = quantile_edges(rows, raw, answer, bins)
    base = otherwise if base is None else base
    unit = lambda x: F.round(x * UNIT).cast("bigint")
    binned = keep(rows.select(
        *(bin_of(x, e).cast("tinyint" if bins <= 128 else "int").alias(f"b{i}") for i, (x, e) in enumerate(zip(raw, edges))),
        unit(answer - F.lit(base)).alias("rest"),
    ))
    every_cell = F.explode(F.array(*(
        F.struct(F.lit(i).alias("input"), F.col(f"b{i}").cast("int").alias("bin")) for i in range(len(names))
    )))
    grown: list[Tree] = []
    gains = dict.fromkeys(names, 0.0)
    for count in range(1, trees + 1):
        tree = Tree((), (), ())
        for level in range(depth):
            at = F.expr(_cases(tree, 0, str))
            sums = binned.select(at.alias("node"), every_cell.alias("cell"), "rest")
            sums = sums.groupBy("node", "cell.input", "cell.bin").agg(F.count("*").alias("n"), F.sum("rest").alias("s"))
            histogram = {(r.node, r.input, r.bin): (r.n, r.s) for r in sums.collect()}
            cuts = best_cuts(histogram, 1 << level, penalty)
            tree = Tree(tree.inputs + tuple(c[0] for c in cuts), tree.cuts + tuple(c[1] for c in cuts), ())
            for i, _, gain in cuts:
                if i >= 0:
                    gains[names[i]] += gain
        # The last histogram has the sums on both sides of its cuts.
        leaves = []
        for node, (i, cut, _) in enumerate(cuts):
            cells = [(b, *cell) for (of, k, b), cell in histogram.items() if of == node and k == max(i, 0)]
            for side in (True, False):
                mine = [(n, s) for b, n, s in cells if (i < 0 or b <= cut) == side]
                n, s = sum(n for n, _ in mine), sum(s for _, s in mine)
                leaves.append(rate * s / UNIT / (n + penalty) if n else 0.0)
        tree = Tree(tree.inputs, tree.cuts, tuple(leaves))
        grown.append(tree)
        answered = _cases(tree, 0, lambda leaf: f"CAST(round({tree.leaves[leaf]!r}D * {UNIT}) AS BIGINT)")  # noqa: B023
        binned = binned.withColumn("rest", F.col("rest") - F.expr(answered))
        if count % settle == 0 and count < trees:
            binned = keep(binned)
    return Forest(tuple(names), tuple(edges), float(base), tuple(grown), gains)
