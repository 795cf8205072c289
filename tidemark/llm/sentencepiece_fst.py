"""SentencePiece encoding and decoding by weighted finite-state transduction.

The model file is compiled once, on the driver, into three transducers:

* N, the normaliser: blanks become U+2581, and one is put in front;
* P, from characters to pieces: a trie whose final states emit pieces, and for a
  character that is in no piece an arc that emits its UTF-8 byte pieces;
* G, over pieces. A unigram model weighs a piece with its negative score. A BPE
  model accepts a piece after another only if the two, encoded together, stay as
  they are, at weight 0, else infinity. A sequence of pieces is the BPE encoding
  of a text exactly if every neighbouring pair is accepted, since a merge across
  a boundary needs only the two pieces beside it; so the path of finite weight
  is unique and is the encoding.

Each input is composed with N, P and G, and the path of least weight is taken.
No piece holds a blank after another character, nor most rare characters beside
any other; the input is cut there, and the cuts (words, mostly) are independent.
The different words of a batch go through the composition together, as arrays:
all trie walks in step, then all shortest paths, boundary by boundary.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import by_value, col, mapped, own

by_value(__name__)

BLANK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NEVER = np.int64(1) << 40
#: Characters of text that are cut and of different words that are composed together; words remembered.
TEXT, COMPOSED, KNOWN = 500_000, 50_000, 150_000


class Table:
    """Long keys to values, looked up for whole arrays (open addressing)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        self.bits = max(4, int(len(keys) * 2).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, missing, np.int64)
        self.probes = 1
        slot, left = self.slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] < 0
            first = left[free]
            _, one = np.unique(slot[first], return_index=True)
            put = first[one]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            # Those that met a full slot go on; those that lost to another try theirs again.
            taken = self.keys[slot[left]] >= 0
            slot[left[taken]] = (slot[left[taken]] + 1) & (size - 1)
            self.probes += 1 if len(left) else 0
        self.missing = missing

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), self.missing, np.int64)
        slot, at = self.slot(keys), np.arange(len(keys))
        while len(at):
            seen = self.keys[slot]
            hit = seen == keys[at]
            out[at[hit]] = self.values[slot[hit]]
            on = ~hit & (seen >= 0)
            at, slot = at[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out


@dataclass
class Machine:
    """The compiled transducers. Symbols are pieces, then characters that occur only inside pieces."""

    pieces: list[bytes]  # what each id decodes to
    first_blank: bool  # N puts a blank in front
    squeeze: bool  # N drops extra blanks
    bpe: bool
    unknown: int
    byte_ids: list[int] | None
    names: list[str]  # symbols
    rank: np.ndarray  # of BPE merges: the lower, the earlier
    score: np.ndarray  # weights of a unigram model
    alphabet: np.ndarray  # code point -> letter of the trie, -1 if it stands alone
    single: dict[str, int]  # characters that stand alone and are pieces
    pattern: str  # cuts normalised text into words
    trie: Table  # (node, letter) -> node
    final: np.ndarray  # node -> symbol, or -1
    merges: Table  # (left, right) -> rank of the merged piece
    left: np.ndarray
    right: np.ndarray
    made: np.ndarray  # rank at which a symbol comes to be; -1 for characters
    uneven: np.ndarray  # symbols whose merges are not in the order of ranks
    judged: dict[tuple[int, int], bool] = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"judged": {}}


def merged(chars: list[str], rank: dict[str, int]) -> tuple[list[str], list[tuple[str, str, int]]]:
    """BPE of characters, the reference for G: the lowest rank first, the leftmost among equals."""
    parts, done = list(chars), []
    while True:
        best = min(((rank.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(NEVER, 0))
        if best[0] == NEVER:
            return parts, done
        i = best[1]
        done.append((parts[i], parts[i + 1], best[0]))
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def compile_model(path: str = MODEL) -> Machine:
    """Reads a model file of type BPE or unigram with the identity normaliser."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    if model.normalizer_spec.precompiled_charsmap:
        raise ValueError(f"{path}: only the identity normaliser is supported")
    bpe = model.trainer_spec.model_type == 2
    if not bpe and model.trainer_spec.model_type != 1:
        raise ValueError(f"{path}: neither BPE nor unigram")
    kinds = [p.type for p in model.pieces]
    if 4 in kinds:
        raise ValueError(f"{path}: user-defined pieces are not supported")
    normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
    byte_ids, decoded = None, []
    for i, p in enumerate(model.pieces):
        if p.type == 6:
            byte_ids = byte_ids or [model.trainer_spec.unk_id] * 256
            byte_ids[int(p.piece[3:5], 16)] = i
            decoded.append(bytes([int(p.piece[3:5], 16)]))
        elif p.type == 3:
            decoded.append(b"")
        elif p.type == 2:
            decoded.append(" ⁇ ".encode())
        else:
            decoded.append(p.piece.replace(BLANK, " ").encode())
    if any(BLANK in p.lstrip(BLANK) for p in normal):
        raise ValueError(f"{path}: a piece holds a blank after another character")

    score = {p: model.pieces[i].score for p, i in normal.items()}
    order = {p: r for r, p in enumerate(sorted(normal, key=lambda p: (-score[p], normal[p])))}
    letters = sorted({c for p in normal if len(p) > 1 for c in p} | {BLANK})
    names = [p.piece for p in model.pieces]
    symbol = dict(normal)
    for c in letters:
        if c not in symbol:
            symbol[c] = len(names)
            names.append(c)
    n = len(names)
    rank, scores = np.full(n, NEVER), np.full(n, np.inf)
    left, right = np.full(n, -1), np.full(n, -1)
    made, uneven = np.full(n, -1), np.zeros(n, bool)
    nodes: dict[tuple[int, int], int] = {}
    final = [-1]
    letter = {c: i for i, c in enumerate(letters)}
    lowest = min(score.values(), default=0.0)
    keys, ranks = [], []
    for p in sorted(symbol, key=len):
        s = symbol[p]
        scores[s] = -score[p] if p in score else 10.0 - lowest
        if any(c not in letter for c in p):
            continue
        if bpe and len(p) > 1:
            rank[s] = order[p]
            for i in range(1, len(p)):
                if p[:i] in symbol and p[i:] in symbol:
                    keys.append(symbol[p[:i]] << 24 | symbol[p[i:]])
                    ranks.append(order[p])
            whole, steps = merged(list(p), order)
            if len(whole) > 1:
                continue  # never the encoding of anything
            a, b = symbol[steps[-1][0]], symbol[steps[-1][1]]
            left[s], right[s] = a, b
            made[s] = order[p]
            uneven[s] = uneven[a] or uneven[b] or max(made[a], made[b]) > made[s]
        node = 0
        for c in p:
            at = (node, letter[c])
            if at not in nodes:
                nodes[at] = len(final)
                final.append(-1)
            node = nodes[at]
        final[node] = s
    alphabet = np.full(0x110000, -1, np.int32)
    for c, i in letter.items():
        alphabet[ord(c)] = i
    inside = "".join(re.escape(c) for c in letters if c != BLANK)
    if inside:
        pattern = f"{BLANK}*[{inside}]+|{BLANK}+|[^{BLANK}{inside}]"
    else:
        pattern = f"{BLANK}+|[^{BLANK}]"
    trie = Table(
        np.array([a << 24 | b for a, b in nodes], np.int64), np.array(list(nodes.values()), np.int64), -1
    )
    spec = model.normalizer_spec
    return Machine(
        pieces=decoded, first_blank=spec.add_dummy_prefix, squeeze=spec.remove_extra_whitespaces, bpe=bpe,
        unknown=model.trainer_spec.unk_id, byte_ids=byte_ids, names=names, rank=rank, score=scores,
        alphabet=alphabet, single={p: i for p, i in normal.items() if len(p) == 1 and p not in letter},
        pattern=pattern, trie=trie, final=np.array(final), left=left, right=right, made=made, uneven=uneven,
        merges=Table(np.array(keys, np.int64), np.array(ranks, np.int64), int(NEVER)),
    )


def normalise(machine: Machine, text: str) -> str:
    """N: the text with its blanks escaped."""
    if machine.squeeze:
        text = re.sub(" +", " ", text.strip(" "))
    if not text:
        return ""
    return ((" " if machine.first_blank else "") + text).replace(" ", BLANK)


def accepted(machine: Machine, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """G for BPE: whether piece b may follow piece a.

    The merges that made the two are undone, the latest first, and at each
    moment the pair that then met at the boundary is looked up: had it a lower
    rank than the merges that took its two parts away, it would have won. Pieces
    made by merges out of order are encoded together instead.
    """
    ok = np.ones(len(a), bool)
    odd = machine.uneven[a] | machine.uneven[b]
    for i in np.flatnonzero(odd):
        pair = (int(a[i]), int(b[i]))
        known = machine.judged.get(pair)
        if known is None:
            order = machine.__dict__.setdefault("_order", None)
            if order is None:
                order = {machine.names[s]: int(r) for s, r in enumerate(machine.rank) if r < NEVER}
                machine._order = order
            x, y = machine.names[pair[0]], machine.names[pair[1]]
            known = merged(list(x + y), order)[0] == [x, y]
            machine.judged[pair] = known
        ok[i] = known
    at = np.flatnonzero(~odd)
    x, y = a[at], b[at]
    until_x, until_y = np.full(len(at), NEVER), np.full(len(at), NEVER)
    while len(at):
        r = machine.merges.get(x << 24 | y)
        lost = (r < until_x) & (r <= until_y)
        ok[at[lost]] = False
        on = ~lost & ((machine.made[x] >= 0) | (machine.made[y] >= 0))
        at, x, y, until_x, until_y = at[on], x[on], y[on], until_x[on], until_y[on]
        by_x = machine.made[x] > machine.made[y]
        until_x = np.where(by_x, machine.made[x], until_x)
        until_y = np.where(by_x, until_y, machine.made[y])
        x, y = np.where(by_x, machine.right[x], x), np.where(by_x, y, machine.left[y])
    return ok


def paths(machine: Machine, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the words' shortest paths, one word after the other, and how many each word has."""
    lengths = np.array([len(w) for w in words])
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    letters = machine.alphabet[codes].astype(np.int64)
    stop = np.repeat(np.cumsum(lengths), lengths)  # where a character's word ends
    begin = stop - np.repeat(lengths, lengths)

    # Compose with P: from every character, as far as the trie goes.
    at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
    start, end = at, at
    arcs = []
    while len(end):
        node = machine.trie.get(node << 24 | letters[end])
        on = node >= 0
        start, end, node = start[on], end[on] + 1, node[on]
        emits = machine.final[node]
        hit = emits >= 0
        arcs.append((start[hit], end[hit], emits[hit]))
        on = end < stop[start]
        start, end, node = start[on], end[on], node[on]
    source, target, symbol = (np.concatenate(x) for x in zip(*arcs))

    # Compose with G and take least weights, boundary after boundary of all words in step.
    # A boundary is known by the character before it, or by its word's first character less one.
    reach = target - begin[source]
    short = reach.astype(np.int16) if len(codes) < 1 << 15 or reach.max() < 1 << 15 else reach  # sorts faster
    order = np.argsort(short, kind="stable")
    source, target, symbol, reach = source[order], target[order], symbol[order], reach[order]
    cuts = np.searchsorted(reach, np.arange(1, (lengths.max() if len(lengths) else 0) + 2))
    last = np.full(len(codes), -1)  # symbol that ends here on the best path
    weight = np.full(len(codes), np.inf)
    for lo, hi in zip(cuts, cuts[1:]):
        s, t, y = source[lo:hi], target[lo:hi] - 1, symbol[lo:hi]
        inner = np.flatnonzero(s > begin[s])
        cost = np.zeros(len(s)) if machine.bpe else machine.score[y]
        cost[inner] += weight[s[inner] - 1]
        if machine.bpe:
            inner = inner[np.isfinite(cost[inner])]
            bad = inner[~accepted(machine, last[s[inner] - 1], y[inner])]
            cost[bad] = np.inf
            good = np.isfinite(cost)  # one arc for a boundary at most
            weight[t[good]], last[t[good]] = 0.0, y[good]
            continue
        best = np.lexsort((s, cost, t))  # of equal paths the one with the longer last piece
        first = best[np.concatenate([[True], t[best][1:] != t[best][:-1]])] if len(best) else best
        weight[t[first]] = cost[first]
        last[t[first]] = np.where(np.isfinite(cost[first]), y[first], -1)

    sizes = np.array([len(x) for x in machine.names])
    ends = np.cumsum(lengths) - 1
    floor = ends - lengths
    which, here, found = np.arange(len(words)), ends, []
    while len(which):
        y = last[here]
        found.append((which, y))
        here = here - sizes[y]
        on = here > floor[which]
        which, here = which[on], here[on]
    word = np.concatenate([w for w, _ in found])
    step = np.concatenate([np.full(len(w), -i) for i, (w, _) in enumerate(found)])
    symbols = np.concatenate([y for _, y in found])
    return symbols[np.lexsort((step, word))], np.bincount(word, minlength=len(words))


def spelled(machine: Machine, char: str) -> list[int]:
    """Byte fallback."""
    if machine.byte_ids is None:
        return [machine.unknown]
    return [machine.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]


class Encoder:
    """Encodes texts; remembers words it has met, up to ``KNOWN`` of them."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.cut = re.compile(machine.pattern, re.S).findall
        self.clear()

    def clear(self):
        self.place: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.start = np.zeros(1, np.int64)

    def learn(self, words: list[str]) -> None:
        machine, ids, sizes, order = self.machine, [self.ids], [], []
        usual = [w for w in words if machine.alphabet[ord(w[-1])] >= 0]
        together = np.cumsum([len(w) for w in usual]) // COMPOSED if usual else np.zeros(0, int)
        cuts = [0, *(np.flatnonzero(np.diff(together)) + 1).tolist(), len(usual)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            symbols, counts = paths(machine, usual[lo:hi])
            if symbols.max(initial=0) >= len(machine.pieces):
                parts = [self.expand(x) for x in np.split(symbols, np.cumsum(counts)[:-1])]
                symbols, counts = np.concatenate(parts), np.array([len(x) for x in parts])
            ids.append(symbols.astype(np.int32))
            sizes.append(counts)
            order += usual[lo:hi]
        for w in words:
            if machine.alphabet[ord(w[-1])] < 0:  # a character that stands alone
                own = machine.single.get(w)
                ids.append(np.array([own] if own is not None else spelled(machine, w), np.int32))
                sizes.append([len(ids[-1])])
                order.append(w)
        self.place.update(zip(order, range(len(self.place), len(self.place) + len(order))))
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(np.concatenate(sizes))])
        self.ids = np.concatenate(ids)

    def expand(self, symbols: np.ndarray) -> list[int]:
        out = []
        for s in symbols.tolist():
            out.extend([s] if s < len(self.machine.pieces) else spelled(self.machine, self.machine.names[s]))
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids, one after the other, and how many each text has."""
        cuts = [self.cut(normalise(self.machine, t)) for t in texts]
        if len(self.place) > KNOWN:
            self.clear()
        new = dict.fromkeys(w for c in cuts for w in c if w not in self.place)
        if new:
            self.learn(list(new))
        at = np.fromiter((self.place[w] for c in cuts for w in c), np.int64)
        sizes = self.start[at + 1] - self.start[at]
        ends = np.cumsum(sizes)
        step = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        ids = self.ids[np.repeat(self.start[at], sizes) + step]
        text = np.repeat(np.arange(len(texts)), [len(c) for c in cuts])
        return ids, np.bincount(text, sizes, len(texts)).astype(np.int64)


def decode_ids(machine: Machine, ids) -> str:
    """P backwards: pieces to text, bytes that are no UTF-8 to U+FFFD; without N's first blank."""
    data = b"".join(map(machine.pieces.__getitem__, ids))
    if machine.first_blank and data.startswith(b" "):
        data = data[1:]
    return data.decode("utf-8", "replace")


def encode(
    docs: DataFrame, machine: Machine, text_col: str = "text", name: str = "ids", *, proof: bool = False
) -> DataFrame:
    """``docs`` with an array of piece ids, replacing a column of that name.

    Whole texts are encoded; null and empty ones have an empty array. With
    ``proof`` the ids are decoded again in the same task, and two columns more
    hold the SHA-256 of the decoded text and whether it is the text, a literal
    U+2581 counting as a blank. Repeated rows are rows; an empty table gives no rows.
    """
    more = [T.StructField(name, T.ArrayType(T.IntegerType()))]
    if proof:
        more += [T.StructField("decoded_sha256", T.StringType()), T.StructField("round_trip", T.BooleanType())]
    new = {f.name.lower() for f in more}
    at = next(i for i, c in enumerate(docs.columns) if c.lower() == text_col.lower())
    rows = docs.select(*(col(c).cast("string").alias(c) if i == at else col(c) for i, c in enumerate(docs.columns)))
    keep = [i for i, c in enumerate(docs.columns) if c.lower() not in new]
    schema = T.StructType([*(rows.schema[i] for i in keep), *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(machine)
        for batch in batches:
            texts, size, start = [], 0, 0
            for i in range(batch.num_rows):
                texts.append(batch.column(at)[i].as_py() or "")
                size += len(texts[-1])
                if size < TEXT and i + 1 < batch.num_rows:
                    continue
                ids, counts = encoder.encode(texts)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                part = batch.slice(start, len(texts))
                out = [part.column(k) for k in keep]
                out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32))))
                if proof:
                    back = [decode_ids(machine, ids[a:b].tolist()) for a, b in zip(ends, ends[1:])]
                    out.append(pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()))
                    out.append(pa.array([t == x.replace(BLANK, " ") for t, x in zip(back, texts)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(out, schema.names)
                texts, size, start = [], 0, i + 1

    return mapped(rows, run, schema)


def decode(docs: DataFrame, machine: Machine, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``docs`` with the text of an array of ids, replacing a column of that name.

    Null and empty arrays give empty text; bytes that are no UTF-8 become U+FFFD.
    Repeated rows are rows; an empty table gives none. Columns of any name pass through.
    """
    rest = [c for c in docs.columns if c.lower() != name.lower()]
    kept = docs.select(*(col(c) for c in rest))
    (ids,) = own(kept, "ids_to_decode")
    rows = docs.select(*(col(c) for c in rest), col(ids_col).alias(ids))
    schema = T.StructType([*kept.schema, T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            texts = [decode_ids(machine, x.values.to_numpy() if x.is_valid else ()) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*rest, name])

    return mapped(rows, run, schema)
