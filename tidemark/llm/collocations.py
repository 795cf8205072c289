"""Phrases whose words belong together, from sorted streams of n-gram counts.

Tasks count their texts in sorted runs, which are added where they meet. The
counts of words, pairs and triples are kept as two streams each: in prefix
order, by first words, and in suffix order, by last words. What a phrase needs
beside its own count stands next to it in one of the streams, so lockstep merge
joins of a stream with that of the next shorter order find it:

* prefix order: the count of the first word, of the first pair, and for a pair
  the most frequent triple that goes on from it;
* suffix order: the same for last words, last pairs and triples that lead to it.

A phrase occurs no more often than any phrase inside it. So once the counts are
whole, n-grams below ``least`` leave the streams: no candidate needs them.

No count is looked up by hashing: all joins are sort-merge joins, and their
streams never have to fit in memory. A frequent first word has a row per
following word, not per occurrence; skewed partitions are split by adaptive
execution, and the shorter stream has one row per key.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, col, freed, settled, whole

by_value(__name__)

# What a byte is, in place: part of a word, a blank, or a mark that ends a piece.
WORD, BLANK, MARK = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[np.frombuffer(b" \t", np.uint8)] = BLANK
KIND[np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)] = MARK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of text that a task holds, and words that are counted as one run.
HELD, RUN = 16 << 20, 1 << 20
#: Bytes of text per bucket in which counts meet, and bytes of phrases that are held there before they are added.
PER_BUCKET, ADDED = 1 << 20, 16 << 20
#: Groups per language in which the best phrases are chosen before they meet.
BUCKETS = 64
BITS = 21  # a run has fewer than 2**BITS different words
SPACE = pa.scalar(b" ", pa.large_binary())


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All words in order, A-Z in lower case, and for each the number of its piece."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    kind = KIND[data]
    inside = kind == WORD
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    piece = np.cumsum(kind == MARK, dtype=np.int32)[starts]
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends - starts)])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[data[inside]])]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), piece


def sorted_runs(words: pa.Array, piece: np.ndarray, buckets: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Phrases of one to three words with their counts and buckets: by bucket, then in prefix order.

    Words of a run are numbered in the order of their bytes, so that packed
    numbers sort as phrases do. A phrase is counted where it begins, and its
    bucket depends on its words alone.
    """
    for at in range(0, len(words), RUN):
        here = words.slice(at, RUN + 2)
        own = min(RUN, len(words) - at)
        coded = here.dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary)
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        ids, names = rank[coded.indices.to_numpy()], coded.dictionary.take(order)
        marks = np.fromiter((xxhash.xxh64_intdigest(w) for w in names.to_pylist()), np.uint64, len(names))
        part = piece[at : at + len(here)]
        key, low = ids[:own], (1 << BITS) - 1
        for size in (1, 2, 3):
            n = min(own, len(ids) - size + 1)
            if n <= 0:
                break
            if size > 1:
                key = (key[:n] << BITS) | ids[size - 1 : size - 1 + n]
            found, count = np.unique(key[part[:n] == part[size - 1 : size - 1 + n]], return_counts=True)
            numbers = [(found >> (BITS * k)) & low for k in reversed(range(size))]
            mixed = np.zeros(len(found), np.uint64)
            for x in numbers:
                mixed = (mixed ^ marks[x]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            bucket = (mixed % np.uint64(buckets)).astype(np.int64)
            turn = np.argsort(bucket, kind="stable")
            columns = [names.take(pa.array(x[turn])) for x in numbers]
            yield columns[0] if size == 1 else pc.binary_join_element_wise(*columns, SPACE), count[turn], bucket[turn]


def packed(phrases: pa.Array, counts: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, bytes) with the phrases of each bucket: their number, lengths, counts and texts."""
    offsets = np.frombuffer(phrases.buffers()[1], np.int64)[phrases.offset : phrases.offset + len(phrases) + 1]
    texts = memoryview(phrases.buffers()[2] or b"")
    lengths, counts = np.diff(offsets).astype("<u4"), counts.astype("<u4")
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)) if len(bucket) else []
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for lo, hi in zip(cuts, cuts[1:]):
        data = b"".join((
            (int(hi) - int(lo)).to_bytes(4, "little"), lengths[lo:hi].tobytes(), counts[lo:hi].tobytes(),
            texts[offsets[lo] : offsets[hi]],
        ))
        # What is short would only grow.
        yield int(bucket[lo]), b"z" + squeeze(data) if len(data) > 256 else b"p" + data


def added(blobs: list[bytes], before: tuple[pa.Array, np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """Different phrases with their sums, from packed counts and an earlier sum."""
    lengths, counts, texts = [], [before[1]], []
    open_ = zstandard.ZstdDecompressor().decompress
    for blob in blobs:
        data = open_(blob[1:]) if blob[:1] == b"z" else blob[1:]
        n = int.from_bytes(data[:4], "little")
        lengths.append(np.frombuffer(data, "<u4", n, 4))
        counts.append(np.frombuffer(data, "<u4", n, 4 + 4 * n).astype(np.int64))
        texts.append(data[4 + 8 * n :])
    ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *lengths]), dtype=np.int64)
    new = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(b"".join(texts))])
    coded = pa.concat_arrays([before[0], new]).dictionary_encode()
    sums = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(sums, coded.indices.to_numpy(), np.concatenate(counts))
    return coded.dictionary, sums


NOTHING = (pa.array([], pa.large_binary()), np.zeros(0, np.int64))


def counted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 1) -> DataFrame:
    """(lang, phrase, f) of every word, pair and triple with ``least`` occurrences; the empty phrase counts all words.

    A task counts its texts in sorted runs, some megabytes at a time. What it
    found moves in packed form, a row per run and bucket, and is added bucket
    by bucket. There are as many buckets as megabytes of text, so a bucket has
    about the same number of phrases whatever the size of the corpus; a phrase
    that every run holds is added up on the way.
    """
    rows = docs.select(
        F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.encode(whole(col(text_col)), "UTF-8").alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets = max(64, -(-size // PER_BUCKET))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in itertools.chain(freed(batches), [None]):
            if batch is not None:
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    held.setdefault(lang, []).append(text.as_py())
                    size += len(held[lang][-1])
                    if size >= HELD:
                        yield from sent(held)
                        held, size = {}, 0
        yield from sent(held)

    def sent(held: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
        for lang in sorted(held):
            words, piece = words_of(held[lang])
            every = [(pa.array([b""], pa.large_binary()), np.array([len(words)]), np.zeros(1, np.int64))]
            for phrases, counts, bucket in itertools.chain(every if len(words) else [], sorted_runs(words, piece, buckets)):
                out = list(packed(phrases, counts, bucket))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b for b, _ in out], pa.int64()),
                        pa.repeat(lang, len(out)),
                        pa.array([data for _, data in out], pa.binary()),
                    ],
                    ["bucket", "lang", "data"],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, size, total = None, [], 0, NOTHING
        for batch in itertools.chain(freed(batches), [None]):
            rows = [] if batch is None else zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
            for bucket, lang, data in itertools.chain(rows, [(None, None, None)] if batch is None else []):
                if (bucket, lang) != at:
                    if at is not None:
                        yield enough(at[1], *added(waiting, total))
                    at, waiting, size, total = (bucket, lang), [], 0, NOTHING
                if bucket is not None:
                    waiting.append(data.as_py())
                    size += len(waiting[-1])
                    if size >= ADDED:
                        waiting, size, total = [], 0, added(waiting, total)

    def enough(lang: str, phrases: pa.Array, sums: np.ndarray) -> pa.RecordBatch:
        kept = np.flatnonzero(sums >= least)
        text = phrases.take(pa.array(kept)).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.repeat(lang, len(kept)), text, pa.array(sums[kept])], ["lang", "phrase", "f"])

    runs = rows.mapInArrow(run, "bucket bigint, lang string, data binary")
    dealt = runs.repartition("bucket").sortWithinPartitions("bucket", "lang")
    return dealt.mapInArrow(add, "lang string, phrase string, f bigint")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly: products have up to 38 digits. At most 1000000."""
    wide = lambda c: c.cast("decimal(15,0)")
    top = (wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)")
    bottom = (wide(left) * wide(right)).cast("decimal(31,0)")
    # The quotient's whole part: the remainder goes first, so that nothing is rounded.
    return ((top - top % bottom) / bottom).cast("bigint")


def merged(one: DataFrame, other: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A merge join of two streams sorted by ``on``."""
    return one.join(other.hint("merge"), on, how)


def phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    least: int = 10,
    share: int = 50,
) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of each phrase of two or three words that is kept.

    Words are lower-cased (A-Z); phrases lie within a piece between marks or
    line ends. ``a``: occurrences, ``least`` or more. The lowest of a phrase's
    cuts gives l and r, the counts of its two sides, and the score; of equal
    ones the first. A phrase goes if a longer candidate that holds it has at
    least ``share`` per cent of its occurrences. n: all words of the language.
    Null texts are empty, null languages ``und``. Repeated rows count
    repeatedly; an empty table gives no rows; other columns are not read.
    """
    return _scored(settled(counted(docs, text_col, lang_col, least)), least, share)


def _scored(counts: DataFrame, least: int, share: int) -> DataFrame:
    word = F.split("phrase", " ")
    size = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit("")))
    rows = counts.withColumn("blanks", size)
    totals = rows.where("phrase = ''").select("lang", F.col("f").alias("n"))
    frequent = rows.where((F.col("f") >= least) & (F.col("phrase") != ""))
    ones = frequent.where("blanks = 0").select("lang", F.col("phrase").alias("word"), "f")
    twos = frequent.where("blanks = 1").select("lang", "phrase", word[0].alias("w1"), word[1].alias("w2"), "f")
    threes = frequent.where("blanks = 2").select(
        "lang", "phrase",
        F.substring_index("phrase", " ", 2).alias("first_two"),
        F.substring_index("phrase", " ", -2).alias("last_two"),
        "f",
    )

    # Prefix order: words go along with the pairs they begin, pairs with the triples they begin.
    begun = merged(twos, ones.select("lang", F.col("word").alias("w1"), F.col("f").alias("f1")), ["lang", "w1"])
    onward = threes.groupBy("lang", F.col("first_two").alias("phrase")).agg(F.max("f").alias("onward"))
    begun = settled(merged(begun, onward, ["lang", "phrase"], "left").select("lang", "phrase", "w2", "f", "f1", "onward"))
    # Suffix order: the same for words and pairs at the end.
    ended = merged(begun, ones.select("lang", F.col("word").alias("w2"), F.col("f").alias("f2")), ["lang", "w2"])
    before = threes.groupBy("lang", F.col("last_two").alias("phrase")).agg(F.max("f").alias("before"))
    pairs = settled(
        merged(ended, before, ["lang", "phrase"], "left").select("lang", "phrase", "f", "f1", "f2", "onward", "before")
    )

    a = F.col("f")
    longer = F.greatest("onward", "before")  # nulls are passed over
    kept_pairs = pairs.where(longer.isNull() | (F.lit(100) * longer < F.lit(share) * a)).select(
        "lang", "phrase", a.alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r")
    )
    firsts = pairs.select("lang", F.col("phrase").alias("first_two"), F.col("f").alias("f12"), "f1")
    lasts = pairs.select("lang", F.col("phrase").alias("last_two"), F.col("f").alias("f23"), F.col("f2").alias("f3"))
    whole = merged(merged(threes, firsts, ["lang", "first_two"]), lasts, ["lang", "last_two"])
    after_one, after_two = _score(a, F.col("f1"), F.col("f23")), _score(a, F.col("f12"), F.col("f3"))
    early = after_one <= after_two
    kept_threes = whole.select(
        "lang", "phrase", a.alias("a"),
        F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
    )
    found = kept_pairs.union(kept_threes).withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    # A row per language on one side.
    return found.join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def best(found: DataFrame, limit: int = 2000, buckets: int = BUCKETS) -> DataFrame:
    """Each language's first ``limit`` phrases with their ``rank``, from 1.

    By score and count, the largest first, then by the phrase's bytes. Ranked
    within buckets first, so that no task holds a language.
    """
    order = "ORDER BY score DESC, a DESC, phrase"
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(buckets)).alias("bucket")
    near = found.select("*", bucket).withColumn("place", F.expr(f"row_number() OVER (PARTITION BY lang, bucket {order})"))
    near = near.where(F.col("place") <= limit).drop("place", "bucket")
    ranked = near.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang {order})").cast("bigint"))
    return ranked.where(F.col("rank") <= limit)
