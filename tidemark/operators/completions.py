"""Completions that are paid for once.

Every prompt is known by its digest. What was asked goes to a ledger, a folder of
small Parquet files that all executors share, one file per batch, written before
the next batch is asked. A later call asks only what the ledger has no text for;
a task that runs again finds the batches of its earlier attempt. A batch that
fails is asked prompt by prompt, and a prompt that keeps failing gets an error in
its row instead of ending the job.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.layers import settled

LEDGER = "digest string, text string, error string, asked_at timestamp"
_ARROW = pa.schema([
    ("digest", pa.string()), ("text", pa.string()), ("error", pa.string()), ("asked_at", pa.timestamp("us", "UTC")),
])
Ask = Callable[[list[str]], list[str]]


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":" in uri else (fs.LocalFileSystem(), uri)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(digest, text, asked_at) of every prompt with a text; of several the latest."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    rows = spark.read.schema(LEDGER).option("pathGlobFilter", "*.parquet").parquet(path)
    return rows.where("error IS NULL").groupBy("digest").agg(
        F.max_by("text", "asked_at").alias("text"), F.max("asked_at").alias("asked_at")
    )


def ask_batch(fn: Ask, prompts: list[str], attempts: int) -> list[tuple[str | None, str | None]]:
    """(text, error) for each prompt: all at once, or one by one if that fails, each up to ``attempts`` times."""
    try:
        texts = list(fn(prompts))
        if len(texts) == len(prompts):
            return [(t, None) for t in texts]
        why = f"{len(prompts)} prompts gave {len(texts)} texts"
    except Exception as e:
        why = f"{type(e).__name__}: {e}"
    out: list[tuple[str | None, str | None]] = []
    for prompt in prompts:
        error = why
        for _ in range(attempts):
            try:
                (text,) = fn([prompt])
            except Exception as e:
                error = f"{type(e).__name__}: {e}"
            else:
                out.append((text, None))
                break
        else:
            out.append((None, error))
    return out


def complete_once(
    prompts: DataFrame,
    fn: Ask,
    path: str,
    out: str = "narrative",
    prompt: str = "prompt",
    *,
    batch: int = 16,
    attempts: int = 3,
) -> DataFrame:
    """Replace each prompt by its completion, with ``generated_at`` and ``error``.

    ``fn`` takes up to ``batch`` prompts and returns as many texts; it runs in
    the executors. Equal prompts are asked once. A null prompt is not asked:
    text, time and error are null. ``path`` is the ledger's folder.
    """
    spark = prompts.sparkSession
    keyed = prompts.withColumn("_digest", F.sha2(F.col(prompt).cast("string"), 256))
    asked = keyed.where(F.col("_digest").isNotNull()).select("_digest", F.col(prompt).alias("_prompt"))
    left = asked.join(ledger(spark, path), F.col("_digest") == F.col("digest"), "left_anti").dropDuplicates(["_digest"])
    # The same prompts in the same order whenever a task runs, so that its batches are the same.
    left = settled(left).repartition("_digest").sortWithinPartitions("_digest")
    run_id = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _filesystem(path)
        rows = ((d.as_py(), p.as_py()) for b in batches for d, p in zip(*b.columns))
        while some := [r for _, r in zip(range(batch), rows)]:
            digests = [d for d, _ in some]
            name = f"{folder}/{hashlib.sha256(''.join(digests).encode()).hexdigest()[:40]}-{run_id}.parquet"
            if system.get_file_info(name).type == fs.FileType.File:
                table = pq.read_table(name, filesystem=system)
            else:
                answers = ask_batch(fn, [p for _, p in some], attempts)
                now = dt.datetime.now(dt.timezone.utc)
                table = pa.table(
                    [digests, [t for t, _ in answers], [e for _, e in answers], [now] * len(some)], schema=_ARROW
                )
                # Whole or not at all: readers of the ledger pass over other names.
                fresh = f"{name}.{uuid.uuid4().hex}.tmp"
                pq.write_table(table, fresh, filesystem=system)
                system.move(fresh, name)
            failed = table.filter(pa.compute.is_valid(table["error"]))
            yield from failed.select(["digest", "error"]).combine_chunks().to_batches()

    # This runs the prompts; what comes back is what has no text.
    failed = settled(left.mapInArrow(run, "digest string, error string"))
    done = ledger(spark, path).select(
        F.col("digest").alias("_of"), F.col("text").alias(out), F.col("asked_at").alias("generated_at")
    )
    rest = [F.col(c) for c in prompts.columns if c != prompt]
    told = keyed.join(done, F.col("_digest") == F.col("_of"), "left").join(
        failed.withColumnRenamed("error", "_error"), F.col("_digest") == F.col("digest"), "left"
    )
    return told.select(*rest, out, "generated_at", F.col("_error").alias("error"))


# Functions of this module go along with a task, for workers without the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
