"""Helpers which several corpus operators share."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word: anything between ASCII white space. ``bytes.split()`` cuts alike.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(whole(text), UPPER, UPPER.lower())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Where the session names none, a folder in the warehouse, which they share too.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return sc.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder, without its lineage.

    For narrow tables that several later steps read.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The frame as a Parquet table in the shared folder: for wide tables."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def own(df: DataFrame, *names: str) -> list[str]:
    """Column names of an operator's own that do not occur in ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def least_hashed(rows: DataFrame, n: int, *columns: str, seed: int) -> DataFrame:
    """``n`` rows with the least hash of ``columns``; all of them if there are no more.

    Hashes alone go through the ordering, so that only the chosen rows move.
    """
    (mark,) = own(rows, "mark")
    hashed = rows.withColumn(mark, F.xxhash64(*(col(c) for c in columns), F.lit(seed)))
    last = hashed.select(mark).orderBy(mark).limit(n).agg(F.max(mark)).first()[0]
    return hashed.where(F.col(mark) <= F.lit(last)).drop(mark).limit(n)


def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what earlier ones took goes back to the machine, since an idle worker keeps what it holds."""
    pool = pa.default_memory_pool()
    for batch in batches:
        yield batch
        del batch
        pool.release_unused()


def mapped(rows: DataFrame, run, schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for columns of any name, dots included: by position."""
    plain = [f"c{i}" for i in range(len(rows.columns))]
    names = [f"c{i}" for i in range(len(schema))]
    fields = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, schema)])

    def renamed(batches):
        for batch in run(freed(batches)):
            yield pa.RecordBatch.from_arrays(batch.columns, names)

    return rows.toDF(*plain).mapInArrow(renamed, fields).toDF(*schema.names)


def by_value(module: str) -> None:
    """Lets Spark send the functions of this module along with a task.

    Python workers on other machines then need not have the package installed.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)
