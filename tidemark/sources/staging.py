"""Staging projections, constant relations and reading of stored tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.scalars import strip_quotes
from tidemark.sources.versions import VersionedTable

KEY_MAP_SCHEMA = "source_name string, second_name string"


def stage(
    df: DataFrame,
    renames: Mapping[str, str] | None = None,
    *,
    required: Sequence[str] | None = None,
    optional: Sequence[str] = (),
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Project to the listed columns under their staged names and types.

    Without ``required`` every column passes. A missing required column is an
    error at analysis time; optional ones are passed on where they exist.
    Names are matched without regard to case and come out as listed.
    """
    renames, types = renames or {}, types or {}
    have = {c.lower() for c in df.columns}
    names = list(df.columns) if required is None else [
        *required, *(c for c in optional if c in have)
    ]
    typed = [F.col(c).cast(types[c]) if c in types else F.col(c) for c in names]
    return df.select(*[c.alias(renames.get(n, n)) for c, n in zip(typed, names)])


def stage_long(raw: DataFrame) -> DataFrame:
    """Long table: one row per (series, sub-region, day, category)."""
    return stage(
        raw, S.LONG_RENAMES, required=S.LONG_REQUIRED, optional=S.LONG_OPTIONAL,
        types=S.STAGED_TYPES,
    )


def stage_vacc(raw: DataFrame) -> DataFrame:
    """Second table: one row per (series, day) with vaccination measures."""
    return stage(
        raw, required=S.VACC_REQUIRED, optional=S.VACC_OPTIONAL, types=S.STAGED_TYPES
    )


def stage_population(raw: DataFrame) -> DataFrame:
    return stage(
        raw, S.POPULATION_RENAMES, required=S.POPULATION_REQUIRED,
        optional=S.POPULATION_OPTIONAL, types=S.STAGED_TYPES,
    )


def key_map(
    spark: SparkSession, pairs: Sequence[tuple[str, str]] = tuple(S.DEFAULT_KEY_MAP)
) -> DataFrame:
    """Constant relation: series name in the long table, name in the second one."""
    return spark.createDataFrame(list(pairs), KEY_MAP_SCHEMA)


def horizon(days: int, column: str = "step"):
    """Generator column 1..days, one output row each."""
    return F.explode(F.sequence(F.lit(1), F.lit(days))).alias(column)


def load(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or files by path: of a versioned table, those of its current version."""
    if "/" in name_or_path:
        versions = VersionedTable(spark, name_or_path)
        if fmt == "parquet" and versions.exists():
            return versions.read()
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def load_or_empty(
    spark: SparkSession, name_or_path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Like ``load``, but an empty frame where the table does not exist yet."""
    try:
        return load(spark, name_or_path, fmt)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return spark.createDataFrame([], schema)
        raise


def load_importance(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Feature importance written elsewhere, with quotes around names removed."""
    df = load_or_empty(spark, name_or_path, S.IMPORTANCE_SCHEMA)
    return df.withColumn("series", strip_quotes(F.col("series")))


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    return df.limit(n)


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: name, type, nullable, position."""
    rows = [
        (f.name, f.dataType.simpleString(), f.nullable, i)
        for i, f in enumerate(df.schema, start=1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, data_type string, nullable boolean, position int"
    )


def collect_mart(df: DataFrame) -> Iterator[Row]:
    """The rows of a finished mart at the client, one partition in memory at a time."""
    return df.toLocalIterator()
