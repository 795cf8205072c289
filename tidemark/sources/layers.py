"""Materialised layers.

A layer that several later steps read is written once as Parquet and read
back, so its consumers get column pruning, filter pushdown and a short lineage
instead of recomputing the plan. Layers live under the directory the cluster
names in ``spark.checkpoint.dir``, which all executors share, so a lost
executor loses no layer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.versions import VersionedTable


def shared_root(spark: SparkSession) -> str:
    """The shared directory for materialised data.

    Where the session names none, the warehouse, which all executors share too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir", None
    )
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a directory all executors share")
    return root.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """The frame written to the shared directory, without its lineage: for narrow rows that several steps read."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_root(df.sparkSession)}/checkpoints")
    return df.checkpoint()


class LayerStore:
    """Named layers below one root directory, each a ``VersionedTable``.

    Replacing a layer does not disturb who reads it: frames that were read from
    an earlier version stay valid until ``vacuum`` or ``close``.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_root(spark)}/tidemark/{uuid.uuid4().hex}"

    def table(self, layer: str, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{layer}/{name}")

    def path(self, layer: str, name: str) -> str:
        """Where the layer's latest version is."""
        return self.table(layer, name).location()

    def write(
        self, df: DataFrame, layer: str, name: str, cluster_by: tuple[str, ...] = ()
    ) -> DataFrame:
        """Write a new version of the layer and return a reader of it.

        ``cluster_by`` sorts rows within each file, without a shuffle, so that
        the row-group statistics let range filters on those columns skip data.
        """
        return self.table(layer, name).replace(df, cluster_by)

    def read(self, layer: str, name: str) -> DataFrame:
        return self.table(layer, name).read()

    def save_table(self, df: DataFrame, table: str) -> DataFrame:
        """Replace a catalog table with ``df``.

        The rows are written beside the old ones first. A table with the same
        columns then changes its location, in one step, and a query that has
        begun keeps the files it began with. Only a table that is new, was made
        otherwise, or has other columns is dropped and created, and is missing
        in between.
        """
        versions = VersionedTable(self.spark, f"{self.root}/tables/{table}")
        version = versions.stage(df)
        location = versions.location(version)
        if self.spark.catalog.tableExists(table) and self._moves(table, df):
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.spark.catalog.createTable(table, path=location, source="parquet")
        versions.publish(version)
        self.spark.catalog.refreshTable(table)
        return self.spark.table(table)

    def _moves(self, table: str, df: DataFrame) -> bool:
        """Whether the table is one of ours with the columns of ``df``."""
        plain = lambda schema: [(f.name, f.dataType) for f in schema]
        about = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        return (
            about.get("Type") == "EXTERNAL"
            and about.get("Provider", "").lower() == "parquet"
            and plain(self.spark.table(table).schema) == plain(df.schema)
        )

    def vacuum(self, layer: str, name: str, older_than: float) -> list[str]:
        """Remove a layer's versions that stopped being current ``older_than`` seconds ago."""
        return self.table(layer, name).vacuum(older_than)

    def close(self) -> None:
        """Remove all layers of this store; frames that read them are of no use afterwards."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        root.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(root, True)
