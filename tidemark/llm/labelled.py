"""Bounded samples of labelled rows, for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col


def sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    *,
    each: int,
    where: str = "true",
    seed: int = 3,
) -> DataFrame:
    """(label, id, text) of at most ``each`` rows of ``labels`` with label 0 and as many with 1.

    Those with the least hash of the identifier among rows that satisfy ``where``
    (SQL over ``id``). Null labels and identifiers are passed over. The sampled
    identifiers are few (2 * ``each`` at most), so the join moves no texts.
    """
    rows = labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("label"))
    rows = rows.where(f"id IS NOT NULL AND label IN (0, 1) AND ({where})").distinct()
    order = F.xxhash64("id", F.lit(seed))
    parts = [rows.where(F.col("label") == v).orderBy(order, "id").limit(each) for v in (0, 1)]
    chosen = parts[0].union(parts[1])
    texts = docs.select(col(id_col).alias("doc"), col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), F.col("doc") == F.col("id")).select("label", "id", "text")
