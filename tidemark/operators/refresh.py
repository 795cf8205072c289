"""Panel and features kept up to date by the days that changed.

Sources are replaced as a whole, but a new delivery differs from the last one in
few places: new days at the end, late corrections of some series. ``refresh``
digests the staged rows per series and block of days, in one narrow aggregation,
and reads on only where digests differ. Carried values and look-back reach into
later blocks, so each series and block of features has a head with all that it
depends on: the digests of its own and of the previous block, the carried values
before them, and the days to fill. Heads that changed say what is computed anew;
other blocks keep their files and are not read.

What is current stands in one small versioned table, so that a refresh becomes
visible in one step and readers stay with what they began with.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.windows import per_series
from tidemark.operators import features as feat
from tidemark.operators.blocks import BLOCK, block_end, block_features, block_of, block_start, fill_blocks, last_values
from tidemark.operators.panel import daily_panel, series_keys
from tidemark.sources.layers import settled
from tidemark.sources.versions import VersionedTable

LONG_READ = [S.SERIES, S.DATE, "case_type", "daily_value", "cumulative_value"]
VACC_READ = [S.SERIES, S.DATE, *S.VACC_MEASURES]
KEY = [S.SERIES, BLOCK]
DIGEST = ["n_rows", "digest_a", "digest_b"]
CARRY = S.FORWARD_FILLED
PANEL, FEATURES, STATE, HEADS = "panel", "features", "state", "heads"
PARTS = "part string, block int, path string"
EPOCH = dt.date(1970, 1, 1)


def _digest(df: DataFrame, columns: list[str], size: int) -> DataFrame:
    """Row count and two sums of row hashes by series and block: equal multisets of rows have equal digests.

    Which columns are NULL is hashed too, since the hash itself passes over NULLs.
    """
    gaps = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    one = lambda seed: F.sum(F.xxhash64(F.lit(seed), gaps, *columns).cast("decimal(20,0)"))
    return df.where(F.col(S.DATE).isNotNull()).groupBy(S.SERIES, block_of(F.col(S.DATE), size).alias(BLOCK)).agg(
        F.count("*").alias("n_rows"), one(1).alias("digest_a"), one(2).alias("digest_b")
    )


def digests(long: DataFrame, vacc: DataFrame, key_map: DataFrame, size: int) -> DataFrame:
    """One digest of both sources per series of the key map and block."""
    # Raw rows are added up before they move; the joins see a row per series and block.
    first = _digest(long, LONG_READ, size).join(
        key_map.select(F.col("source_name").alias(S.SERIES), "second_name"), S.SERIES
    ).select(F.col("second_name").alias(S.SERIES), BLOCK, *DIGEST)
    second = _digest(vacc.withColumn("_other", F.lit(True)), [*VACC_READ, "_other"], size).join(
        series_keys(key_map), S.SERIES, "left_semi"
    )
    return first.unionByName(second).groupBy(KEY).agg(*[F.sum(c).alias(c) for c in DIGEST])


def _within(blocks: Iterable[int], size: int) -> Column:
    """Days in the given blocks, as ranges that a scan can compare with its statistics."""
    ranges: list[list[int]] = []
    for b in sorted(blocks):
        if ranges and ranges[-1][1] + 1 == b:
            ranges[-1][1] = b
        else:
            ranges.append([b, b])
    day = lambda n: EPOCH + dt.timedelta(days=n)
    return reduce(
        Column.__or__,
        (F.col(S.DATE).between(F.lit(day(a * size)), F.lit(day((b + 1) * size - 1))) for a, b in ranges),
        F.lit(False),
    )


def _heads(state: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """Per series and block all that its features depend on."""
    low, high = state.agg(F.min("first_day")).scalar(), state.agg(F.max("last_day")).scalar()
    spans = keys.select(S.SERIES, F.explode(F.sequence(block_of(low, size), block_of(high, size))).alias(BLOCK))
    w = per_series(S.SERIES, BLOCK)
    start = block_start(F.col(BLOCK), size)
    # Every block of the calendar is there, so rows are blocks; the previous one is computed along, as look-back.
    before = w.rowsBetween(Window.unboundedPreceding, -2)
    return spans.join(state, KEY, "left").select(
        *KEY,
        *DIGEST,
        *[F.lag(c).over(w).alias(f"{c}_before") for c in DIGEST],
        *[F.last(c, ignorenulls=True).over(before).alias(c) for c in CARRY],
        F.greatest(low, F.date_sub(start, size)).alias("from_day"),
        F.least(high, block_end(F.col(BLOCK), size)).alias("to_day"),
    )


class RefreshedFeatures:
    """The daily panel and its features below ``path``, in blocks of ``size`` days.

    ``path`` is in a folder that all executors share; one refresh at a time.
    """

    def __init__(self, spark: SparkSession, path: str, size: int = 30):
        if size < feat.LOOK_BACK:
            raise ValueError(f"a block has at least {feat.LOOK_BACK} days, the longest look-back")
        self.spark, self.path, self.size = spark, path.rstrip("/"), size
        self.current = VersionedTable(spark, f"{self.path}/current")

    def parts(self) -> dict[tuple[str, int], str]:
        """Folder of every block of panel and features, and of the two state tables: as many as blocks."""
        if not self.current.exists():
            return {}
        return {(r.part, r.block): r.path for r in self.current.read().collect()}

    def _read(self, paths: Iterable[str], like: DataFrame) -> DataFrame:
        paths = sorted(paths)
        return self.spark.read.schema(like.schema).parquet(*paths) if paths else like.limit(0)

    def _blocks_of(self, parts: dict, part: str, blocks: Iterable[int]) -> list[str]:
        return [parts[part, b] for b in blocks if (part, b) in parts]

    def _replace(self, parts: dict, part: str, df: DataFrame, blocks: Iterable[int], run: str) -> None:
        """Write ``df`` (with its block) as the new content of ``blocks``; blocks without rows go."""
        folder = f"{run}/{part}"
        df.repartition(BLOCK, S.SERIES).sortWithinPartitions(BLOCK, S.DATE, S.SERIES).write.partitionBy(BLOCK).parquet(folder)
        for b in blocks:
            parts.pop((part, b), None)
        at = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        for f in at.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(at):
            name = f.getPath().getName()
            if name.startswith(f"{BLOCK}="):
                parts[part, int(name.split("=")[1])] = f"{folder}/{name}"

    def _table(self, parts: dict, part: str, df: DataFrame, run: str) -> DataFrame:
        df.write.parquet(f"{run}/{part}")
        parts[part, -1] = f"{run}/{part}"
        return self.spark.read.parquet(f"{run}/{part}")

    def read(self, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
        """The features, of all days or of those in a range; blocks outside it are not opened.

        Pinned: a later refresh does not change this frame.
        """
        number = lambda day: (day - EPOCH).days // self.size
        paths = [
            path for (part, b), path in self.parts().items()
            if part == FEATURES and (since is None or b >= number(since)) and (until is None or b <= number(until))
        ]
        if not paths:
            return self.spark.createDataFrame([], _feature_schema(self.spark))
        out = self.spark.read.schema(_feature_schema(self.spark)).parquet(*sorted(paths))
        if since is not None:
            out = out.where(F.col(S.DATE) >= F.lit(since))
        return out if until is None else out.where(F.col(S.DATE) <= F.lit(until))

    def refresh(self, long: DataFrame, vacc: DataFrame, key_map: DataFrame) -> tuple[list[int], list[int]]:
        """Bring panel and features to the given sources; returns the blocks of either that were replaced.

        The result is that of a full rebuild: late, new and withdrawn rows,
        repeated ones, keys that come or go, and a calendar that grows at either
        end included. Sources without changes write nothing but the state.
        Empty sources leave no rows. Rows without a day are left out.
        """
        size, run = self.size, f"{self.path}/runs/{uuid.uuid4().hex}"
        parts = self.parts()
        keys = series_keys(key_map)

        found = settled(digests(long, vacc, key_map, size))
        schema = self.spark.createDataFrame([], S.PANEL_SCHEMA)
        ends = schema.withColumn(BLOCK, F.lit(0)).groupBy(KEY).agg(*_ends())
        empty = found.limit(0).join(ends, KEY, "left")
        before = self.spark.read.parquet(parts[STATE, -1]) if (STATE, -1) in parts else empty
        now, then = found.select(KEY + DIGEST), before.select(KEY + DIGEST)
        changed = settled(now.subtract(then).union(then.subtract(now)).select(KEY).distinct())
        first = [r[0] for r in changed.select(BLOCK).distinct().collect()]  # at most the calendar's blocks

        # 1. The panel's changed blocks: other series' rows of these blocks are copied.
        if first:
            near = _within(first, size)
            fresh = daily_panel(long.where(near), vacc.where(near), key_map)
            old = self._read(self._blocks_of(parts, PANEL, first), schema)
            number = block_of(F.col(S.DATE), size).alias(BLOCK)
            rows = old.select("*", number).join(changed, KEY, "left_anti").unionByName(
                fresh.select("*", number).join(changed, KEY, "left_semi")
            )
            self._replace(parts, PANEL, rows, first, run)

        # 2. State: digests, and where a series stands at the end of each block.
        rows = self._read(self._blocks_of(parts, PANEL, first), schema)
        rows = rows.withColumn(BLOCK, block_of(F.col(S.DATE), size)).join(changed, KEY, "left_semi")
        state = before.join(changed, KEY, "left_anti").unionByName(
            found.join(changed, KEY, "left_semi").join(rows.groupBy(KEY).agg(*_ends()), KEY, "left")
        )
        state = self._table(parts, STATE, state, run)

        # 3. Heads that differ from the last ones say which features are out of date.
        had = self.spark.read.parquet(parts[HEADS, -1]) if (HEADS, -1) in parts else None
        heads = self._table(parts, HEADS, _heads(state, keys, size), run)
        had = heads.limit(0) if had is None else had
        stale = settled(heads.subtract(had).select(KEY).unionByName(had.join(heads, KEY, "left_anti").select(KEY)))
        touched = [r[0] for r in stale.select(BLOCK).distinct().collect()]  # at most the calendar's blocks

        # 4. Their features, from the panel of these blocks and the ones before.
        if touched:
            near = self._read(self._blocks_of(parts, PANEL, sorted({*touched, *(b - 1 for b in touched)})), schema)
            own = block_of(F.col(S.DATE), size)
            rows = near.withColumn(BLOCK, F.explode(F.array(own, own + 1))).join(stale, KEY, "left_semi")
            fresh = block_features(fill_blocks(rows, heads.join(stale, KEY, "left_semi")), size)
            old = self._read(
                self._blocks_of(parts, FEATURES, touched), self.spark.createDataFrame([], _feature_schema(self.spark))
            )
            old = old.withColumn(BLOCK, own).join(stale, KEY, "left_anti")
            self._replace(parts, FEATURES, old.unionByName(fresh), touched, run)

        entries = [(part, b, path) for (part, b), path in parts.items()]
        self.current.replace(self.spark.createDataFrame(entries, PARTS).coalesce(1))
        return sorted(first), sorted(touched)

    def vacuum(self, older_than: float) -> int:
        """Forget states that ended ``older_than`` seconds ago, and remove runs that no kept state uses."""
        self.current.vacuum(older_than)
        used = {p for v in self.current.versions() for (p,) in self.current.read(v).select("path").collect()}
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/runs")
        files = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = [
            f.getPath() for f in files.listStatus(at)
            if not any(f"/runs/{f.getPath().getName()}/" in p for p in used)
        ]
        for run in gone:
            files.delete(run, True)
        return len(gone)


def _ends() -> list[Column]:
    return [F.min(S.DATE).alias("first_day"), F.max(S.DATE).alias("last_day"), *last_values(CARRY)]


def _feature_schema(spark: SparkSession):
    """Names and types of the feature table, from its plan over no rows."""
    return feat.features(spark.createDataFrame([], S.PANEL_SCHEMA).na.fill(0)).schema
