"""Replacement that readers survive."""

import threading

import pytest
from conftest import daily

from tidemark.sources import staging
from tidemark.sources.layers import LayerStore
from tidemark.sources.versions import VersionedTable


def test_a_reader_stays_with_its_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists() and table.versions() == []
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.replace(daily(spark, [1]))
    second = table.replace(table.read().union(daily(spark, [2])))  # reads what it replaces
    assert first.count() == 1 and second.count() == 2 and table.read().count() == 2
    assert staging.load(spark, str(tmp_path / "t")).count() == 2
    staged = table.stage(daily(spark, [7, 8, 9]))
    assert table.read().count() == 2 and len(table.versions()) == 3
    table.publish(staged)
    assert table.read().count() == 3 and second.count() == 2


def test_vacuum_leaves_what_is_current_or_young(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    frames = [table.replace(daily(spark, range(n))) for n in (1, 2, 3)]
    assert table.vacuum(3600) == []
    running = table.stage(daily(spark, [1]))
    gone = table.vacuum(0)
    assert len(gone) == 2 and table.versions()[-1] == running and len(table.versions()) == 2
    assert frames[2].count() == 3 and table.read().count() == 3


def test_readers_in_a_loop_while_another_session_replaces(spark, tmp_path):
    path, sizes, stop, seen = str(tmp_path / "t"), [], threading.Event(), []
    VersionedTable(spark, path).replace(daily(spark, range(5)))
    other = spark.newSession()

    def read():
        while not stop.is_set() or len(seen) < 3:
            try:
                frame = VersionedTable(other, path).read()
                seen.append((frame.count(), frame.agg({"v": "sum"}).first()[0]))
            except Exception as e:
                seen.append(e)
                return

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(6, 14):
        VersionedTable(spark, path).replace(daily(spark, range(n)))
        sizes.append(n)
    stop.set()
    reader.join()
    assert all(isinstance(s, tuple) and s[1] == sum(range(s[0])) and s[0] in (5, *sizes) for s in seen), seen[-1]


def test_a_catalog_table_moves_to_its_new_rows(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tm_move LOCATION '{tmp_path}/db'")
    store = LayerStore(spark, str(tmp_path / "s"))
    store.save_table(daily(spark, [1]), "tm_move.t")
    before = spark.table("tm_move.t")
    where = lambda: spark.sql("DESCRIBE TABLE EXTENDED tm_move.t").where("col_name = 'Location'").first().data_type
    old = where()
    assert store.save_table(daily(spark, [2, 3]), "tm_move.t").count() == 2
    assert where() != old and before.count() == 1  # a plan made before keeps its files
    wider = daily(spark, [4]).selectExpr("*", "1 AS more")
    assert store.save_table(wider, "tm_move.t").columns[-1] == "more"
    spark.sql("DROP DATABASE tm_move CASCADE")
