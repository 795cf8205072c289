"""Every registered query: SQL agreement, plan shape, independence of settings."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from compare import compare, connect
from conftest import SF

from tidemark.plans import oracle
from tidemark.plans import queries as Q

ROOT = Path(__file__).resolve().parents[1]
QUERIES, SQL = Q.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


#: Trees are compared with a brute-force search instead (test_boosting.py).
WITHOUT_SQL = {"forecast_boosted", "forecast_eval_boosted", "importance_boosted"}


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", ["top_subregions", "granularity_audit", "key_map_coverage", "global_rollup"])
def test_what_is_compared_is_not_empty(spark, name):
    assert not QUERIES[name](spark, SF).isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_nested_loop_or_product(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast, without run-time help."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize(
    "name", ["daily_panel", "gap_fill", "country_stats", "forecast_output", "chart_frame",
             "situation_matrix", "global_rollup"]
)
def test_same_result_without_broadcast_or_adaptive_execution(spark, con, no_broadcast, name):
    assert compare(spark, con, name, SF, QUERIES[name], SQL[name]) is None


def test_windows_over_the_filled_panel_share_one_shuffle(spark, no_broadcast):
    from tidemark.operators.features import features

    p = Q.pipeline_for(spark, SF)
    plan = features(p.filled)._jdf.queryExecution().executedPlan().toString()
    # one exchange for the keys, one for the panel, one per bound of the spine
    by_series = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(by_series) == 2


def test_raw_rows_are_not_shuffled_for_a_large_key_map(spark, no_broadcast):
    p = Q.pipeline_for(spark, SF)
    plan = QUERIES["daily_panel"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    scan = next(i for i, line in enumerate(lines) if "case_type" in line and "FileScan" in line)
    above = next(line for line in reversed(lines[:scan]) if "Exchange" in line or "HashAgg" in line)
    assert "partial_sum" in above
    assert p.long.columns  # the staged layer itself


def test_flagship_query(spark):
    import __spark_entry__ as entry

    assert len(entry.entry(spark).columns) == 23
    assert set(entry.queries()) >= set(QUERIES) and entry.oracle_sql().items() >= SQL.items()


def test_pipeline_with_ridge_builds_every_view(spark):
    p = Q.pipeline_for(spark, SF).with_method("ridge")
    p.build()
    p.create_views()
    for name in p.views():
        assert spark.table(name).limit(1).count() == 1, name


def test_tables_can_be_saved_to_the_catalog(spark, tmp_path):
    from tidemark.sources.layers import LayerStore

    spark.sql(f"CREATE DATABASE IF NOT EXISTS tm_test LOCATION '{tmp_path}/db'")
    df = Q.pipeline_for(spark, SF).evaluation
    saved = LayerStore(spark, str(tmp_path)).save_table(df, "tm_test.forecast_eval")
    assert saved.exceptAll(df).count() == 0
    spark.sql("DROP DATABASE tm_test CASCADE")


def test_python_functions_need_no_package_on_the_workers(tmp_path):
    """The entry file is loaded by path from elsewhere; workers cannot import the package."""
    script = tmp_path / "run.py"
    script.write_text(
        f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("e", {str(ROOT / "__spark_entry__.py")!r})
e = importlib.util.module_from_spec(spec)
spec.loader.exec_module(e)
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
for name in ("narratives", "forecast_ridge"):
    assert e.queries()[name](spark, {SF!r}).count() > 0
print("all fine")
"""
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True,
        timeout=300,
    )
    assert "all fine" in done.stdout, done.stderr[-2000:]
