import datetime as dt

import pytest
from conftest import SF, daily, day
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import profile
from tidemark.sources import layers, staging, tpch


def test_staging_renames_and_passes_optional_columns(spark):
    raw = spark.createDataFrame(
        [("A", None, day(1), "Confirmed", 9, 4, "AA")],
        "country_region string, province_state string, date date, case_type string, "
        "cases bigint, difference bigint, iso3166_1 string",
    )
    out = staging.stage_long(raw)
    assert out.columns == [
        "country_region", "province_state", "date", "case_type",
        "cumulative_value", "daily_value", "iso3166_1",
    ]
    with pytest.raises(Exception, match="difference"):
        staging.stage_long(raw.drop("difference"))


def test_staging_unifies_case_and_types(spark):
    raw = spark.createDataFrame(
        [("A", None, "2021-01-01", "Confirmed", 9, 4)],
        "COUNTRY_REGION string, PROVINCE_STATE string, DATE string, CASE_TYPE string, "
        "CASES int, DIFFERENCE int",
    ).withColumn("COUNTY", F.lit("x"))
    raw = raw.withColumn("CASES", F.col("CASES").cast("decimal(38,0)"))
    out = staging.stage_long(raw)
    assert dict(out.dtypes) == {
        "country_region": "string", "province_state": "string", "date": "date",
        "case_type": "string", "cumulative_value": "bigint", "daily_value": "bigint",
        "county": "string",
    }


def test_population_staging(spark):
    out = staging.stage_population(tpch.raw_population(spark, SF))
    assert out.columns == ["country_region", "continent", "population"]
    assert out.agg(F.sum("population")).first()[0] == 150


def test_default_key_map(spark):
    rows = staging.key_map(spark).collect()
    assert len(rows) == 15 and all(r.source_name == r.second_name for r in rows)
    assert S.DEFAULT_EXCLUDED[0] in {r.second_name for r in rows}


def test_layers_round_trip_and_replace(spark, tmp_path):
    store = layers.LayerStore(spark, str(tmp_path))
    first = store.write(daily(spark, [1, 2]), "int", "x", ("date",))
    assert first.count() == 2
    assert store.write(daily(spark, [5]), "int", "x").first().v == 5
    assert staging.load(spark, store.path("int", "x")).first().v == 5


def test_missing_mart_loads_empty(spark, tmp_path):
    df = staging.load_or_empty(spark, str(tmp_path / "none"), S.IMPORTANCE_SCHEMA)
    assert df.count() == 0 and df.schema == S.IMPORTANCE_SCHEMA
    assert staging.load_or_empty(spark, "no_such_table", S.IMPORTANCE_SCHEMA).count() == 0


def test_foreign_importance_loses_its_quotes(spark, tmp_path):
    store = layers.LayerStore(spark, str(tmp_path))
    store.write(
        spark.createDataFrame([('"A B"', 1, "x", 0.5)], S.IMPORTANCE_SCHEMA), "marts", "imp"
    )
    assert staging.load_importance(spark, store.path("marts", "imp")).first().series == "A B"


def test_layers_go_to_the_shared_directory_the_session_names(spark, monkeypatch):
    class Conf:
        def __init__(self, **kv):
            self.kv = kv

        def get(self, key, default=None):
            return self.kv.get(key, default)

    class Session:
        def __init__(self, **kv):
            self.conf = Conf(**{k.replace("_", "."): v for k, v in kv.items()})

    named = Session(spark_checkpoint_dir="hdfs://nn/shared/", spark_master="yarn")
    assert layers.shared_root(named) == "hdfs://nn/shared"
    assert layers.LayerStore(named).root.startswith("hdfs://nn/shared/tidemark/")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        layers.shared_root(Session(spark_master="yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        layers.shared_root(Session(spark_master="local[2]"))


def test_describe_and_preview(spark):
    df = daily(spark, [1, 2, 3])
    rows = [tuple(r) for r in staging.describe_schema(df).orderBy("position").collect()]
    assert rows[1] == ("date", "date", True, 2) and len(rows) == 3
    assert staging.preview(df, 2).count() == 2


def test_collecting_a_mart(spark):
    assert sorted(r.v for r in staging.collect_mart(daily(spark, [1, 2, 3]))) == [1, 2, 3]


def test_layer_versions_stay_until_the_store_is_closed(spark, tmp_path):
    store = layers.LayerStore(spark, str(tmp_path / "store"))
    first = store.write(daily(spark, [1]), "int", "x")
    store.write(daily(spark, [2, 3]), "int", "x")
    assert first.count() == 1 and store.read("int", "x").count() == 2
    store.close()
    assert not (tmp_path / "store").exists()


def test_a_pipeline_with_another_method_is_built_once(pipeline):
    other = pipeline.with_method("seasonal_naive")
    frame = other.evaluation
    again = pipeline.with_method("seasonal_naive").evaluation
    assert again is frame and other.with_method(pipeline.method) is pipeline
    assert frame.count() == again.count() > 0


def test_unknown_and_null_segments_and_statuses_are_kept(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(0, "N")], "n_nationkey int, n_name string").write.parquet(f"{root}/nation.parquet")
    spark.createDataFrame(
        [(1, 0, "A"), (2, 0, None), (3, 0, "NEW")], "c_custkey bigint, c_nationkey int, c_mktsegment string"
    ).write.parquet(f"{root}/customer.parquet")
    at = dt.datetime(2020, 1, 1)
    spark.createDataFrame(
        [(1, "F", 5.0, at), (2, "F", 7.0, at), (2, "X", 1.0, at), (3, None, 2.0, at)],
        "o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
    ).write.parquet(f"{root}/orders.parquet")
    got = {(r.province_state, r.case_type): r.difference for r in tpch.raw_long(spark, root).collect()}
    assert len(got) == 3 * 5
    assert got[None, "Confirmed"] == 7 and got[None, "X"] == 1 and got["NEW", None] == 1
    assert sum(got.values()) == 14


def test_schema_assertion(spark):
    with pytest.raises(TypeError):
        S.assert_schema(daily(spark, [1]), S.FORECAST_SCHEMA)


def test_long_adapter_has_all_cells_of_a_day(pipeline):
    per_day = pipeline.long.groupBy(S.SERIES, S.DATE).count()
    assert [r["count"] for r in per_day.select("count").distinct().collect()] == [15]


def test_audits(spark):
    rows = [
        ("A", "x", day(1), "Confirmed", 5, 5), ("A", "y", day(1), "Confirmed", 9, 1),
        ("A", None, day(1), "Confirmed", 1, 1), ("B", "x", day(2), "Deaths", 1, 1),
    ]
    long = staging.stage_long(spark.createDataFrame(
        rows,
        "country_region string, province_state string, date date, case_type string, "
        "cases bigint, difference bigint",
    ))
    d = str(day(1))
    g = profile.granularity_audit(long, d, "Confirmed").first()
    assert (g.num_provinces, g.null_province_rows, g.total_rows) == (2, 1, 3)
    key_map = staging.key_map(spark, [("A", "A"), ("B", "B")])
    cover = profile.key_map_coverage(long, key_map, d, "Confirmed")
    assert {r.source_name: r.stg_rows for r in cover.collect()} == {"A": 3, "B": 0}
    top = profile.top_subregions(long, "A", d, "Confirmed", 2).collect()
    assert [r.province_state for r in top] == ["y", "x"]
    assert profile.spot_check_series(long, "A", d, d).count() == 1
    assert profile.spot_check_series(long, "A", d, d, "x").count() == 1
    assert profile.date_range(long).first() == (day(1), day(2))
    assert {r.case_type for r in profile.distinct_values(long).collect()} == {
        "Confirmed", "Deaths",
    }
    assert profile.row_leaderboard(long, 1).first().country_region == "A"


def test_series_audit_shows_duplicate_days(spark):
    df = daily(spark, [1, 2]).union(daily(spark, [3]))
    r = profile.series_audit(df).first()
    assert (r.total_rows, r.unique_dates) == (3, 2)


def test_null_audit(spark):
    df = daily(spark, [1, None, None])
    r = profile.null_audit(df, ["v", "date"]).first()
    assert tuple(r) == (3, 1, 2, 0)


def test_profile_guards_zero_denominators(spark):
    panel = spark.createDataFrame(
        [("A", day(1), 0, 0, 0, 0, 0, 0, None, None, None, None, None, None, None)],
        S.PANEL_SCHEMA,
    )
    r = profile.data_profile(panel).first()
    assert r.case_fatality_rate_pct is None and r.zero_case_pct == 100.0
    assert r.vaccination_start_date is None and r.vacc_data_days == 0
    assert len(profile.data_profile(panel).columns) == 22


def test_date_types(pipeline):
    assert isinstance(pipeline.long.first().date, dt.date)
