from conftest import column, day
from tidemark import schemas as S
from tidemark.operators import panel as P
from tidemark.sources import staging

LONG = (
    "country_region string, province_state string, date date, case_type string, "
    "cases bigint, difference bigint"
)
VACC = "country_region string, date date, " + ", ".join(
    f"{c} {'double' if 'per' in c else 'bigint'}" for c in S.VACC_MEASURES
)


def long_table(spark, rows):
    return staging.stage_long(spark.createDataFrame(rows, LONG))


def vacc_table(spark, rows):
    """rows: (series, day, coverage)"""
    full = [(s, d, 1, None, None, 1, None, cov, None) for s, d, cov in rows]
    return staging.stage_vacc(spark.createDataFrame(full, VACC))


def key_map(spark, *names):
    return staging.key_map(spark, [(n, n) for n in names])


def small_panel(spark):
    long = long_table(spark, [
        ("A", "x", day(1), "Confirmed", 5, 5),
        ("A", "x", day(3), "Confirmed", 3, -2),
        ("A", "x", day(4), "Confirmed", 10, 7),
        ("Z", "x", day(2), "Confirmed", 9, 9),
    ])
    return P.daily_panel(long, vacc_table(spark, []), key_map(spark, "A", "B"))


def test_unmapped_series_are_left_out_and_names_translated(spark):
    long = long_table(spark, [
        ("Türkei", None, day(1), "Confirmed", 1, 1), ("Z", None, day(1), "Confirmed", 1, 1),
    ])
    vacc = vacc_table(spark, [("Turkey", day(1), 0.5)])
    out = P.daily_panel(long, vacc, staging.key_map(spark, [("Türkei", "Turkey")])).collect()
    assert [(r.country_region, r.people_fully_vaccinated_per_hundred) for r in out] == [
        ("Turkey", 0.5)
    ]


def test_sub_regions_and_types_are_summed_apart(spark):
    long = long_table(spark, [
        ("A", "x", day(1), "Confirmed", 10, 4),
        ("A", None, day(1), "Confirmed", 20, 5),
        ("A", "x", day(1), "Deaths", 3, 1),
        ("A", "x", day(1), "Active", 99, 99),
    ])
    row = P.pivot_daily(long).collect()[0]
    assert (row.new_cases, row.cumulative_cases) == (9, 30)
    assert (row.new_deaths, row.cumulative_deaths) == (1, 3)
    assert (row.new_recovered, row.cumulative_recovered) == (0, 0)


def test_clip_comes_after_the_sum(spark):
    long = long_table(spark, [
        ("A", "x", day(1), "Confirmed", 1, -5), ("A", "y", day(1), "Confirmed", 1, 7),
        ("A", "x", day(2), "Confirmed", 1, -5), ("A", "y", day(2), "Confirmed", 1, 1),
    ])
    out = P.clip_corrections(P.pivot_daily(long))
    assert column(out, "new_cases") == [2, 0]


def test_duplicate_days_of_the_second_source_fan_out(spark):
    long = long_table(spark, [("A", "x", day(1), "Confirmed", 1, 1)])
    vacc = vacc_table(spark, [("A", day(1), 1.0), ("A", day(1), 2.0)])
    assert P.daily_panel(long, vacc, key_map(spark, "A")).count() == 2


def test_gap_and_clip(spark):
    out = P.gap_fill(small_panel(spark), P.series_keys(key_map(spark, "A"))).collect()
    out.sort(key=lambda r: r.date)
    assert [r.date for r in out] == [day(i) for i in (1, 2, 3, 4)]
    assert [r.new_cases for r in out] == [5, 0, 0, 7]
    assert [r.cumulative_cases for r in out] == [5, 5, 3, 10]


def test_series_without_data_is_zero_on_the_whole_spine(spark):
    out = P.gap_fill(small_panel(spark), P.series_keys(key_map(spark, "A", "B")))
    b = out.filter("country_region = 'B'")
    assert b.count() == 4
    assert {r.cumulative_cases for r in b.collect()} == {0}
    assert {r.people_vaccinated_per_hundred for r in b.collect()} == {0.0}


def test_head_is_zero_and_null_levels_keep_the_last_value(spark):
    long = long_table(
        spark,
        [("B", "x", day(1), "Confirmed", 1, 1)]
        + [("A", "x", day(i), "Confirmed", i, 1) for i in (3, 4, 5, 6)],
    )
    coverage = {3: 1.0, 4: None, 5: None, 6: 4.0}
    vacc = vacc_table(spark, [("A", day(i), c) for i, c in coverage.items()])
    panel = P.daily_panel(long, vacc, key_map(spark, "A", "B"))
    a = P.gap_fill(panel, P.series_keys(key_map(spark, "A", "B"))).filter("country_region = 'A'")
    assert column(a, "cumulative_cases") == [0, 0, 3, 4, 5, 6]
    assert column(a, "people_fully_vaccinated_per_hundred") == [0.0, 0.0, 1.0, 1.0, 1.0, 4.0]


def test_gap_fill_equals_spine_left_join(spark, pipeline):
    spine = P.date_spine(pipeline.panel, pipeline.keys)
    pipeline.panel.createOrReplaceTempView("gp_panel")
    spine.createOrReplaceTempView("gp_spine")
    fill = ", ".join(
        f"""coalesce(last({c}, true) OVER (PARTITION BY s.country_region ORDER BY s.date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS {c}"""
        for c in S.FORWARD_FILLED
    )
    zero = ", ".join(f"coalesce({c}, 0) AS {c}" for c in S.ZERO_FILLED)
    want = spark.sql(
        f"""SELECT s.country_region, s.date, {zero}, {fill} FROM gp_spine s
        LEFT JOIN gp_panel p ON s.country_region = p.country_region AND s.date = p.date"""
    )
    got = pipeline.filled.select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_panel_layer_invariants(pipeline):
    series, days = pipeline.keys.count(), pipeline.panel.agg({"date": "max"}).first()
    filled = pipeline.filled
    assert days and filled.count() == series * filled.select("date").distinct().count()
    assert filled.filter(" OR ".join(f"{c} IS NULL" for c in filled.columns)).count() == 0


def test_vacc_timeline_starts_with_the_first_dose(spark):
    long = long_table(spark, [("A", "x", day(i), "Confirmed", i, 1) for i in (1, 2)])
    panel = P.daily_panel(long, vacc_table(spark, [("A", day(2), 1.0)]), key_map(spark, "A"))
    assert column(P.vacc_timeline(panel), "date") == [day(2)]
