"""Features by blocks of days, and their refresh, against the whole computation."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import blocks, features, panel, refresh

LONG = "country_region string, date date, case_type string, daily_value bigint, cumulative_value bigint"
VACC = f"country_region string, date date, {', '.join(f'{c} ' + ('double' if '_per_' in c else 'bigint') for c in S.VACC_MEASURES)}"
KEYS = [("A", "a"), ("B", "b"), ("C", "c"), ("D", "d")]
FIRST = dt.date(2020, 12, 20)


def sources(seed=1, days=260):
    """Series with gaps; C has few days, D none; X is not in the key map; the second table is patchy."""
    rnd = random.Random(seed)
    long, vacc = [], []
    for name, share in (("A", 0.9), ("B", 0.4), ("C", 0.03), ("X", 0.5)):
        total = 0
        for i in range(days):
            if rnd.random() < share or (name == "A" and i in (0, days - 1)):
                day = FIRST + dt.timedelta(i)
                for kind in ("Confirmed", "Deaths", "Recovered"):
                    n = rnd.randrange(-5, 60)
                    total += max(n, 0)
                    long.append((name, day, kind, n, total))
                if rnd.random() < 0.3 and name != "X":
                    vacc.append((name.lower(), day, *[rnd.choice([None, i, i * 1.0]) if "_per_" not in c else rnd.choice([None, i / 7]) for c in S.VACC_MEASURES]))
    vacc = [(*v[:2], *[float(x) if x is not None and "_per_" in c else None if x is None else int(x) for c, x in zip(S.VACC_MEASURES, v[2:])]) for v in vacc]
    return long, vacc


def frames(spark, long, vacc, keys=KEYS):
    return (
        spark.createDataFrame(long, LONG),
        spark.createDataFrame(vacc, VACC),
        spark.createDataFrame(keys, "source_name string, second_name string"),
    )


def whole(long, vacc, key_map):
    daily = panel.daily_panel(long, vacc, key_map)
    return features.features(panel.gap_fill(daily, panel.series_keys(key_map)))


def rows(df):
    return sorted(df.select(*S.FEATURE_COLUMNS).collect(), key=str)


def test_look_back_covers_every_lag(spark):
    """With a row that differs LOOK_BACK + 1 days earlier, features are the same; at LOOK_BACK days they may differ."""
    n = 60
    base = [("a", FIRST + dt.timedelta(i), *[i + 1] * 4, *[float(i + 1)] * 5) for i in range(n)]
    schema = "country_region string, date date, " + ", ".join(f"{c} bigint" for c in S.ZERO_FILLED) + ", " + ", ".join(f"{c} double" for c in S.FORWARD_FILLED)

    def last(changed):
        data = [(*r[:2], *[x * 50 for x in r[2:]]) if i == changed else r for i, r in enumerate(base)]
        return features.features(spark.createDataFrame(data, schema)).orderBy(F.desc("date")).first()

    plain = last(None)
    assert last(n - 2 - features.LOOK_BACK) == plain
    assert last(n - 1 - features.LOOK_BACK) != plain


@pytest.mark.parametrize("size", [28, 90])
def test_blocked_features_are_the_whole_ones(spark, size):
    long, vacc, keys = frames(spark, *sources())
    daily = panel.daily_panel(long, vacc, keys)
    got = blocks.features_blocked(daily, panel.series_keys(keys), size=size)
    assert got.columns == S.FEATURE_COLUMNS
    want = rows(whole(long, vacc, keys))
    assert len(want) == 4 * 260 and rows(got) == want


def test_blocked_features_of_nothing(spark):
    daily = spark.createDataFrame([], S.PANEL_SCHEMA)
    keys = spark.createDataFrame([("a",)], "country_region string")
    assert blocks.features_blocked(daily, keys).collect() == []
    with pytest.raises(ValueError):
        blocks.features_blocked(daily, keys, size=20)


def test_no_task_has_a_whole_series(spark):
    long, vacc, keys = frames(spark, *sources())
    daily = panel.daily_panel(long, vacc, keys)
    groups = {}
    cut = blocks.with_look_back(daily, 30, features.LOOK_BACK)
    for r in cut.groupBy("country_region", "block").count().collect():
        groups[r[0], r[1]] = r["count"]
    assert max(groups.values()) <= 2 * (30 + features.LOOK_BACK)
    plan = blocks.features_blocked(daily, panel.series_keys(keys))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_refresh_equals_a_rebuild(spark, tmp_path):
    long, vacc = sources()
    table = refresh.RefreshedFeatures(spark, str(tmp_path / "t"), size=30)

    def check(long, vacc, keys=KEYS):
        given = frames(spark, long, vacc, keys)
        out = table.refresh(*given)
        assert rows(table.read()) == rows(whole(*given))
        return out

    every, _ = check(long, vacc)
    assert len(every) >= 9
    assert check(long, vacc) == ([], [])  # nothing changed, in another order too
    assert check(long[::-1], vacc[::-1]) == ([], [])

    # a late correction of the series that has most days: its block and what looks back on it
    at = next(i for i, r in enumerate(long) if r[0] == "A" and r[1] > FIRST + dt.timedelta(100))
    late = [(*r[:3], r[3] + 1000, r[4] + 7) if i == at else r for i, r in enumerate(long)]
    panel_blocks, feature_blocks = check(late, vacc)
    assert len(panel_blocks) == 1 and feature_blocks[0] == panel_blocks[0] and len(feature_blocks) <= 3

    # withdrawn rows, a repeated one, a value that becomes NULL: carried values change far beyond
    gone = [r for r in late if not (r[0] == "C" and r[1] > FIRST + dt.timedelta(30))]
    check([*gone, gone[5]], vacc)
    check(gone, [(*v[:2], None, *v[3:]) if i % 3 == 0 else v for i, v in enumerate(vacc)])
    # a series that comes, one that goes, days that come at either end
    check(gone, vacc, [*KEYS[1:], ("X", "x")])
    early, coming = FIRST - dt.timedelta(45), FIRST + dt.timedelta(300)
    check([*gone, ("B", early, "Deaths", 3, 3), ("B", coming, "Confirmed", 5, 900)], vacc)
    check(gone, vacc)
    assert table.vacuum(0) > 0 and table.read().count() == rows_of(spark, gone, vacc)
    check([], vacc)
    check([], [])
    check(long, vacc)


def rows_of(spark, long, vacc):
    return whole(*frames(spark, long, vacc)).count()


def test_blocks_that_did_not_change_are_not_read(spark, tmp_path):
    """Files of the blocks that a correction does not reach are unreadable, and the refresh goes through."""
    long, vacc = sources()
    table = refresh.RefreshedFeatures(spark, str(tmp_path / "t"), size=30)
    table.refresh(*frames(spark, long, vacc))
    old = table.read()
    before = table.parts()
    last = max(b for part, b in before if part == "panel")
    reached = {("panel", b) for b in (last, last - 1)} | {("features", last), ("state", -1), ("heads", -1)}
    spoilt = []
    for key, folder in before.items():
        if key not in reached:
            for file in (tmp_path / folder.removeprefix(str(tmp_path) + "/")).glob("*.parquet"):
                spoilt.append((file, file.read_bytes()))
                file.write_bytes(b"no parquet")
                file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    assert len(spoilt) > 10
    day = max(r[1] for r in long if r[0] == "A")
    late = [(*r[:3], r[3] + 100, r[4]) if r[0] == "A" and r[1] == day else r for r in long]
    given = frames(spark, late, vacc)
    assert table.refresh(*given) == ([last], [last])
    for file, data in spoilt:
        file.write_bytes(data)
    assert rows(table.read()) == rows(whole(*given))
    assert rows(old) == rows(whole(*frames(spark, long, vacc)))  # a pinned reader
    since = day - dt.timedelta(3)
    assert table.read(since).inputFiles() and table.read(since).agg(F.min("date")).first()[0] == since
    assert all(f"block={last}" in f for f in table.read(since).inputFiles())
    after = table.parts()
    assert all(after[k] == before[k] for k in before if k not in reached)


def test_scan_gets_the_changed_days_only(spark):
    size = 30
    near = refresh._within([3, 4, 9], size)
    days = spark.range(0, 600).select(F.date_from_unix_date(F.col("id").cast("int")).alias("date"))
    got = {r[0] for r in days.where(near).select(blocks.block_of(F.col("date"), size)).distinct().collect()}
    assert got == {3, 4, 9}
