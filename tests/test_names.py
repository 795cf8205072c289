"""Name suggestions against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import names as N
from tidemark.operators.profile import distinct_days, series_audit
from conftest import day


def alike(a, b):
    rows = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, rows[0] = rows[0], i
        for j, y in enumerate(b, 1):
            last, rows[j] = rows[j], min(rows[j] + 1, rows[j - 1] + 1, last + (x != y))
    return round(1 - rows[-1] / max(len(a), len(b), 1), 6)


def plain(s):
    return " ".join(sorted(re.findall(r"[^\W_]+", s.lower())))


def brute(left, right, least):
    one, two = {x for x in left if x is not None}, {x for x in right if x is not None}
    return {
        (a, b, alike(plain(a), plain(b)))
        for a in one - two for b in two - one
        if plain(a) and plain(b) and alike(plain(a), plain(b)) >= least
    }


def suggest(spark, left, right, least):
    one = spark.createDataFrame([(x,) for x in left], "a string")
    two = spark.createDataFrame([(x,) for x in right], "b string")
    got = [tuple(r) for r in N.name_suggest(one, two, "a", "b", least).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_spellings(spark):
    left = ["Korea, South", "US", "Czechia", "Taiwan*", "France", "Burma", "Cabo Verde", None, "???", "", "a", "aaaa aaaa"]
    right = ["South Korea", "United States", "Czech Republic", "Taiwan", "France", "Cape Verde", None, "!", "A", "aaaaaaaaa", "É"]
    got = suggest(spark, left, right, 0.75)
    assert got == brute(left, right, 0.75)
    assert {("Korea, South", "South Korea", 1.0), ("Taiwan*", "Taiwan", 1.0)} <= got
    assert not {a for a, _, _ in got} & {"France", "???", ""}


@pytest.mark.parametrize("least", [0.5, 0.7, 0.8, 1.0])
def test_equals_all_pairs(spark, least):
    rng = random.Random(int(least * 10))
    word = lambda: "".join(rng.choices("abcd", k=rng.randint(1, 7)))
    base = [" ".join(word() for _ in range(rng.randint(1, 3))) for _ in range(60)]
    def spoil(s):
        out = list(s)
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(out) + 1)
            out[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "x", " "])
        return "".join(out)
    right = [spoil(s) for s in base] + base[:5]
    assert suggest(spark, base, right, least) == brute(base, right, least)


def test_limits(spark):
    with pytest.raises(ValueError):
        suggest(spark, ["a"], ["b"], 0.4)
    assert suggest(spark, [], ["b"], 0.8) == set()


def test_distinct_days_as_bitmaps(spark):
    rows = [("A", day(1)), ("A", day(1)), ("A", None), ("A", day(40_000)), ("B", None), (None, day(2)), (None, day(3))]
    df = spark.createDataFrame(rows, "country_region string, date date")
    got = {r.country_region: r.unique_dates for r in distinct_days(df).collect()}
    assert got == {"A": 2, "B": 0, None: 2}
    old = spark.createDataFrame([("A", "0005-01-01"), ("A", "1969-12-31"), ("A", "9999-12-31")], "country_region string, d string")
    old = old.select("country_region", F.col("d").cast("date").alias("date"))
    assert distinct_days(old).first().unique_dates == 3
    plan = series_audit(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "partial_bitmap_construct_agg" in plan
