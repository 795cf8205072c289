"""Column lists, schemas and fixed values of every layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SERIES = "country_region"
DATE = "date"

# --- fixed values -----------------------------------------------------------
# The four categories of the long table; only the first three are measured.
CASE_TYPES = ("Confirmed", "Deaths", "Recovered", "Active")

# Series monitored by default: (name in the long table, name in the second table).
DEFAULT_KEY_MAP = [
    ("United States", "United States"),
    ("India", "India"),
    ("Brazil", "Brazil"),
    ("Germany", "Germany"),
    ("France", "France"),
    ("United Kingdom", "United Kingdom"),
    ("Japan", "Japan"),
    ("Australia", "Australia"),
    ("Canada", "Canada"),
    ("Italy", "Italy"),
    ("Mexico", "Mexico"),
    ("Spain", "Spain"),
    ("Indonesia", "Indonesia"),
    ("South Africa", "South Africa"),
    ("Turkey", "Turkey"),
]

# Left out of the model, of the recent actuals and of the risk statistics.
DEFAULT_EXCLUDED = ("Turkey",)

TIERS = ("HIGH", "MODERATE", "LOW")
# --- end of fixed values ----------------------------------------------------

# Staged long table; the first group is required, the rest passed on if there.
LONG_REQUIRED = [SERIES, "province_state", DATE, "case_type", "cases", "difference"]
LONG_OPTIONAL = [
    "county", "iso3166_1", "iso3166_2", "lat", "long",
    "last_updated_date", "last_reported_flag",
]
LONG_RENAMES = {"cases": "cumulative_value", "difference": "daily_value"}

VACC_MEASURES = [
    "total_vaccinations",
    "people_vaccinated",
    "people_fully_vaccinated",
    "daily_vaccinations",
    "people_vaccinated_per_hundred",
    "people_fully_vaccinated_per_hundred",
    "daily_vaccinations_per_million",
]
VACC_REQUIRED = [SERIES, DATE, *VACC_MEASURES]
VACC_OPTIONAL = [
    "iso3166_1", "daily_vaccinations_raw", "total_vaccinations_per_hundred",
    "vaccines", "last_observation_date", "last_update_date", "last_reported_flag",
]

POPULATION_REQUIRED = [SERIES, "continentexp", "population"]
POPULATION_OPTIONAL = [
    "iso3166_1", "cases", "deaths", "cases_since_prev_day",
    "deaths_since_prev_day", DATE, "last_update_date", "last_reported_flag",
]
POPULATION_RENAMES = {
    "continentexp": "continent",
    "cases": "cumulative_cases",
    "deaths": "cumulative_deaths",
    "cases_since_prev_day": "daily_cases",
    "deaths_since_prev_day": "daily_deaths",
}

# Gap filling: counts of a missing day are 0, levels keep their last value.
ZERO_FILLED = ["new_cases", "new_deaths", "new_recovered", "daily_vaccinations"]
FORWARD_FILLED = [
    "cumulative_cases",
    "cumulative_deaths",
    "cumulative_recovered",
    "people_fully_vaccinated_per_hundred",
    "people_vaccinated_per_hundred",
]

FEATURE_COLUMNS = [
    SERIES, DATE,
    "new_cases", "new_deaths", "new_recovered",
    "cumulative_cases", "cumulative_deaths",
    "cases_7d_avg", "cases_14d_avg", "deaths_7d_avg", "vacc_7d_avg",
    "doubling_time_days", "wow_change_7d_avg", "wow_growth_pct",
    "daily_vaccinations", "people_fully_vaccinated_per_hundred",
    "vacc_rate_lag_14d", "vacc_rate_lag_21d", "vacc_rate_lag_28d",
    "case_death_ratio", "surge_flag", "vacc_impact_proxy", "recovery_rate",
]

TARGET = "target_cases"
EXOGENOUS = [
    "deaths_7d_avg",
    "vacc_7d_avg",
    "people_fully_vaccinated_per_hundred",
    "vacc_rate_lag_14d",
    "vacc_rate_lag_21d",
    "vacc_rate_lag_28d",
]

# Types the staged columns get, whatever exact type the source stores.
STAGED_TYPES = {
    DATE: "date",
    **dict.fromkeys(["cases", "difference", "deaths", "population"], "bigint"),
    **dict.fromkeys(["cases_since_prev_day", "deaths_since_prev_day"], "bigint"),
    **{c: "double" if "_per_" in c else "bigint" for c in VACC_MEASURES},
}

_D, _L, _S = T.DoubleType(), T.LongType(), T.StringType()

PANEL_SCHEMA = T.StructType(
    [T.StructField(SERIES, _S), T.StructField(DATE, T.DateType())]
    + [
        T.StructField(c, _L)
        for c in (
            "new_cases", "new_deaths", "new_recovered",
            "cumulative_cases", "cumulative_deaths", "cumulative_recovered",
            "total_vaccinations", "people_vaccinated",
            "people_fully_vaccinated", "daily_vaccinations",
        )
    ]
    + [
        T.StructField(c, _D)
        for c in (
            "people_vaccinated_per_hundred",
            "people_fully_vaccinated_per_hundred",
            "daily_vaccinations_per_million",
        )
    ]
)

FORECAST_SCHEMA = T.StructType([
    T.StructField("series", _S),
    T.StructField("ts", T.DateType()),
    T.StructField("forecast", _D),
    T.StructField("lower_bound", _D),
    T.StructField("upper_bound", _D),
])

OUTPUT_SCHEMA = T.StructType([
    T.StructField(SERIES, _S),
    T.StructField("ds", T.DateType()),
    T.StructField("actual_cases", _D),
    T.StructField("actual_deaths", _L),
    T.StructField("forecasted_cases", _D),
    T.StructField("forecast_lower", _D),
    T.StructField("forecast_upper", _D),
    T.StructField("mape", _D),
    T.StructField("is_forecast", T.BooleanType()),
])

IMPORTANCE_SCHEMA = T.StructType([
    T.StructField("series", _S),
    T.StructField("rank", T.IntegerType()),
    T.StructField("feature_name", _S),
    T.StructField("score", _D),
])


def assert_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return ``df`` unchanged, or raise if names or types differ from ``schema``."""
    want = [(f.name, f.dataType.simpleString()) for f in schema]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    if want != have:
        raise TypeError(f"layer schema differs: expected {want}, got {have}")
    return df
