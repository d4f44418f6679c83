"""Declared schemas of the four inputs and the five output tables."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "date": T.DateType(),
}


def _struct(columns: str) -> T.StructType:
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names of the input files and names, columns and partition columns of
# the output tables. Readers of existing files and tables depend on them.
WORLD = _struct(
    "date string, country_region string, province_state string, iso2 string, iso3 string, "
    "case_type string, cases bigint, population_count bigint, combined_key string"
)
BRAZIL = _struct(
    "date date, state string, place_type string, last_available_confirmed bigint, "
    "last_available_deaths bigint, estimated_population_2019 bigint"
)
PROVINCES = _struct("state string, province_state string")
USA = _struct("date date, state_name string, state_fips string, cases bigint, deaths bigint")

DIM_COUNTRY = _struct(
    "country_region string, iso2 string, iso3 string, population_count bigint"
)
DIM_PROVINCE = _struct(
    "country_region string, province_state string, population_count bigint"
)
DIM_TIME = _struct(
    "date string, year string, week int, month string, day string, week_day int, date_key date"
)
FACT_COUNTRY = _struct(
    "country_name string, date date, confirmed_cases bigint, death_cases bigint, "
    "sum_confirmed_cases bigint, sum_death_cases bigint"
)
FACT_PROVINCE = _struct(
    "country_name string, province_state string, date date, confirmed_cases bigint, "
    "death_cases bigint, sum_confirmed_cases bigint, sum_death_cases bigint"
)

PARTITIONS = {
    "dim_country": ["country_region"],
    "dim_province": ["country_region", "province_state"],
    "dim_time": ["year", "month"],
    "fact_covid_country": ["country_name", "date"],
    "fact_covid_country_province": ["country_name", "province_state", "date"],
}
# The facts in coarser folders, for places whose days are a few rows each.
BY_MONTH = PARTITIONS | {
    "fact_covid_country": ["country_name", "month"],
    "fact_covid_country_province": ["country_name", "month"],
}
LAYOUTS = {"day": PARTITIONS, "month": BY_MONTH}
TABLES = {
    "dim_country": DIM_COUNTRY,
    "dim_province": DIM_PROVINCE,
    "dim_time": DIM_TIME,
    "fact_covid_country": FACT_COUNTRY,
    "fact_covid_country_province": FACT_PROVINCE,
}
CONFIRMED, DEATHS = "Confirmed", "Deaths"
BRAZIL_NAME, USA_NAME, USA_SHORT = "Brazil", "United States", "US"
# A fact's country name, where the dimension has another.
ALIASES = {USA_NAME: USA_SHORT}
STATE_LEVEL = "state"

MEASURES = ["confirmed_cases", "death_cases", "sum_confirmed_cases", "sum_death_cases"]
