"""Stand-ins for the four inputs, derived from events, customers and nations.

An event is a case, its day the day it was counted, the customer's nation the country and the
market segment the province. Events are counted per customer, kind and day *before* they meet
the customers, so a customer with very many events is a few rows by then.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

BRAZIL, USA = "NATION_19", "NATION_10"
AS_OF = dt.date(2024, 1, 19)


# The columns read from the given tables; declared, so that opening one starts no job.
GIVEN = {
    "events": [("ts", T.TimestampNTZType()), ("user_id", T.LongType()),
               ("event_type", T.StringType()), ("value", T.DoubleType())],
    "customer": [("c_custkey", T.LongType()), ("c_nationkey", T.IntegerType()),
                 ("c_mktsegment", T.StringType())],
    "nation": [("n_nationkey", T.IntegerType()), ("n_name", T.StringType())],
}


def _so_far(*place: str):
    by_day = Window.partitionBy(*place).orderBy("day")
    return by_day.rowsBetween(Window.unboundedPreceding, 0)


class StandIns:
    """The sources for one folder of given tables, each defined once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _given(self, name: str) -> DataFrame:
        schema = T.StructType([T.StructField(c, t) for c, t in GIVEN[name]])
        return self.spark.read.schema(schema).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        deaths = F.col("event_type").isin("error", "purchase")
        return self._given("events").select(
            "user_id",
            F.when(deaths, "Deaths").otherwise("Confirmed").alias("case_type"),
            F.col("ts").cast("date").alias("day"),
            "value",
        )

    @cached_property
    def customer_days(self) -> DataFrame:
        counted = self.events.groupBy("user_id", "case_type", "day").agg(F.count("*").alias("n"))
        code = F.col("n_nationkey").cast("string")
        people = (
            self._given("customer")
            .join(self._given("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("user_id"),
                F.col("n_name").alias("country_region"),
                F.concat(F.lit("N"), code).alias("iso2"),
                F.concat(F.lit("NA"), code).alias("iso3"),
                F.col("c_mktsegment").alias("province_state"),
            )
        )
        return counted.join(people, "user_id")

    @cached_property
    def world(self) -> DataFrame:
        """The world file, a place being a segment of a nation."""
        place = ["country_region", "iso2", "iso3", "province_state", "case_type", "day"]
        days = self.customer_days.groupBy(*place).agg(F.sum("n").alias("n"))
        return _world(days, F.concat_ws("/", "country_region", "province_state"))

    @cached_property
    def world_by_customer(self) -> DataFrame:
        """The world file with every customer a place of its own: it grows with the events, most
        days of a place are missing, and many places of a nation agree on a day."""
        key = F.concat_ws("/", "country_region", "province_state", "user_id")
        return _world(self.customer_days, key)

    @cached_property
    def world_revised(self) -> DataFrame:
        """The world file with a second, larger reading of every place on each third day."""
        later = self.world.where(F.split("date", "/")[1].cast("int") % 3 == 0)
        return self.world.unionByName(later.withColumn("cases", F.col("cases") + 1))

    def _wide(self, nation: str) -> DataFrame:
        def count(kind: str):
            return F.sum(F.when(F.col("case_type") == kind, F.col("n")).otherwise(0))

        return (
            self.customer_days.where(F.col("country_region") == nation)
            .groupBy("province_state", "day")
            .agg(count("Confirmed").alias("c"), count("Deaths").alias("x"))
            .select(
                "province_state",
                "day",
                F.sum("c").over(_so_far("province_state")).alias("cases"),
                F.sum("x").over(_so_far("province_state")).alias("deaths"),
            )
        )

    @cached_property
    def brazil(self) -> DataFrame:
        """State rows, and a city row per customer that the level filter has to remove."""
        columns = [
            "date", "state", "place_type", "last_available_confirmed", "last_available_deaths",
            "estimated_population_2019",
        ]
        state = F.substring("province_state", 1, 2)
        states = self._wide(BRAZIL).select(
            "day", state, F.lit("state"), "cases", "deaths",
            (1000 * F.length("province_state")).cast("bigint"),
        )
        zero, ten = F.lit(0).cast("bigint"), F.lit(10).cast("bigint")
        cities = (
            self.customer_days.where(F.col("country_region") == BRAZIL)
            .groupBy("day", "province_state", "user_id")
            .agg(F.sum("n").alias("n"))
            .select("day", state, F.lit("city"), "n", zero, ten)
        )
        return states.toDF(*columns).unionByName(cities.toDF(*columns))

    @cached_property
    def provinces(self) -> DataFrame:
        """The lookup; one key carries blanks."""
        segment = F.col("c_mktsegment")
        key = F.when(segment == "MACHINERY", " MA ").otherwise(F.substring(segment, 1, 2))
        lookup = self._given("customer").select(
            key.alias("state"), segment.alias("province_state")
        )
        return lookup.distinct()

    @cached_property
    def usa(self) -> DataFrame:
        return self._wide(USA).select(
            F.col("day").alias("date"),
            F.col("province_state").alias("state_name"),
            F.length("province_state").cast("string").alias("state_fips"),
            "cases",
            "deaths",
        )

    @cached_property
    def readings(self) -> DataFrame:
        """Each event as a reading of its customer: several readings of a key on one day."""
        return self.events.withColumn("reading", F.floor("value").cast("bigint"))


def _world(days: DataFrame, key) -> DataFrame:
    place = _so_far("case_type", "country_region", "combined_key")
    return days.withColumn("combined_key", key).select(
        F.concat_ws("/", F.month("day"), F.dayofmonth("day"), F.year("day")).alias("date"),
        "country_region",
        "province_state",
        "iso2",
        "iso3",
        "case_type",
        F.sum("n").over(place).alias("cases"),
        (1000 * F.length("province_state")).cast("bigint").alias("population_count"),
        "combined_key",
    )
