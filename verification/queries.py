"""One query per operator, table and analysis, over the stand-in sources."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from daytally import schemas
from daytally.functions import date_parts, date_text, parse_mdy, to_mdy
from daytally.operators import (
    daily_delta, distinct_delta, join_lookup, pair_totals, preview, renamed, risen_delta, spread_delta,
    union_tables,
)
from daytally.plans import analyses, dims, facts, quality
from daytally.plans.build import Sources, build_lake, compact_lake, open_lake
from daytally.plans.daily import DailyIncrements
from daytally.plans.levels import fact_levels
from daytally.plans.sketches import sketch_lake, sketched_counts
from daytally.sinks import (
    drop_table, read_table, roll_back, scratch_dir, with_month, write_clustered, write_table,
)
from daytally.sources import (
    LandedFiles, choose_form, input_check, land, land_bucketed, parse_csv, parse_json, read_csv,
    read_inferred, read_json, repeated_days, watch,
)

from .standins import AS_OF, BRAZIL, USA, StandIns

DETAILED = (BRAZIL, USA)
ALIASES = {schemas.BRAZIL_NAME: BRAZIL, schemas.USA_NAME: USA}
# The stand-ins have one row per key and day.
STEADY = {"world": "lag", "brazil": "lag", "usa": "lag"}
FROM_DAY = dt.date(2024, 1, 20)
QUERIES = {}


def _registered(fn):
    return lambda spark, sf_dir: fn(StandIns(spark, sf_dir))


def query(fn):
    QUERIES[fn.__name__.rstrip("_")] = _registered(fn)
    return fn


# --- sources ---------------------------------------------------------------------------------


@query
def scan_csv(s):
    path = scratch_dir(s.spark, "scan_csv")
    s.world_by_customer.write.option("header", True).csv(path)
    return read_csv(s.spark, path, schemas.WORLD)


@query
def scan_csv_gz(s):
    path = scratch_dir(s.spark, "scan_csv_gz")
    s.brazil.write.options(header=True, compression="gzip").csv(path)
    return read_csv(s.spark, path, schemas.BRAZIL)


@query
def scan_json(s):
    path = scratch_dir(s.spark, "scan_json")
    s.usa.write.json(path)
    return read_json(s.spark, path, schemas.USA)


@query
def scan_json_case(s):
    """Fields in other cases than the declared ones, and in another order."""
    path = scratch_dir(s.spark, "scan_json_case")
    s.usa.select(
        F.col("cases").alias("Cases"), F.col("state_name").alias("State_Name"), "date",
        F.col("deaths").alias("DEATHS"), F.col("state_fips").alias("state_FIPS"),
    ).write.json(path)
    return read_json(s.spark, path, schemas.USA)


@query
def scan_json_infer(s):
    path = scratch_dir(s.spark, "scan_json_infer")
    s.usa.write.json(path)
    return read_inferred(s.spark, path, "json").select("state_name", "cases", "deaths")


@query
def scan_infer(s):
    path = scratch_dir(s.spark, "scan_infer")
    s.world_by_customer.write.option("header", True).csv(path)
    found = read_inferred(s.spark, path)
    return found.select("date", "combined_key", "case_type", F.col("cases").cast("bigint"))


@query
def snapshot_raw(s):
    path = scratch_dir(s.spark, "raw")
    rows = s.world_by_customer
    rows.write.option("header", True).csv(path)
    rows.where(F.col("case_type") == "Deaths").write.mode("append").option("header", True).csv(path)
    raw = read_csv(s.spark, path + "/*.csv", schemas.WORLD)
    return land(raw, scratch_dir(s.spark, "snapshot"))


def _landed_twice(s):
    """A source of three files at first; then one is put right, one withdrawn and one added."""
    rows = s.world_by_customer.withColumn("part", F.crc32("combined_key") % 3)
    root = scratch_dir(s.spark, "source")

    def put(name, df):
        df.drop("part").write.mode("overwrite").option("header", True).csv(f"{root}/{name}")

    put("kept", rows.where("part = 0"))
    put("changed", rows.where("part = 1").withColumn("cases", F.col("cases") + 1))
    put("withdrawn", rows.where("part = 1"))
    landed = LandedFiles(s.spark, scratch_dir(s.spark, "landed"), schemas.WORLD,
                         lambda spark, paths: read_csv(spark, paths, schemas.WORLD))
    landed.land(root)
    put("changed", rows.where("part = 1"))
    put("added", rows.where("part = 2"))
    drop_table(s.spark, f"{root}/withdrawn")
    landed.land(root)
    return landed


@query
def land_ledger(s):
    return _landed_twice(s).rows()


@query
def input_check_(s):
    return input_check(
        s.world_by_customer,
        required=["date", "combined_key", "uid"],
        not_null=["date", "country_region", "combined_key", "cases"],
    )


@query
def input_check_observed(s):
    columns = ["date", "country_region", "combined_key", "cases"]
    rows, report = watch(s.world_by_customer, ["date", "combined_key", "uid"], columns)
    rows.write.parquet(scratch_dir(s.spark, "watched"))
    return report()


def _parsed(s):
    """The world file with counts and populations that are none here and there."""
    rows = s.world_by_customer.withColumns({
        "population_count": F.when(F.col("cases") % 7 == 0, "1.5").otherwise(F.col("population_count").cast("string")),
        "cases": F.when(F.col("cases") % 5 == 0, F.concat(F.col("cases").cast("string"), F.lit("?")))
        .otherwise(F.col("cases").cast("string")),
    })
    path = scratch_dir(s.spark, "faulty")
    rows.write.option("header", True).csv(path)
    return parse_csv(s.spark, path, schemas.WORLD)


@query
def scan_rejects(s):
    of = [F.get_json_object("text", f"$.{c}").alias(c) for c in ("combined_key", "case_type", "date")]
    return _parsed(s).rejects.select("column", "value", "reason", *of)


@query
def scan_rejects_kept(s):
    return _parsed(s).kept


@query
def scan_rejects_json(s):
    rows = s.usa.withColumn("deaths", F.when(F.col("cases") % 5 == 0, "none").otherwise(F.col("deaths").cast("string")))
    path = scratch_dir(s.spark, "faulty")
    rows.write.json(path)
    got = parse_json(s.spark, path, schemas.USA)
    return got.rejects.select("column", "value", F.get_json_object("text", "$.state_name").alias("state_name"),
                              F.get_json_object("text", "$.date").cast("date").alias("date"))


@query
def input_repeated_days(s):
    return repeated_days(s.readings, ["user_id", "case_type"], "day")


# --- sinks -----------------------------------------------------------------------------------


@query
def sink_overwrite_1(s):
    path = scratch_dir(s.spark, "dim_country")
    write_table(dims.dim_country(s.world, AS_OF), path, ["country_region"])
    return read_table(s.spark, path, schemas.DIM_COUNTRY)


@query
def sink_overwrite(s):
    path = scratch_dir(s.spark, "dim_time")
    write_table(dims.dim_time(s.world, BRAZIL), path, ["year", "month"])
    return read_table(s.spark, path, schemas.DIM_TIME)


@query
def sink_overwrite_3(s):
    path = scratch_dir(s.spark, "fact_province")
    by = ["country_name", "province_state", "date"]
    write_table(fact_province_all(s), path, by)
    return read_table(s.spark, path, schemas.FACT_PROVINCE)


@query
def sink_by_month(s):
    path = scratch_dir(s.spark, "places_by_month")
    rows = facts.world_days(s.world_by_customer).withColumnRenamed("day", "date")
    write_table(with_month(rows), path, ["country_region", "month"])
    schema = with_month(rows).schema
    return read_table(s.spark, path, schema).where(F.col("month") == F.lit(dt.date(2024, 1, 1)))


@query
def sink_month_pruned(s):
    """Days over three months, of which one is read back."""
    path = scratch_dir(s.spark, "places_by_month")
    month = F.element_at(F.split("combined_key", "/"), -1).cast("int") % 3
    rows = facts.world_days(s.world_by_customer).withColumn("date", F.add_months("day", month)).drop("day")
    write_table(with_month(rows), path, ["country_region", "month"])
    return read_table(s.spark, path, with_month(rows).schema).where(F.col("month") == F.lit(dt.date(2024, 2, 1)))


@query
def sink_append(s):
    path = scratch_dir(s.spark, "fact_country")
    by = ["country_name", "date"]
    write_table(facts.brazil_country(s.brazil), path, by)
    write_table(facts.usa_country(s.usa), path, by, "append")
    write_table(fact_world_country(s), path, by, "append")
    return read_table(s.spark, path, schemas.FACT_COUNTRY)


@query
def sink_dynamic(s):
    path = scratch_dir(s.spark, "fact_country")
    fact = fact_country_all(s)
    by = ["country_name", "date"]
    write_table(fact, path, by)
    late = fact.where(F.col("date") >= F.lit(FROM_DAY))
    write_table(late, path, by, "dynamic")
    return read_table(s.spark, path, schemas.FACT_COUNTRY)


@query
def lake_read_pruned(s):
    written = sink_overwrite_3(s)
    return written.where(
        (F.col("country_name") == schemas.BRAZIL_NAME) & (F.col("date") >= F.lit(FROM_DAY))
    )


@query
def lake_clustered(s):
    """A place's history and a day's places, from one table along a curve."""
    path = scratch_dir(s.spark, "clustered")
    rows = facts.world_days(s.world_by_customer)
    write_clustered(rows, path, "combined_key", "day", 16)
    back = s.spark.read.schema(rows.schema).parquet(path)
    trace = back.where(F.col("combined_key") == F.lit("NATION_19/BUILDING/1"))
    some = back.where(F.col("combined_key").startswith("NATION_10/"))
    on_day = back.where(F.col("day") == F.lit(AS_OF))
    return union_tables(*[df.withColumn("way", F.lit(way)) for way, df in (("key", trace), ("keys", some), ("day", on_day))])


@query
def preview_n(s):
    order = ["country_region", "combined_key", "case_type", "cases"]
    return preview(s.world_by_customer.select(*order, "date"), 10, order)


# --- projections, filters, duplicates, unions --------------------------------------------------


@query
def project_select(s):
    return s.world_by_customer.select(
        F.col("country_region").alias("country_name"), "combined_key", "case_type", "date", "cases"
    )


@query
def project_add(s):
    day = parse_mdy(F.col("date"))
    return (
        s.world_by_customer
        .select("combined_key", "case_type", "date")
        .withColumns({"day": day, "day_before": F.date_sub(day, 1)})
    )


@query
def project_literal(s):
    return s.usa.select(
        F.lit(schemas.USA_NAME).alias("country_name"), F.col("state_name").alias("province_state"),
        "date", "cases", "deaths",
    )


@query
def filter_eq(s):
    rows = s.world_by_customer.where(F.col("country_region") == BRAZIL)
    return rows.select("combined_key", "case_type", "date", "cases")


@query
def filter_and(s):
    rows = s.world_by_customer.where(
        (F.col("country_region") == BRAZIL) & (F.col("case_type") == "Deaths")
    )
    return rows.select("combined_key", "date", "cases")


@query
def filter_not_in(s):
    rows = s.world_by_customer.where(~F.col("country_region").isin(*DETAILED))
    return rows.select("country_region", "combined_key", "case_type", "date", "cases")


@query
def filter_as_of(s):
    rows = s.world_by_customer.where(F.col("date") == to_mdy(AS_OF))
    return rows.select("country_region", "combined_key", "case_type", "cases")


@query
def filter_as_of_date(s):
    rows = s.brazil.where(F.col("date") == F.lit(AS_OF))
    return rows.select("state", "place_type", "last_available_confirmed")


@query
def filter_level(s):
    return facts.brazil_states(s.brazil)


@query
def dedup_rows(s):
    return s.brazil.dropDuplicates()


@query
def dedup_column(s):
    return s.world_by_customer.select("date").distinct()


@query
def dedup_by_key(s):
    keys = ["country_region", "province_state", "population_count"]
    return s.world_by_customer.select(*keys).dropDuplicates(keys[:2])


@query
def distinct_join(s):
    rows = facts.world_days(s.world_by_customer)
    increments = daily_delta(rows, facts.WORLD_KEYS, "day", ["cases"])
    return increments.select("case_type", "country_region", "day", "cases_delta").distinct()


@query
def union_by_name(s):
    first = s.usa.select("date", F.col("state_name").alias("place"), "cases", "deaths")
    second = facts.brazil_states(s.brazil).select(
        F.col("last_available_deaths").alias("deaths"),
        F.col("last_available_confirmed").alias("cases"),
        F.col("state").alias("place"),
        "date",
    )
    return union_tables(first, second)


# --- joins and increments ----------------------------------------------------------------------


@query
def join_lookup_raw(s):
    rows = s.brazil.select("date", "state", "place_type", "last_available_confirmed")
    return join_lookup(rows, s.provinces, "state")


@query
def join_lookup_trim(s):
    rows = s.brazil.select("date", "state", "place_type", "last_available_confirmed")
    return join_lookup(rows, s.provinces, "state", trimmed=True)


@query
def delta_join_1key(s):
    states = facts.brazil_states(s.brazil)
    return daily_delta(states, facts.BRAZIL_KEYS, "date", facts.BRAZIL_COUNTS)


@query
def delta_join_2key(s):
    return daily_delta(s.usa, facts.USA_KEYS, "date", facts.USA_COUNTS)


def _long_delta(how):
    def run(s):
        rows = facts.world_days(s.world_by_customer)
        return daily_delta(rows, facts.WORLD_KEYS, "day", ["cases"], how)

    return run


QUERIES["delta_join_long"] = _registered(_long_delta("join"))
QUERIES["delta_lag"] = _registered(_long_delta("lag"))
QUERIES["delta_range"] = _registered(_long_delta("range"))


@query
def delta_split(s):
    rows = s.readings
    keys = ["user_id", "case_type"]
    form = choose_form(rows, keys, "day", scratch_dir(s.spark, "repeated"))
    return distinct_delta(rows, keys, "day", ["reading"], form).distinct()


@query
def delta_pair_totals(s):
    rows = s.readings
    return pair_totals(rows, ["user_id", "case_type"], "day", ["reading"])


@query
def delta_carry(s):
    """The long form by four loads; the last brings a day that some places lacked."""
    rows = land(facts.world_days(s.world_by_customer), scratch_dir(s.spark, "days"))
    table = DailyIncrements(
        s.spark, scratch_dir(s.spark, "carry"), rows.schema, facts.WORLD_KEYS, "day", ["cases"])
    late = (F.crc32("combined_key") % 7 == 0) & (F.col("day") == F.lit(dt.date(2024, 1, 12)))
    first, second = F.lit(dt.date(2024, 1, 16)), F.lit(dt.date(2024, 1, 22))
    for these in (F.col("day") < first, F.col("day").between(first, second), F.col("day") > second):
        table.load(rows.where(these & ~late))
    table.load(rows.where(late))
    return table.increments()


@query
def delta_bucketed(s):
    rows = facts.world_days(s.world_by_customer)
    landed = land_bucketed(rows, scratch_dir(s.spark, "bucketed"), facts.WORLD_KEYS, "day", 8)
    return daily_delta(landed, facts.WORLD_KEYS, "day", ["cases"], "lag")


@query
def delta_gaps(s):
    rows = facts.world_days(s.world_by_customer)
    return spread_delta(rows, facts.WORLD_KEYS, "day", ["cases"])


@query
def delta_monotone(s):
    """Each customer's largest reading of a day: they rise and fall, so increments are pooled."""
    days = s.readings.groupBy("user_id", "case_type", "day").agg(F.max("reading").alias("reading"))
    risen = risen_delta(days, ["user_id", "case_type"], "day", ["reading"])
    whole = risen.groupBy("user_id", "case_type").agg(
        F.count("*").alias("days"), F.sum("reading_delta").alias("total"), F.count_if(F.col("reading_delta") < 0).alias("below"))
    return whole


# --- aggregations ------------------------------------------------------------------------------


@query
def agg_max(s):
    return (
        s.world_by_customer
        .groupBy("country_region", "province_state")
        .agg(F.max("cases").alias("max_cases"))
    )


@query
def agg_join_sum(s):
    rows = s.brazil.groupBy("state").agg(F.sum("last_available_confirmed").alias("n"))
    return (
        join_lookup(rows, s.provinces, "state")
        .groupBy("province_state")
        .agg(F.sum("n").alias("confirmed"))
        .select(F.lit(schemas.BRAZIL_NAME).alias("country_region"), "province_state", "confirmed")
    )


@query
def agg_conditional(s):
    def total(kind):
        return F.sum(F.when(F.col("case_type") == kind, F.col("cases")))

    return (
        s.world_by_customer
        .groupBy("country_region", "province_state", "date")
        .agg(total("Confirmed").alias("confirmed"), total("Deaths").alias("deaths"))
    )


@query
def fact_levels_(s):
    return fact_levels(fact_province_all(s))


@query
def count_distinct(s):
    return s.world_by_customer.agg(
        F.count_distinct("country_region").alias("countries"),
        F.count_distinct("date").alias("dates"),
        F.count_distinct("combined_key").alias("places"),
    )


# --- scalar functions --------------------------------------------------------------------------


@query
def date_parts_(s):
    parts = date_parts(F.col("date"))
    padded = F.concat_ws("-", parts["month"], parts["day"], parts["year"])
    return s.world_by_customer.select(
        "combined_key", "case_type", "date",
        *[c.alias(name) for name, c in parts.items()], padded.alias("padded"),
    )


@query
def parse_date(s):
    return s.world_by_customer.select(
        "combined_key", "case_type", "date", parse_mdy(F.col("date")).alias("day")
    )


@query
def format_date(s):
    day = parse_mdy(F.col("date"))
    return s.world_by_customer.select(
        "combined_key", "case_type", date_text(day).alias("iso"),
        date_text(day, "MM/dd/yyyy").alias("us"),
    )


# --- tables ------------------------------------------------------------------------------------


@query
def dim_country(s):
    return dims.dim_country(s.world, AS_OF)


@query
def dim_country_padded(s):
    """Dates written with leading zeros."""
    padded = F.date_format(parse_mdy(F.col("date")), "MM/dd/yyyy")
    return dims.dim_country(s.world.withColumn("date", padded), AS_OF)


@query
def dim_province_usa(s):
    return dims.dim_province_usa(s.world, AS_OF, USA)


@query
def dim_province_usa_sum(s):
    return dims.dim_province_usa(s.world_by_customer, AS_OF, USA, population="sum")


@query
def dim_province_brazil(s):
    return dims.dim_province_brazil(s.brazil, s.provinces, AS_OF)


@query
def dim_province(s):
    return dims.dim_province(
        s.world, s.brazil, s.provinces, AS_OF, USA
    )


@query
def dim_time(s):
    return dims.dim_time(s.world, BRAZIL)


@query
def dim_time_all(s):
    return dims.dim_time(s.world, country=None)


# The province and world facts use the lag form, which the stand-ins allow; the same facts in
# the form for any source are the "_join" queries. The country sums are in the form for any source.


@query
def fact_brazil_province(s):
    return facts.brazil_province(s.brazil, s.provinces, how="lag")


@query
def fact_brazil_province_join(s):
    return facts.brazil_province(s.brazil, s.provinces)


@query
def fact_brazil_country(s):
    return facts.brazil_country(s.brazil)


@query
def fact_usa_province(s):
    return facts.usa_province(s.usa, how="lag")


@query
def fact_usa_province_join(s):
    return facts.usa_province(s.usa)


@query
def fact_usa_country(s):
    return facts.usa_country(s.usa)


@query
def world_confirmed(s):
    return facts.world_confirmed(s.world, how="lag")


@query
def world_deaths(s):
    return facts.world_deaths(s.world, DETAILED, how="lag")


@query
def fact_world_country(s):
    return facts.world_country(s.world, DETAILED, how="lag")


@query
def fact_world_country_join(s):
    return facts.world_country(s.world, DETAILED)


@query
def fact_world_country_bykey(s):
    return facts.world_country(s.world, DETAILED, places="each")


@query
def fact_world_customers(s):
    return facts.world_country(s.world_by_customer, DETAILED, how="lag")


@query
def fact_world_customers_join(s):
    return facts.world_country(s.world_by_customer, DETAILED)


@query
def fact_world_customers_bykey(s):
    return facts.world_country(s.world_by_customer, DETAILED, places="each")


@query
def fact_country_all(s):
    return facts.country_fact(
        s.world, s.brazil, s.usa, STEADY, no_deaths=DETAILED
    )


@query
def fact_country_corrected(s):
    return facts.country_fact(
        s.world, s.brazil, s.usa, STEADY,
        no_deaths=DETAILED, no_confirmed=DETAILED, places="each",
    )


@query
def fact_world_corrected_revised(s):
    revised = facts.one_reading(s.world_revised, s.brazil, s.usa)
    return facts.world_country(
        revised["world"], DETAILED, no_confirmed=DETAILED, places="each", how="lag"
    )


@query
def fact_world_revised(s):
    """Revised days as they stand: every pair counts, in the form that the source calls for."""
    days = facts.world_days(s.world_revised)
    how = choose_form(days, facts.WORLD_KEYS, "day", scratch_dir(s.spark, "revised"))
    return facts.world_country(s.world_revised, DETAILED, how=how)


@query
def fact_province_all(s):
    return facts.province_fact(
        s.brazil, s.provinces, s.usa, STEADY
    )


@query
def fact_country_spread(s):
    """The corrected fact with first days and the days of gaps."""
    late = facts.one_reading(s.world, s.brazil, s.usa)
    return facts.country_fact(
        late["world"], late["brazil"], late["usa"], facts.one_reading_forms("spread"), places="each", no_confirmed=DETAILED,
        no_deaths=DETAILED)


@query
def countries_reached_late(s):
    """Countries that the spread reaches on different days: a country's first days are left out."""
    later = 3 * (F.coalesce(F.regexp_extract("country_name", "[0-9]+", 0).try_cast("int"), F.lit(0)) % 5)
    rows = fact_country_corrected(s).where(F.col("date") >= F.date_add(F.lit(dt.date(2024, 1, 3)), later))
    return analyses.countries_reached(rows)


# --- quality and analyses ----------------------------------------------------------------------


@query
def quality_counts(s):
    return quality.source_report(s.world, DETAILED)


@query
def quality_lake(s):
    path = scratch_dir(s.spark, "lake")
    rows = s.world
    tables = {
        "dim_country": dims.dim_country(rows, AS_OF),
        "dim_time": dims.dim_time(rows, None),
        "fact_covid_country": fact_country_corrected(s),
    }
    written = {}
    for name, df in tables.items():
        write_table(df, f"{path}/{name}", schemas.PARTITIONS[name])
        written[name] = read_table(s.spark, f"{path}/{name}", schemas.TABLES[name])
    return quality.lake_report(*written.values(), aliases=ALIASES)


@query
def count_sketched(s):
    """Counts from sketches over two loads, beside the exact ones: whether each is within 5 %."""
    lake = _runs(s, since=FROM_DAY, withdrawn=schemas.USA_SHORT)
    sketch_lake(s.spark, lake)
    tables = open_lake(s.spark, lake)
    country, province = tables["fact_covid_country"], tables["fact_covid_country_province"]
    exact = union_tables(*[
        df.agg(F.count_distinct(*columns).alias("exact")).select(
            F.lit(table).alias("table_name"), F.lit(name).alias("column_name"), "exact")
        for df, table, name, columns in (
            (country, "fact_covid_country", "countries", [renamed(F.col("country_name"), schemas.ALIASES)]),
            (country, "fact_covid_country", "dates", ["date"]),
            (province, "fact_covid_country_province", "provinces", ["country_name", "province_state"]),
            (tables["dim_time"], "dim_time", "dates", ["date_key"]),
        )
    ])
    return exact.join(sketched_counts(s.spark, lake), ["table_name", "column_name"]).select(
        "table_name", "column_name", "exact",
        (F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.lit(0.5), 0.05 * F.col("exact"))).alias("near"))


@query
def quality_whole(s):
    """The report of a corrected run, with what has arrived of each source."""
    root = scratch_dir(s.spark, "run")
    return build_lake(s.spark, _raw_files(s), f"{root}/snapshot", f"{root}/lake", AS_OF, corrected=True)


@query
def compare_countries(s):
    return analyses.compare_countries(
        fact_country_corrected(s), dim_country(s), aliases=ALIASES
    )


@query
def compare_countries_on_day(s):
    return analyses.compare_countries(
        fact_country_corrected(s), dim_country(s), AS_OF, ALIASES
    )


@query
def spread(s):
    return analyses.spread(fact_country_corrected(s))


@query
def countries_reached(s):
    return analyses.countries_reached(fact_country_corrected(s))


@query
def spread_waves(s):
    return analyses.waves(fact_country_corrected(s))


@query
def doubling_time(s):
    return analyses.doubling_time(fact_country_corrected(s))


@query
def mortality_rate(s):
    return analyses.mortality_rate(fact_country_corrected(s))


@query
def mortality_rate_province(s):
    return analyses.mortality_rate(fact_province_all(s))


@query
def percent_increase(s):
    return analyses.percent_increase(fact_country_corrected(s))


@query
def trace_province(s):
    written = sink_overwrite_3(s)
    return analyses.trace(written, schemas.USA_NAME, "BUILDING", since=AS_OF)


@query
def trace_country(s):
    return analyses.trace(fact_country_all(s), schemas.BRAZIL_NAME, until=AS_OF)


# --- the whole run -----------------------------------------------------------------------------


def _raw_files(s):
    """The stand-ins as raw files, the two detailed countries under the names a run expects."""
    name = F.col("country_region")
    named = (
        F.when(name == BRAZIL, schemas.BRAZIL_NAME)
        .when(name == USA, schemas.USA_SHORT)
        .otherwise(name)
    )
    root = scratch_dir(s.spark, "files")
    sources = Sources(*[f"{root}/{n}" for n in ("world", "brazil", "provinces", "usa")])
    with_header = {"header": True}
    s.world.withColumn("country_region", named).write.options(**with_header).csv(
        sources.world
    )
    s.brazil.write.options(**with_header, compression="gzip").csv(sources.brazil)
    # Blanks around a key are data here and must survive the writer.
    s.provinces.write.options(
        **with_header, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(sources.provinces)
    s.usa.write.json(sources.usa)
    return sources


def _runs(s, corrected=False, since=None, withdrawn=None, layout="day"):
    """The path of the lake of one run, or of two with ``since``; the second no longer finds the rows
    of the country ``withdrawn`` from then on."""
    sources = _raw_files(s)
    root = scratch_dir(s.spark, "run")
    snapshot, lake = f"{root}/snapshot", f"{root}/lake"
    build_lake(s.spark, sources, snapshot, lake, AS_OF, corrected=corrected, layout=layout)
    if withdrawn:
        world = f"{scratch_dir(s.spark, 'withdrawn')}/world"
        rows = read_csv(s.spark, sources.world, schemas.WORLD)
        late = (F.col("country_region") == withdrawn) & (parse_mdy(F.col("date")) >= F.lit(since))
        rows.where(~late).write.option("header", True).csv(world)
        sources = replace(sources, world=world)
    if since:
        build_lake(s.spark, sources, snapshot, lake, AS_OF, since, corrected, layout)
    return lake


def _built(s, **options):
    return open_lake(s.spark, _runs(s, **options))


@query
def lake_build_country(s):
    return _built(s)["fact_covid_country"]


@query
def lake_build_province(s):
    return _built(s)["fact_covid_country_province"]


@query
def lake_build_corrected(s):
    return _built(s, corrected=True)["fact_covid_country"]


@query
def lake_reload_since(s):
    return _built(s, since=FROM_DAY)["fact_covid_country"]


@query
def lake_reload_withdrawn(s):
    return _built(s, since=FROM_DAY, withdrawn=schemas.USA_SHORT)["fact_covid_country"]


@query
def lake_build_month(s):
    return _built(s, layout="month")["fact_covid_country"]


@query
def lake_version(s):
    """The country fact of two versions, each with its number."""
    lake = _runs(s, since=FROM_DAY, withdrawn=schemas.USA_SHORT)
    return union_tables(*[
        open_lake(s.spark, lake, n)["fact_covid_country"].withColumn("version", F.lit(n)) for n in (1, 2)
    ])


@query
def lake_rollback(s):
    lake = _runs(s, since=FROM_DAY, withdrawn=schemas.USA_SHORT)
    roll_back(s.spark, lake, 1)
    return open_lake(s.spark, lake)["fact_covid_country"]


@query
def lake_compacted(s):
    lake = _runs(s, since=FROM_DAY, withdrawn=schemas.USA_SHORT)
    compact_lake(s.spark, lake, most=1)
    return open_lake(s.spark, lake)["fact_covid_country"]
