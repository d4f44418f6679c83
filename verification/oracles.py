"""The same answers in plain SQL over the given tables.

Written apart from the library: increments are self-joins, totals are sums over joined pairs.
The ``fx_`` tables are the stand-ins of ``standins.py``.
"""

from __future__ import annotations

import re

FIXTURES = {
    "fx_events": """
        select n.n_name as country_region,
               'N'  || cast(n.n_nationkey as varchar(10)) as iso2,
               'NA' || cast(n.n_nationkey as varchar(10)) as iso3,
               c.c_mktsegment as province_state, e.user_id,
               case when e.event_type in ('error', 'purchase') then 'Deaths' else 'Confirmed' end
                   as case_type,
               cast(e.ts as date) as d
        from events e
        join customer c on e.user_id = c.c_custkey
        join nation n on c.c_nationkey = n.n_nationkey""",
    "fx_cases": """
        select country_region, iso2, iso3, province_state,
               country_region || '/' || province_state as combined_key, case_type, d,
               concat(cast(month(d) as varchar(2)), '/', cast(day(d) as varchar(2)), '/',
                      cast(year(d) as varchar(4))) as date_str,
               cast(sum(n) over (partition by country_region, province_state, case_type order by d
                    rows between unbounded preceding and current row) as bigint) as cases,
               cast(1000 * length(province_state) as bigint) as population_count
        from (select country_region, iso2, iso3, province_state, case_type, d, count(*) as n
              from fx_events
              group by country_region, iso2, iso3, province_state, case_type, d) g""",
    "fx_places": """
        select country_region, iso2, iso3, province_state,
               country_region || '/' || province_state || '/' || cast(user_id as varchar)
                   as combined_key,
               case_type, d,
               concat(cast(month(d) as varchar(2)), '/', cast(day(d) as varchar(2)), '/',
                      cast(year(d) as varchar(4))) as date_str,
               cast(sum(n) over (partition by user_id, case_type order by d
                    rows between unbounded preceding and current row) as bigint) as cases,
               cast(1000 * length(province_state) as bigint) as population_count
        from (select country_region, iso2, iso3, province_state, user_id, case_type, d,
                     count(*) as n
              from fx_events
              group by country_region, iso2, iso3, province_state, user_id, case_type, d) g""",
    "fx_revised": """
        select * from fx_cases union all
        select country_region, iso2, iso3, province_state, combined_key, case_type, d, date_str,
               cases + 1 as cases, population_count
        from fx_cases where day(d) % 3 = 0""",
    "fx_latest": """
        select country_region, combined_key, case_type, d, max(cases) as cases
        from fx_revised group by country_region, combined_key, case_type, d""",
    "fx_wide": """
        select country_region, province_state, d,
               cast(sum(c) over (partition by country_region, province_state order by d
                    rows between unbounded preceding and current row) as bigint) as cases,
               cast(sum(x) over (partition by country_region, province_state order by d
                    rows between unbounded preceding and current row) as bigint) as deaths
        from (select country_region, province_state, d,
                     sum(case when case_type = 'Confirmed' then 1 else 0 end) as c,
                     sum(case when case_type = 'Deaths' then 1 else 0 end) as x
              from fx_events group by country_region, province_state, d) g""",
    "fx_brazil": """
        select d as date, substr(province_state, 1, 2) as state, 'state' as place_type,
               cases as last_available_confirmed, deaths as last_available_deaths,
               cast(1000 * length(province_state) as bigint) as estimated_population_2019
        from fx_wide where country_region = 'NATION_19'
        union all
        select d, substr(province_state, 1, 2), 'city', cast(count(*) as bigint),
               cast(0 as bigint), cast(10 as bigint)
        from fx_events where country_region = 'NATION_19' group by d, province_state, user_id""",
    "fx_provinces": """
        select distinct case when c_mktsegment = 'MACHINERY' then ' MA '
                             else substr(c_mktsegment, 1, 2) end as state,
               c_mktsegment as province_state
        from customer""",
    "fx_usa": """
        select d as date, province_state as state_name,
               cast(length(province_state) as varchar) as state_fips, cases, deaths
        from fx_wide where country_region = 'NATION_10'""",
    "fx_readings": """
        select user_id,
               case when event_type in ('error', 'purchase') then 'Deaths' else 'Confirmed' end
                   as case_type,
               cast(ts as date) as day, cast(floor(value) as bigint) as reading
        from events""",
}

WORLD_COLUMNS = (
    "date_str as date, country_region, province_state, iso2, iso3, case_type, cases, "
    "population_count, combined_key"
)
SUMS = """cast(sum(confirmed_cases) as bigint) as confirmed_cases,
       cast(sum(death_cases) as bigint) as death_cases,
       cast(sum(sum_confirmed_cases) as bigint) as sum_confirmed_cases,
       cast(sum(sum_death_cases) as bigint) as sum_death_cases"""

DAY = """date, dc as confirmed_cases, dx as death_cases,
               c as sum_confirmed_cases, x as sum_death_cases"""
DAY_SUMS = """date, cast(sum(dc) as bigint) as confirmed_cases,
               cast(sum(dx) as bigint) as death_cases,
               cast(sum(c) as bigint) as sum_confirmed_cases,
               cast(sum(x) as bigint) as sum_death_cases"""

PAIRS = """
    {source} a join {source} b
      on a.d - 1 = b.d and a.case_type = b.case_type
     and a.country_region = b.country_region and a.combined_key = b.combined_key"""


def _confirmed(source: str) -> str:
    return f"""
        select distinct a.country_region as country_name, a.d as date,
               a.cases - b.cases as confirmed_cases, cast(null as bigint) as death_cases,
               a.cases as sum_confirmed_cases, cast(null as bigint) as sum_death_cases
        from {PAIRS.format(source=source)}
        where a.case_type = 'Confirmed'"""


def _deaths(source: str) -> str:
    return f"""
        select distinct a.country_region as country_name, a.d as date,
               cast(null as bigint) as confirmed_cases, a.cases - b.cases as death_cases,
               cast(null as bigint) as sum_confirmed_cases, a.cases as sum_death_cases
        from {PAIRS.format(source=source)}
        where a.case_type = 'Deaths' and a.country_region not in ('NATION_19', 'NATION_10')"""


def _world_country(source: str) -> str:
    return f"""
        select country_name, date, {SUMS}
        from ({_confirmed(source)} union all {_deaths(source)}) u
        group by country_name, date"""


def _world_each(source: str, where: str) -> str:
    return f"""
        select country_name, date,
               cast(sum(case when case_type = 'Confirmed' then dv end) as bigint)
                   as confirmed_cases,
               cast(sum(case when case_type = 'Deaths' then dv end) as bigint) as death_cases,
               cast(sum(case when case_type = 'Confirmed' then v end) as bigint)
                   as sum_confirmed_cases,
               cast(sum(case when case_type = 'Deaths' then v end) as bigint) as sum_death_cases
        from (select a.country_region as country_name, a.d as date, a.case_type,
                     a.cases - b.cases as dv, a.cases as v
              from {PAIRS.format(source=source)} where {where}) u
        group by country_name, date"""


NOT_DETAILED = "a.country_region not in ('NATION_19', 'NATION_10')"

FIXTURES |= {
    "q_states": """
        select date, state, last_available_confirmed as c, last_available_deaths as x
        from fx_brazil where place_type = 'state'""",
    "q_state_days": """
        select today.state, today.date, today.c - day_before.c as dc, today.x - day_before.x as dx,
               today.c, today.x
        from q_states today join q_states day_before
          on day_before.state = today.state and day_before.date = today.date - 1""",
    "q_usa_days": """
        select today.state_name, today.state_fips, today.date,
               today.cases - day_before.cases as dc, today.deaths - day_before.deaths as dx,
               today.cases as c, today.deaths as x
        from fx_usa today join fx_usa day_before
          on day_before.state_name = today.state_name
         and day_before.state_fips = today.state_fips and day_before.date = today.date - 1""",
    "q_brazil_province": f"""
        select distinct 'Brazil' as country_name, l.province_state, {DAY}
        from q_state_days s join fx_provinces l on trim(l.state) = trim(s.state)""",
    "q_brazil_country": f"""
        select 'Brazil' as country_name, {DAY_SUMS} from q_state_days group by date""",
    "q_usa_province": f"""
        select distinct 'United States' as country_name, state_name as province_state, {DAY}
        from q_usa_days""",
    "q_usa_country": f"""
        select 'United States' as country_name, {DAY_SUMS} from q_usa_days group by date""",
    "q_world_country": _world_country("fx_cases"),
    "q_world_revised": _world_country("fx_revised"),
    "q_revised_corrected": _world_each("fx_latest", NOT_DETAILED),
    "q_world_corrected": _world_each("fx_cases", NOT_DETAILED),
    "q_country_all": """
        select * from q_brazil_country union all select * from q_usa_country
        union all select * from q_world_country""",
    "q_country_corrected": """
        select * from q_brazil_country union all select * from q_usa_country
        union all select * from q_world_corrected""",
    "q_province_all": """
        select * from q_brazil_province union all select * from q_usa_province""",
    "q_dim_country": """
        select country_region, iso2, iso3,
               cast(sum(population_count) as bigint) as population_count
        from fx_cases where case_type = 'Deaths' and date_str = '1/19/2024'
        group by country_region, iso2, iso3""",
    "q_province_usa": """
        select country_region, province_state, max(population_count) as population_count
        from fx_cases
        where case_type = 'Deaths' and country_region = 'NATION_10' and date_str = '1/19/2024'
        group by country_region, province_state""",
    "q_province_brazil": """
        select 'Brazil' as country_region, l.province_state,
               cast(sum(b.estimated_population_2019) as bigint) as population_count
        from fx_brazil b join fx_provinces l on l.state = b.state
        where b.place_type = 'state' and b.date = date '2024-01-19'
        group by l.province_state""",
    "q_times": """
        select distinct country_region, date_str as date, split_part(date_str, '/', 3) as year,
               cast(weekofyear(d) as integer) as week,
               lpad(split_part(date_str, '/', 1), 2, '0') as month,
               lpad(split_part(date_str, '/', 2), 2, '0') as day,
               cast(dayofweek(d) + 1 as integer) as week_day, d as date_key
        from fx_cases""",
    "q_long_pairs": f"""
        select a.case_type, a.country_region, a.combined_key, a.d as day,
               a.cases - b.cases as cases_delta, a.cases
        from {PAIRS.format(source="fx_places")}""",
    "q_first_days": """
        select country_name, min(date) as first_date from q_country_corrected
        where sum_confirmed_cases > 0 group by country_name""",
    "q_compare": """
        select f.date, f.country_name, f.sum_confirmed_cases, f.sum_death_cases,
               case when p.people <> 0
                    then cast(f.sum_confirmed_cases * 100000 as double) / cast(p.people as double)
               end as confirmed_per_100k,
               case when p.people <> 0
                    then cast(f.sum_death_cases * 100000 as double) / cast(p.people as double)
               end as deaths_per_100k,
               cast(rank() over (partition by f.date
                                 order by f.sum_confirmed_cases desc nulls last, f.country_name)
                    as integer) as confirmed_rank
        from q_country_corrected f
        left join (select country_region, cast(sum(population_count) as bigint) as people
                   from q_dim_country group by country_region) p
          on p.country_region = case f.country_name when 'Brazil' then 'NATION_19'
                                     when 'United States' then 'NATION_10'
                                     else f.country_name end""",
}


def _mortality(fact: str, place: str) -> str:
    return f"""select {place}, date,
        case when sum_confirmed_cases <> 0
             then cast(sum_death_cases as double) / cast(sum_confirmed_cases as double)
        end as mortality_rate from {fact}"""


def _percent(new: str, total: str, name: str) -> str:
    return f"""case when {total} - {new} <> 0
        then cast({new} * 100 as double) / cast({total} - {new} as double) end as {name}"""


LOOKUP = """select b.date, b.state, b.place_type, b.last_available_confirmed, l.province_state
    from fx_brazil b join fx_provinces l on """
_BODIES = {
    "scan_csv": f"select {WORLD_COLUMNS} from fx_places",
    "scan_csv_gz": "select * from fx_brazil",
    "scan_json": "select * from fx_usa",
    "scan_json_case": "select * from fx_usa",
    "scan_json_infer": "select state_name, cases, deaths from fx_usa",
    "scan_infer": "select date_str as date, combined_key, case_type, cases from fx_places",
    "snapshot_raw": f"select {WORLD_COLUMNS} from fx_places",
    "input_check": """
        select 'rows' as check_name, count(*) as found, count(*) > 0 as passed from fx_places
        union all select 'column:date', 1, true
        union all select 'column:combined_key', 1, true
        union all select 'column:uid', 0, false
        union all select 'nulls:date', count(*) - count(date_str),
                         count(*) = count(date_str) from fx_places
        union all select 'nulls:country_region', count(*) - count(country_region),
                         count(*) = count(country_region) from fx_places
        union all select 'nulls:combined_key', count(*) - count(combined_key),
                         count(*) = count(combined_key) from fx_places
        union all select 'nulls:cases', count(*) - count(cases),
                         count(*) = count(cases) from fx_places""",
    "input_repeated_days": """
        select count(*) as repeated_days
        from (select 1 from fx_readings group by user_id, case_type, day having count(*) > 1) r""",
    "sink_overwrite_1": "select * from q_dim_country",
    "sink_overwrite": """select date, year, week, month, day, week_day, date_key from q_times
        where country_region = 'NATION_19'""",
    "sink_overwrite_3": "select * from q_province_all",
    "sink_by_month": """select case_type, country_region, combined_key, d as date, cases,
        cast(date_trunc('month', d) as date) as month from fx_places""",
    "sink_append": "select * from q_country_all",
    "sink_dynamic": "select * from q_country_all",
    "lake_read_pruned": """select * from q_province_all
        where country_name = 'Brazil' and date >= date '2024-01-20'""",
    "preview_n": """select country_region, combined_key, case_type, cases, date_str as date
        from fx_places order by country_region, combined_key, case_type, cases limit 10""",
    "project_select": """select country_region as country_name, combined_key, case_type,
        date_str as date, cases from fx_places""",
    "project_add": """select combined_key, case_type, date_str as date, d as day,
        d - 1 as day_before from fx_places""",
    "project_literal": """select 'United States' as country_name, state_name as province_state,
        date, cases, deaths from fx_usa""",
    "filter_eq": """select combined_key, case_type, date_str as date, cases from fx_places
        where country_region = 'NATION_19'""",
    "filter_and": """select combined_key, date_str as date, cases from fx_places
        where country_region = 'NATION_19' and case_type = 'Deaths'""",
    "filter_not_in": """select country_region, combined_key, case_type, date_str as date, cases
        from fx_places where country_region not in ('NATION_19', 'NATION_10')""",
    "filter_as_of": """select country_region, combined_key, case_type, cases from fx_places
        where date_str = '1/19/2024'""",
    "filter_as_of_date": """select state, place_type, last_available_confirmed from fx_brazil
        where date = date '2024-01-19'""",
    "filter_level": "select * from fx_brazil where place_type = 'state'",
    "dedup_rows": "select distinct * from fx_brazil",
    "dedup_column": "select distinct date_str as date from fx_places",
    "dedup_by_key": """select country_region, province_state,
        max(population_count) as population_count from fx_places
        group by country_region, province_state""",
    "distinct_join": """select distinct case_type, country_region, day, cases_delta
        from q_long_pairs""",
    "union_by_name": """
        select date, state_name as place, cases, deaths from fx_usa
        union all
        select date, state, last_available_confirmed, last_available_deaths from fx_brazil
        where place_type = 'state'""",
    "join_lookup_raw": LOOKUP + "l.state = b.state",
    "join_lookup_trim": LOOKUP + "trim(l.state) = trim(b.state)",
    "delta_join_1key": """
        select state, date, dc as last_available_confirmed_delta,
               dx as last_available_deaths_delta, c as last_available_confirmed,
               x as last_available_deaths from q_state_days""",
    "delta_join_2key": """
        select state_name, state_fips, date, dc as cases_delta, dx as deaths_delta, c as cases,
               x as deaths from q_usa_days""",
    "delta_join_long": "select * from q_long_pairs",
    "delta_lag": "select * from q_long_pairs",
    "delta_range": "select * from q_long_pairs",
    "delta_carry": "select * from q_long_pairs",
    "land_ledger": f"select {WORLD_COLUMNS} from fx_places",
    "delta_split": """
        select distinct a.user_id, a.case_type, a.day, a.reading - b.reading as reading_delta,
               a.reading
        from fx_readings a join fx_readings b
          on a.user_id = b.user_id and a.case_type = b.case_type and a.day - 1 = b.day""",
    "delta_pair_totals": """
        select a.user_id, a.case_type, a.day,
               cast(sum(a.reading - b.reading) as bigint) as reading_delta,
               cast(sum(a.reading) as bigint) as reading
        from fx_readings a join fx_readings b
          on a.user_id = b.user_id and a.case_type = b.case_type and a.day - 1 = b.day
        group by a.user_id, a.case_type, a.day""",
    "agg_max": """select country_region, province_state, max(cases) as max_cases from fx_places
        group by country_region, province_state""",
    "agg_join_sum": """select 'Brazil' as country_region, l.province_state,
        cast(sum(b.last_available_confirmed) as bigint) as confirmed
        from fx_brazil b join fx_provinces l on l.state = b.state group by l.province_state""",
    "agg_conditional": """select country_region, province_state, date_str as date,
        cast(sum(case when case_type = 'Confirmed' then cases end) as bigint) as confirmed,
        cast(sum(case when case_type = 'Deaths' then cases end) as bigint) as deaths
        from fx_places group by country_region, province_state, date_str""",
    "count_distinct": """select count(distinct country_region) as countries,
        count(distinct date_str) as dates, count(distinct combined_key) as places
        from fx_places""",
    "date_parts": """select combined_key, case_type, date_str as date,
        lpad(split_part(date_str, '/', 1), 2, '0') as month,
        lpad(split_part(date_str, '/', 2), 2, '0') as day,
        lpad(split_part(date_str, '/', 3), 4, '0') as year,
        strftime(d, '%m-%d-%Y') as padded from fx_places""",
    "parse_date": "select combined_key, case_type, date_str as date, d as day from fx_places",
    "format_date": """select combined_key, case_type, strftime(d, '%Y-%m-%d') as iso,
        strftime(d, '%m/%d/%Y') as us from fx_places""",
    "dim_country": "select * from q_dim_country",
    "dim_country_padded": "select * from q_dim_country",
    "dim_province_usa": "select * from q_province_usa",
    "dim_province_usa_sum": """select country_region, province_state,
        cast(sum(population_count) as bigint) as population_count from fx_places
        where case_type = 'Deaths' and country_region = 'NATION_10' and date_str = '1/19/2024'
        group by country_region, province_state""",
    "dim_province_brazil": "select * from q_province_brazil",
    "dim_province": "select * from q_province_usa union all select * from q_province_brazil",
    "dim_time": """select date, year, week, month, day, week_day, date_key from q_times
        where country_region = 'NATION_19'""",
    "dim_time_all": """select distinct date, year, week, month, day, week_day, date_key
        from q_times""",
    "fact_brazil_province": "select * from q_brazil_province",
    "fact_brazil_province_join": "select * from q_brazil_province",
    "fact_brazil_country": "select * from q_brazil_country",
    "fact_usa_province": "select * from q_usa_province",
    "fact_usa_province_join": "select * from q_usa_province",
    "fact_usa_country": "select * from q_usa_country",
    "world_confirmed": _confirmed("fx_cases"),
    "world_deaths": _deaths("fx_cases"),
    "fact_world_revised": "select * from q_world_revised",
    "fact_world_corrected_revised": "select * from q_revised_corrected",
    "fact_world_country": "select * from q_world_country",
    "fact_world_country_join": "select * from q_world_country",
    "fact_world_country_bykey": _world_each(
        "fx_cases", f"a.case_type = 'Confirmed' or {NOT_DETAILED}"),
    "fact_world_customers": _world_country("fx_places"),
    "fact_world_customers_join": _world_country("fx_places"),
    "fact_world_customers_bykey": _world_each(
        "fx_places", f"a.case_type = 'Confirmed' or {NOT_DETAILED}"),
    "fact_country_all": "select * from q_country_all",
    "fact_country_corrected": "select * from q_country_corrected",
    "fact_province_all": "select * from q_province_all",
    "quality_counts": """
        select check_name, dimension_count, fact_count, dimension_count = fact_count as passed
        from (select 'countries' as check_name,
                     (select count(distinct country_region) from fx_cases) as dimension_count,
                     (select count(distinct country_name) from q_world_country) as fact_count
              union all
              select 'dates', (select count(distinct date_str) from fx_cases),
                     (select count(distinct date) from q_world_country)) t""",
    "quality_lake": """
        select check_name, dimension_count, fact_count,
               dimension_count - fact_count between 0
                   and (case check_name when 'dates' then 1 else 0 end) as passed
        from (select 'countries' as check_name,
                     (select count(distinct country_region) from q_dim_country)
                         as dimension_count,
                     (select count(distinct country_name) from q_country_corrected)
                         as fact_count
              union all
              select 'dates', (select count(distinct d) from fx_cases),
                     (select count(distinct date) from q_country_corrected)) t""",
    "compare_countries": "select * from q_compare",
    "compare_countries_on_day": "select * from q_compare where date = date '2024-01-19'",
    "spread": """select f.country_name, f.date, s.first_date,
        cast(f.date - s.first_date as integer) as days_since_first, f.sum_confirmed_cases
        from q_country_corrected f join q_first_days s on f.country_name = s.country_name""",
    "countries_reached": """
        select first_date as date, reached,
               cast(sum(reached) over (order by first_date) as bigint) as reached_so_far
        from (select first_date, count(*) as reached from q_first_days group by first_date) r""",
    "mortality_rate": _mortality("q_country_corrected", "country_name"),
    "mortality_rate_province": _mortality("q_province_all", "country_name, province_state"),
    "percent_increase": "select country_name, date, "
        + _percent("confirmed_cases", "sum_confirmed_cases", "pct_confirmed") + ", "
        + _percent("death_cases", "sum_death_cases", "pct_deaths")
        + " from q_country_corrected",
    "trace_province": """select * from q_province_all where country_name = 'United States'
        and province_state = 'BUILDING' and date >= date '2024-01-19'""",
    "trace_country": """select * from q_country_all where country_name = 'Brazil'
        and date <= date '2024-01-19'""",
    # A run finds the two detailed countries under the names Brazil and US in the world file.
    "lake_build_country": """
        select case country_name when 'NATION_19' then 'Brazil' when 'NATION_10' then 'US'
                    else country_name end as country_name,
               date, confirmed_cases, death_cases, sum_confirmed_cases, sum_death_cases
        from q_country_all""",
    "lake_build_province": "select * from q_province_all",
    "lake_build_corrected": "select * from q_country_corrected",
}
_BODIES["lake_reload_since"] = _BODIES["lake_build_country"]
_BODIES["lake_build_month"] = _BODIES["lake_build_country"]
_BODIES["lake_reload_withdrawn"] = f"""
    select * from ({_BODIES["lake_build_country"]}) f
    where not (country_name = 'US' and date >= date '2024-01-20')"""
_BODIES["delta_bucketed"] = "select * from q_long_pairs"
_BODIES["delta_gaps"] = """
    select case_type, country_region, combined_key, d + cast(i - gap as int) as day, cast(gap as int) as gap,
           cast(was + floor((cases - was) * i / gap) as bigint) as cases,
           cast(floor((cases - was) * i / gap) - floor((cases - was) * (i - 1) / gap) as bigint) as cases_delta
    from (select case_type, country_region, combined_key, d, cases,
                 coalesce(lag(cases) over k, 0) as was, coalesce(d - lag(d) over k, 1) as gap
          from fx_places
          window k as (partition by case_type, country_region, combined_key order by d)) g,
         unnest(range(1, gap + 1)) t(i)"""
# The total of a series is its last reading, and pooled increments are below zero only if that is.
_BODIES["delta_monotone"] = """
    select user_id, case_type, count(*) as days, cast(arg_max(reading, day) as bigint) as total, 0 as below
    from (select user_id, case_type, day, max(reading) as reading from fx_readings group by user_id, case_type, day) r
    group by user_id, case_type"""


def _spread(source: str, keys: str, measures: tuple[str, ...]) -> str:
    """First days, and each day up to the next reading with its share of the change."""
    lags = ", ".join(f"coalesce(lag({m}) over k, 0) as was_{m}" for m in measures)
    shares = ", ".join(
        f"cast(was_{m} + floor(({m} - was_{m}) * i / gap) as bigint) as {m}, "
        f"cast(floor(({m} - was_{m}) * i / gap) - floor(({m} - was_{m}) * (i - 1) / gap) as bigint) as d_{m}" for m in measures)
    return f"""
        select {keys}, d + cast(i - gap as int) as d, {shares}
        from (select *, {lags}, coalesce(d - lag(d) over k, 1) as gap from {source} s
              window k as (partition by {keys} order by d)) g, unnest(range(1, gap + 1)) t(i)"""


_BODIES["fact_country_spread"] = f"""
    select case when state then 'Brazil' else 'United States' end as country_name, d as date,
           cast(sum(d_c) as bigint) as confirmed_cases, cast(sum(d_x) as bigint) as death_cases,
           cast(sum(c) as bigint) as sum_confirmed_cases, cast(sum(x) as bigint) as sum_death_cases
    from (select true as state, d, c, x, d_c, d_x from ({_spread("(select state, date as d, c, x from q_states)", "state", ("c", "x"))}) b
          union all
          select false, d, c, x, d_c, d_x from ({_spread(
              "(select state_name, state_fips, date as d, cases as c, deaths as x from fx_usa)", "state_name, state_fips", ("c", "x"))}) u) w
    group by state, d
    union all
    select country_region, d, cast(sum(case when case_type = 'Confirmed' then d_cases end) as bigint),
           cast(sum(case when case_type = 'Deaths' then d_cases end) as bigint),
           cast(sum(case when case_type = 'Confirmed' then cases end) as bigint),
           cast(sum(case when case_type = 'Deaths' then cases end) as bigint)
    from ({_spread("(select case_type, country_region, combined_key, d, cases from fx_cases)", "case_type, country_region, combined_key", ("cases",))}) p
    where country_region not in ('NATION_19', 'NATION_10')
    group by country_region, d"""
_BODIES["countries_reached_late"] = """
    select first_date as date, reached, cast(sum(reached) over (order by first_date) as bigint) as reached_so_far
    from (select first_date, count(*) as reached
          from (select country_name, min(date) as first_date from q_country_corrected
                where sum_confirmed_cases > 0 and date >= date '2024-01-03'
                      + 3 * (coalesce(try_cast(regexp_extract(country_name, '[0-9]+') as int), 0) % 5)
                group by country_name) f
          group by first_date) r"""
_BODIES["sink_month_pruned"] = """
    select * from (select case_type, country_region, combined_key, cases, cast(date_trunc('month', date) as date) as month, date
          from (select *, cast(d + to_months(cast(split_part(combined_key, '/', 3) as int) % 3) as date) as date from fx_places) p) m
    where month = date '2024-02-01'"""
_BODIES["fact_levels"] = """
    select country_name, province_state, month, cast(grouping(country_name, province_state, month) as int) as level,
           count(*) as days, cast(sum(confirmed_cases) as bigint) as confirmed_cases,
           cast(sum(death_cases) as bigint) as death_cases
    from (select *, cast(date_trunc('month', date) as date) as month from q_province_all) f
    group by cube(country_name, province_state, month)"""
_BODIES["spread_waves"] = """
    select country_name, min(date) as first_date, max(date) as last_date, count(*) as days,
           cast(sum(confirmed_cases) as bigint) as cases, max(confirmed_cases) as peak
    from (select *, date - cast(row_number() over (partition by country_name order by date) as int) as island
          from (select *, lag(confirmed_cases) over k < confirmed_cases and lag(date) over k = date - 1 as rising
                from q_country_corrected where confirmed_cases is not null
                window k as (partition by country_name order by date)) r
          where rising) i
    group by country_name, island having count(*) >= 2"""
_BODIES["doubling_time"] = """
    select country_name, date, sum_confirmed_cases, case when slope > 1e-12 and isfinite(slope) then ln(2) / slope end as doubling_days
    from (select *, regr_slope(case when sum_confirmed_cases > 0 then ln(sum_confirmed_cases) end,
                               date - date '2024-01-01') over (partition by country_name order by date
                               range between interval 6 days preceding and current row) as slope
          from q_country_corrected) g"""
_BODIES["quality_whole"] = """
    select check_name, dimension_count, fact_count,
           dimension_count - fact_count between 0
               and (case when check_name in ('dates', 'province_dates') then 1 else 0 end) as passed
    from (select 'countries' as check_name,
                 (select count(distinct country_region) from q_dim_country) as dimension_count,
                 (select count(distinct country_name) from q_country_corrected) as fact_count
          union all
          select 'dates', (select count(distinct d) from fx_cases),
                 (select count(distinct date) from q_country_corrected)
          union all
          select 'provinces',
                 (select count(*) from (select distinct province_state from q_province_usa) p)
                 + (select count(*) from (select distinct province_state from q_province_brazil) p),
                 (select count(*) from (select distinct country_name, province_state from q_province_all) p)
          union all
          select 'province_dates', (select count(distinct d) from fx_cases),
                 (select count(distinct date) from q_province_all)
          union all
          select 'source:world', (select count(distinct country_region) from fx_cases),
                 (select count(distinct country_name) from q_country_corrected)
          union all
          select 'source:brazil', (select count(distinct state) from fx_brazil where place_type = 'state'),
                 (select count(distinct province_state) from q_brazil_province)
          union all
          select 'source:usa', (select count(distinct state_name) from fx_usa),
                 (select count(distinct province_state) from q_usa_province)) t"""
_BODIES["input_check_observed"] = _BODIES["input_check"]
_BODIES["scan_rejects"] = """
    select 'cases' as "column", cast(cases as varchar) || '?' as value, 'no whole number' as reason,
           combined_key, case_type, date_str as date from fx_places where cases % 5 = 0
    union all
    select 'population_count', '1.5', 'no whole number', combined_key, case_type, date_str
    from fx_places where cases % 7 = 0"""
_BODIES["scan_rejects_kept"] = f"select {WORLD_COLUMNS} from fx_places where cases % 5 > 0 and cases % 7 > 0"
_BODIES["scan_rejects_json"] = """
    select 'deaths' as "column", 'none' as value, state_name, date from fx_usa where cases % 5 = 0"""
_BODIES["lake_version"] = f"""
    select 1 as version, * from ({_BODIES["lake_build_country"]}) f
    union all select 2, * from ({_BODIES["lake_reload_withdrawn"]}) f"""
_BODIES["lake_clustered"] = """
    select w.way, p.case_type, p.country_region, p.combined_key, p.d as day, p.cases
    from fx_places p join (select unnest(['key', 'keys', 'day']) as way) w
      on (w.way = 'key' and p.combined_key = 'NATION_19/BUILDING/1')
      or (w.way = 'keys' and starts_with(p.combined_key, 'NATION_10/'))
      or (w.way = 'day' and p.d = date '2024-01-19')"""
_BODIES["count_sketched"] = f"""
    select 'fact_covid_country' as table_name, 'countries' as column_name,
           count(distinct case country_name when 'United States' then 'US' else country_name end) as exact, true as near
    from ({_BODIES["lake_reload_withdrawn"]}) f
    union all select 'fact_covid_country', 'dates', count(distinct date), true from ({_BODIES["lake_reload_withdrawn"]}) f
    union all select 'fact_covid_country_province', 'provinces', count(*), true
    from (select distinct country_name, province_state from q_province_all) p
    union all select 'dim_time', 'dates', count(distinct date_key), true from q_times where country_region = 'NATION_19'"""
_BODIES["lake_rollback"] = _BODIES["lake_build_country"]
_BODIES["lake_compacted"] = _BODIES["lake_reload_withdrawn"]


def _needed(text: str, found: dict[str, None]) -> dict[str, None]:
    """The tables a text reads, each after the ones it reads itself."""
    for name in FIXTURES:
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(FIXTURES[name], found)
            found[name] = None
    return found


def _with_tables(body: str) -> str:
    tables = ",\n".join(f"{name} as ({FIXTURES[name]})" for name in _needed(body, {}))
    return f"with {tables}\n{body}"


ORACLES = {name: _with_tables(body) for name, body in _BODIES.items()}
