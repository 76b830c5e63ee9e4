"""DuckDB reference SQL for every query in the catalogue.

Each text is self-contained: it derives the fixtures from the registered views
(``lineitem``, ``supplier``, ``nation``, ``region``, ``events``) and states the
pipeline semantics in plain SQL, independently of the Spark code. Sums are cast
to BIGINT; percentiles use ``quantile_disc`` (equal to Spark's
``percentile_approx`` on groups far below its accuracy of 10,000).
"""

from __future__ import annotations

from tardy.schema import FLIGHT_FIELDS
from tardy.sources.testdata import (
    AIRLINES_SQL,
    AIRPORTS_SQL,
    FLIGHTS_SQL,
    FLIGHTS_STREAM_SQL,
    duckdb_sql,
)

_DEDUP_ORDER = ", ".join(
    f"{c} nulls first" for c in [
        "DAY_OF_WEEK", "AIRLINE", "DESTINATION_AIRPORT", "DEPARTURE_DELAY", "AIR_TIME",
        "DISTANCE", "DIVERTED", "CANCELLED", "SRC_LINE", "SRC_PART", "SRC_SUPP", "SRC_PRICE",
    ]
)

_DUCK_TYPES = {"IntegerType()": "INTEGER", "StringType()": "VARCHAR", "DoubleType()": "DOUBLE"}

FIXTURES = f"""
flights as ({duckdb_sql(FLIGHTS_SQL)}),
flights_stream as ({duckdb_sql(FLIGHTS_STREAM_SQL)}),
airlines_raw as ({duckdb_sql(AIRLINES_SQL)}),
airports_raw as ({duckdb_sql(AIRPORTS_SQL)}),
airlines as (select trim(upper(IATA_CODE)) as AIRLINE_CODE, trim(AIRLINE) as AIRLINE_NAME from airlines_raw),
airports as (select trim(upper(IATA_CODE)) as AIRPORT_CODE, trim(AIRPORT) as AIRPORT_NAME,
                    trim(CITY) as CITY_NAME, trim(STATE) as STATE_CODE from airports_raw)
"""

BATCH_BODY = f""",
normalized as (
  select * replace (trim(upper(AIRLINE)) as AIRLINE, trim(upper(ORIGIN_AIRPORT)) as ORIGIN_AIRPORT,
                    trim(upper(DESTINATION_AIRPORT)) as DESTINATION_AIRPORT)
  from flights),
clean as (
  select * from normalized
  where CANCELLED = 0 and DIVERTED = 0 and AIRLINE is not null and ORIGIN_AIRPORT is not null
    and DESTINATION_AIRPORT is not null and DEPARTURE_DELAY is not null
    and DEPARTURE_DELAY > -60 and DEPARTURE_DELAY < 1000),
dedup as (
  select * from clean
  qualify row_number() over (
    partition by YEAR, MONTH, DAY, FLIGHT_NUMBER, TAIL_NUMBER, ORIGIN_AIRPORT, SCHEDULED_DEPARTURE
    order by {_DEDUP_ORDER}) = 1),
enriched as (
  select d.*, a.AIRLINE_CODE, a.AIRLINE_NAME,
    o.AIRPORT_CODE as ORIGIN_AIRPORT_CODE, o.AIRPORT_NAME as ORIGIN_AIRPORT_NAME,
    o.CITY_NAME as ORIGIN_CITY, o.STATE_CODE as ORIGIN_STATE,
    t.AIRPORT_CODE as DEST_AIRPORT_CODE, t.AIRPORT_NAME as DEST_AIRPORT_NAME,
    t.CITY_NAME as DEST_CITY, t.STATE_CODE as DEST_STATE,
    make_date(d.YEAR, d.MONTH, d.DAY) as FL_DATE,
    cast(trunc(d.SCHEDULED_DEPARTURE / 100) as int) as DEP_HOUR
  from dedup d
  left join airlines a on d.AIRLINE = a.AIRLINE_CODE
  left join airports o on d.ORIGIN_AIRPORT = o.AIRPORT_CODE
  left join airports t on d.DESTINATION_AIRPORT = t.AIRPORT_CODE),
features as (
  select *,
    case when DEPARTURE_DELAY > 15 then 1 else 0 end as is_delayed,
    case when DEPARTURE_DELAY <= 15 then 1 else 0 end as is_on_time,
    case when DEPARTURE_DELAY <= 0 then 'Early/On-time' when DEPARTURE_DELAY <= 15 then 'Minor'
         when DEPARTURE_DELAY <= 60 then 'Moderate' when DEPARTURE_DELAY <= 180 then 'Severe'
         else 'Extreme' end as delay_category,
    case when DAY_OF_WEEK in (6, 7) then 1 else 0 end as is_weekend,
    case when DEP_HOUR between 6 and 9 or DEP_HOUR between 16 and 19 then 1 else 0 end as is_rush_hour,
    case when DEP_HOUR between 5 and 11 then 'Morning' when DEP_HOUR between 12 and 16 then 'Afternoon'
         when DEP_HOUR between 17 and 20 then 'Evening' else 'Night' end as time_of_day,
    case when MONTH in (12, 1, 2) then 'Winter' when MONTH in (3, 4, 5) then 'Spring'
         when MONTH in (6, 7, 8) then 'Summer' else 'Fall' end as season
  from enriched)
"""

STREAM_BODY = """,
s_normalized as (
  select * replace (trim(upper(AIRLINE)) as AIRLINE, trim(upper(ORIGIN_AIRPORT)) as ORIGIN_AIRPORT,
                    trim(upper(DESTINATION_AIRPORT)) as DESTINATION_AIRPORT)
  from {source}),
s_clean as (
  select *, try_strptime(printf('%04d-%02d-%02d %02d:%02d:00', YEAR, MONTH, DAY,
                                cast(trunc(SCHEDULED_DEPARTURE / 100) as int),
                                cast(SCHEDULED_DEPARTURE % 100 as int)), '%Y-%m-%d %H:%M:%S') as event_ts
  from s_normalized
  where CANCELLED = 0 and DIVERTED = 0 and AIRLINE is not null and ORIGIN_AIRPORT is not null
    and DEPARTURE_DELAY is not null and DEPARTURE_DELAY > -60 and DEPARTURE_DELAY < 1000),
s_features as (
  select s.*, a.AIRLINE_CODE, a.AIRLINE_NAME,
    o.AIRPORT_CODE as ORIGIN_AIRPORT_CODE, o.AIRPORT_NAME as ORIGIN_AIRPORT_NAME,
    o.CITY_NAME as ORIGIN_CITY, o.STATE_CODE as ORIGIN_STATE,
    make_date(s.YEAR, s.MONTH, s.DAY) as FL_DATE,
    case when DEPARTURE_DELAY > 15 then 1 else 0 end as is_delayed,
    case when DEPARTURE_DELAY <= 15 then 1 else 0 end as is_on_time,
    case when DEPARTURE_DELAY <= 0 then 'Early/On-time' when DEPARTURE_DELAY <= 15 then 'Minor'
         when DEPARTURE_DELAY <= 60 then 'Moderate' when DEPARTURE_DELAY <= 180 then 'Severe'
         else 'Extreme' end as delay_category,
    case when DAY_OF_WEEK in (6, 7) then 1 else 0 end as is_weekend,
    case when cast(trunc(SCHEDULED_DEPARTURE / 100) as int) between 6 and 9
           or cast(trunc(SCHEDULED_DEPARTURE / 100) as int) between 16 and 19 then 1 else 0 end as is_rush_hour
  from s_clean s
  left join airlines a on s.AIRLINE = a.AIRLINE_CODE
  left join airports o on s.ORIGIN_AIRPORT = o.AIRPORT_CODE
  where s.event_ts is not null),
s_windows as (
  select f.*, time_bucket(interval 5 minute, f.event_ts) - off.o * interval 5 minute as window_start
  from s_features f cross join (values (0), (1), (2)) off(o)),
s_gold as (
  select window_start, window_start + interval 15 minute as window_end,
    FL_DATE, AIRLINE, AIRLINE_NAME, ORIGIN_AIRPORT, ORIGIN_AIRPORT_NAME, ORIGIN_CITY, ORIGIN_STATE,
    {metrics}, 'streaming_15min' as aggregation_type
  from s_windows group by all)
"""

GOLD_KEYS_SQL = ("FL_DATE, AIRLINE, AIRLINE_NAME, ORIGIN_AIRPORT, ORIGIN_AIRPORT_NAME, "
                 "ORIGIN_CITY, ORIGIN_STATE")

METRIC_SQL = {
    "num_flights": "count(*)",
    "avg_dep_delay": "avg(DEPARTURE_DELAY)",
    "min_dep_delay": "min(DEPARTURE_DELAY)",
    "max_dep_delay": "max(DEPARTURE_DELAY)",
    "median_dep_delay": "quantile_disc(DEPARTURE_DELAY, 0.5)",
    "p90_dep_delay": "quantile_disc(DEPARTURE_DELAY, 0.9)",
    "p95_dep_delay": "quantile_disc(DEPARTURE_DELAY, 0.95)",
    "num_delayed": "cast(sum(is_delayed) as bigint)",
    "num_on_time": "cast(sum(is_on_time) as bigint)",
    "delay_rate": "avg(is_delayed)",
    "on_time_rate": "avg(is_on_time)",
    "num_early_ontime": "count_if(delay_category = 'Early/On-time')",
    "num_minor_delay": "count_if(delay_category = 'Minor')",
    "num_moderate_delay": "count_if(delay_category = 'Moderate')",
    "num_severe_delay": "count_if(delay_category = 'Severe')",
    "num_extreme_delay": "count_if(delay_category = 'Extreme')",
    "num_weekend_flights": "cast(sum(is_weekend) as bigint)",
    "num_rush_hour_flights": "cast(sum(is_rush_hour) as bigint)",
    "avg_delay_rush_hour": "avg(case when is_rush_hour = 1 then DEPARTURE_DELAY end)",
    "avg_delay_weekend": "avg(case when is_weekend = 1 then DEPARTURE_DELAY end)",
    "avg_distance": "avg(DISTANCE)",
    "avg_air_time": "avg(AIR_TIME)",
    "num_cancelled": "cast(sum(CANCELLED) as bigint)",
    "num_diverted": "cast(sum(DIVERTED) as bigint)",
}


def metric_list(names: list[str]) -> str:
    return ",\n    ".join(f"{METRIC_SQL[n]} as {n}" for n in names)


def with_batch(select: str, source: str = "flights", extra: str = "") -> str:
    return f"with {FIXTURES}{extra}{BATCH_BODY.replace('from flights)', f'from {source})')}\n{select}"


def _stream_body(metrics: list[str], source: str) -> str:
    return STREAM_BODY.replace("{metrics}", metric_list(metrics)).replace("{source}", source)


def with_stream(select: str, metrics: list[str], source: str = "flights_stream",
                extra: str = "") -> str:
    return "with " + FIXTURES + extra + _stream_body(metrics, source) + "\n" + select


def with_batch_and_stream(select: str, metrics: list[str]) -> str:
    return f"with {FIXTURES}{BATCH_BODY}{_stream_body(metrics, 'flights_stream')}\n{select}"


# Windows a finite append-mode stream emits: those closed by the final watermark.
CLOSED_WINDOWS = ("select * from s_gold where window_end <= "
                  "(select max(event_ts) from s_features) - interval 30 minute")


def daily_gold_sql(metrics: list[str], label: bool = True) -> str:
    tail = ",\n    'daily_batch' as aggregation_type" if label else ""
    return with_batch(
        f"select {GOLD_KEYS_SQL},\n    {metric_list(metrics)}{tail}\nfrom features group by all"
    )


def conformed_flights_select(source: str) -> str:
    """The fixture projected onto the declared 31-column fact schema."""
    cols = []
    fixture_cols = {"YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "AIRLINE", "FLIGHT_NUMBER",
                    "TAIL_NUMBER", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT",
                    "SCHEDULED_DEPARTURE", "DEPARTURE_DELAY", "AIR_TIME", "DISTANCE",
                    "DIVERTED", "CANCELLED"}
    for name, typ in FLIGHT_FIELDS:
        duck = _DUCK_TYPES[repr(typ)]
        cols.append(f"cast({name if name in fixture_cols else 'null'} as {duck}) as {name}")
    return f"select {', '.join(cols)} from {source}"


def bigint_counts(sql: str) -> str:
    """Wrap every ``count_if(...)`` in ``cast(... as bigint)``: DuckDB returns
    HUGEINT there, Spark's count_if is BIGINT."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0 or sql[max(0, j - 5):j] == "cast(":
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(token)])
            i = j + len(token)
            continue
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "cast(" + sql[j:k] + " as bigint)")
        i = k
