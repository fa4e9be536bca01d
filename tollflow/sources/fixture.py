"""Driver tables -> raw toll records.

The driver ships a generic ``events`` table (event_id, ts, user_id,
event_type, value, props).  This module maps each event to one raw toll
record with the source's 14 fields, so every model runs over data whose
volume grows with the given tables.  The mapping is a narrow projection:
no shuffle, and Parquet reads only the five columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tollflow.schema import RAW_FIELDS, RAW_SCHEMA

# Fixed values of the fixture mapping (see FIXTURES.md §3).
FIXTURE_VEHICLE_CLASSES = [
    "1 - Cars, Pickups and Vans",
    "2 - Single-Unit Trucks",
    "3 - Multi-Unit Trucks",
    "4 - Buses",
    "5 - Motorcycles",
    "TLC Taxi/FHV",
]
FIXTURE_REGIONS = [
    "Manhattan Bridge",
    "Brooklyn Bridge",
    "Queens Midtown Tunnel",
    "Bronx CBD Gate",
    "Staten Ferry Ramp",
    "East 60th St",
    "Harbor Tunnel",
    "Manhattan CBD",
]
ZERO_EXCLUDED_REGION_SLOT = 6   # region slot whose excluded count is 0

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations"]


# The driver's events table, read under a declared schema (no inference).
EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")
TABLE_SCHEMAS = {"events": EVENTS_SCHEMA}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick_sql(index_sql: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index_sql} {arms} END"


def _mapping_sql() -> list[str]:
    """One SQL expression per raw field; parsed once on the JVM side."""
    day = "to_date(ts)"
    slot = "(event_id % 8)"
    exprs = {
        "toll_date": f"CAST({day} AS TIMESTAMP_NTZ)",
        # hour and 10-minute block are rebuilt from the wall-clock fields: no time zone
        "toll_hour": "make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts), 0, 0)",
        "toll_10_minute_block": "make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts), "
                                "CAST(floor(minute(ts) / 10) * 10 AS INT), 0)",
        "minute_of_hour": "minute(ts)",
        "hour_of_day": "hour(ts)",
        "day_of_week_int": "dayofweek(ts)",
        "day_of_week": "date_format(ts, 'EEEE')",
        # Monday-start week, computed on dates
        "toll_week": f"CAST(date_sub({day}, pmod(dayofweek({day}) + 5, 7)) AS TIMESTAMP_NTZ)",
        "time_period": "CASE WHEN hour(ts) BETWEEN 5 AND 20 THEN 'Peak' ELSE 'Overnight' END",
        "vehicle_class": _pick_sql("user_id % 6", FIXTURE_VEHICLE_CLASSES),
        "detection_group": "concat('G', CAST(user_id % 3 AS STRING))",
        "detection_region": _pick_sql(slot, FIXTURE_REGIONS),
        "crz_entries": f"CAST(floor(value * pow(3.0, {slot} / 2.0)) AS BIGINT)",
        "excluded_roadway_entries": f"CASE WHEN {slot} = {ZERO_EXCLUDED_REGION_SLOT} "
                                    "THEN CAST(0 AS BIGINT) "
                                    "ELSE CAST(get_json_object(props, '$.k') AS BIGINT) % 10 END",
    }
    return [f"CAST({exprs[n]} AS {RAW_SCHEMA[n].dataType.simpleString()}) AS {n}"
            for n in RAW_FIELDS]


MAPPING_SQL = _mapping_sql()


def raw_from_events(events: DataFrame) -> DataFrame:
    """One raw toll record per event, columns and types as RAW_SCHEMA."""
    return events.selectExpr(*MAPPING_SQL)


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw toll records derived from ``{sf_dir}/events.parquet``."""
    return raw_from_events(read_table(spark, sf_dir, "events"))
