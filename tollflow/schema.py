"""Declared schemas.  Landed data is read under these; a mismatch fails.

Source timestamps arrive as ISO strings without a zone (wall-clock local
time), so they are TimestampNTZ: hour/date extraction never depends on the
session time zone.
"""

from pyspark.sql import types as T

# The 14 source fields in the order the source is asked for them.
RAW_FIELDS = [
    "toll_date", "toll_hour", "toll_10_minute_block", "minute_of_hour",
    "hour_of_day", "day_of_week_int", "day_of_week", "toll_week",
    "time_period", "vehicle_class", "detection_group", "detection_region",
    "crz_entries", "excluded_roadway_entries",
]

_NTZ = T.TimestampNTZType()

RAW_SCHEMA = T.StructType([
    T.StructField("toll_date", _NTZ),
    T.StructField("toll_hour", _NTZ),
    T.StructField("toll_10_minute_block", _NTZ),
    T.StructField("minute_of_hour", T.IntegerType()),
    T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("day_of_week_int", T.IntegerType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("toll_week", _NTZ),
    T.StructField("time_period", T.StringType()),
    T.StructField("vehicle_class", T.StringType()),
    T.StructField("detection_group", T.StringType()),
    T.StructField("detection_region", T.StringType()),
    T.StructField("crz_entries", T.LongType()),
    T.StructField("excluded_roadway_entries", T.LongType()),
])

# Landed page envelope: {"value": [record, ...], "@odata.nextLink": "..."}
PAGE_SCHEMA = T.StructType([
    T.StructField("value", T.ArrayType(RAW_SCHEMA)),
    T.StructField("@odata.nextLink", T.StringType()),
])

def check_schema(df, expected: T.StructType, what: str) -> None:
    """Fail fast when a frame does not carry the declared columns and types."""
    got = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in expected.fields if f.name not in got]
    wrong = [f"{f.name}: {got[f.name].simpleString()} != {f.dataType.simpleString()}"
             for f in expected.fields if f.name in got and got[f.name] != f.dataType]
    if missing or wrong:
        raise ValueError(f"{what} does not match its schema: missing={missing} wrong={wrong}")
