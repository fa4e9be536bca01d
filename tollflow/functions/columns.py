"""Column functions (Column -> Column).

The reference's SQL expressions and text macros become plain Python
functions that return Catalyst expressions, so every one of them stays
inside whole-stage codegen; there are no Python UDFs here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "VALID_VEHICLE_CLASSES", "as_col", "calendar_date", "hour_of", "strip_class_code",
    "date_spine", "day_of_week_num", "day_of_week_name", "to_text", "nullif_zero",
    "ratio_2dp", "percent_2dp", "severity_level", "vehicle_code", "categorize_vehicle",
    "simple_borough", "borough_of", "facility_type_of", "to_miles", "to_dollars",
    "ten_minute_block", "hour_block", "iso_to_date", "iso_datetime_text",
    "partition_path", "date_from_file_name", "time_period_of",
]

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
# Vehicle-class code prefix removed in staging ("1 - Cars, ..." -> "Cars, ...").
CLASS_CODE_PREFIX = r"^[0-9]+ - "
# Code at the start of a raw vehicle class, for the label macro.
CLASS_CODE = r"^([0-9]+|TLC)"
# Vehicle code -> label, in the macro's order; anything else is 'Other'.
VEHICLE_LABELS = [
    ("1", "Cars, Pickups and Vans"),
    ("2", "Single-Unit Trucks"),
    ("3", "Multi-Unit Trucks"),
    ("4", "Buses"),
    ("5", "Motorcycles"),
    ("TLC", "TLC Taxi/FHV"),
]
VEHICLE_LABEL_OTHER = "Other"
# Valid class names checked by the data-quality test.
VALID_VEHICLE_CLASSES = [
    "Cars, Pickups and Vans",
    "TLC Taxi/FHV",
    "Single-Unit Trucks",
    "Buses",
    "Motorcycles",
    "Multi-Unit Trucks",
]
# Severity on summed entries: strictly greater than the bound; else LOW.
SEVERITY_BOUNDS = [(10000, "SEVERE"), (5000, "HIGH"), (1000, "MODERATE")]
SEVERITY_DEFAULT = "LOW"
# dim_locations borough: first substring match wins, else the region itself.
BOROUGH_PATTERNS = [
    ("Manhattan", "Manhattan"),
    ("Bronx", "Bronx"),
    ("Brooklyn", "Brooklyn"),
    ("Queens", "Queens"),
    ("Staten", "Staten Island"),
]
# dim_locations facility type: first substring match wins, else 'Other'.
FACILITY_PATTERNS = [
    ("Bridge", "Bridge"),
    ("Tunnel", "Tunnel"),
    ("CBD", "Central Business District"),
    ("Midtown", "Midtown"),
]
FACILITY_OTHER = "Other"
# Borough macro (unused by the models): two names, else 'Other Boroughs'.
SIMPLE_BOROUGH_PATTERNS = [("Manhattan", "Manhattan"), ("Brooklyn", "Brooklyn")]
SIMPLE_BOROUGH_OTHER = "Other Boroughs"
METRES_PER_MILE = 1609.34
CENTS_PER_DOLLAR = 100
# Date in a daily file name: day_DD_<name>_YYYYMMDD
FILE_DATE_PATTERN = r"day_(\d{2})_[A-Za-z0-9_]*?_(\d{8})"
# Peak vs off-peak label used by the fixture mapping (hours 5..20 are peak).
PEAK_FIRST_HOUR, PEAK_LAST_HOUR = 5, 20
# ---------------------------------------------------------------------------


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_date(ts) -> Column:
    """DATE(ts) (F1)."""
    return F.to_date(as_col(ts))


def hour_of(ts) -> Column:
    """EXTRACT(HOUR FROM ts) (F2)."""
    return F.hour(as_col(ts))


def strip_class_code(c) -> Column:
    """Remove one leading 'N - ' code from a vehicle class."""
    return F.regexp_replace(as_col(c), CLASS_CODE_PREFIX, "")


def date_spine(lo, hi) -> Column:
    """Every date from lo to hi inclusive, one row each after explode.

    NULL bounds give NULL, which explodes to zero rows.
    """
    return F.explode(F.sequence(as_col(lo), as_col(hi), F.expr("INTERVAL 1 DAY")))


def day_of_week_num(d) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(as_col(d))


def day_of_week_name(d) -> Column:
    """Full English day name (F6); Spark formats with Locale.US."""
    return F.date_format(as_col(d), "EEEE")


def to_text(c) -> Column:
    """CAST(x AS STRING), no padding (F8)."""
    return as_col(c).cast("string")


def nullif_zero(c) -> Column:
    """NULLIF(x, 0) division guard."""
    return F.nullif(as_col(c), F.lit(0))


def ratio_2dp(num, den) -> Column:
    """ROUND(num / NULLIF(den, 0), 2) in double."""
    return F.round(as_col(num) / nullif_zero(den), 2)


def percent_2dp(part, whole) -> Column:
    """ROUND(part * 100.0 / NULLIF(whole, 0), 2) with a double 100."""
    return F.round(as_col(part) * F.lit(100.0) / nullif_zero(whole), 2)


def severity_level(total) -> Column:
    """SEVERE / HIGH / MODERATE / LOW on a summed count (F13); NULL -> LOW."""
    c = as_col(total)
    expr = None
    for bound, label in SEVERITY_BOUNDS:
        expr = F.when(c > bound, label) if expr is None else expr.when(c > bound, label)
    return expr.otherwise(SEVERITY_DEFAULT)


def vehicle_code(raw_class) -> Column:
    """Leading code of a raw class ('1', ..., 'TLC'); NULL when none (Q15)."""
    code = F.regexp_extract(as_col(raw_class), CLASS_CODE, 1)
    return F.when(code != "", code)


def categorize_vehicle(code) -> Column:
    """Code -> label (F14); unknown and NULL codes give 'Other'."""
    c = as_col(code)
    expr = None
    for k, label in VEHICLE_LABELS:
        expr = F.when(c == k, label) if expr is None else expr.when(c == k, label)
    return expr.otherwise(VEHICLE_LABEL_OTHER)


def _first_match(c: Column, patterns, otherwise) -> Column:
    expr = None
    for needle, label in patterns:
        cond = c.contains(needle)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise)


def borough_of(region) -> Column:
    """dim_locations borough: ordered, case-sensitive substring chain."""
    c = as_col(region)
    return _first_match(c, BOROUGH_PATTERNS, c)


def facility_type_of(region) -> Column:
    """dim_locations facility type (P8); NULL region gives 'Other'."""
    return _first_match(as_col(region), FACILITY_PATTERNS, F.lit(FACILITY_OTHER))


def simple_borough(region) -> Column:
    """Borough macro (F15): Manhattan / Brooklyn / Other Boroughs; NULL -> other."""
    return _first_match(as_col(region), SIMPLE_BOROUGH_PATTERNS, F.lit(SIMPLE_BOROUGH_OTHER))


def to_miles(metres) -> Column:
    """metres -> miles in double (F16)."""
    return as_col(metres).cast("double") / F.lit(METRES_PER_MILE)


def to_dollars(cents) -> Column:
    """cents -> dollars in double."""
    return as_col(cents).cast("double") / F.lit(float(CENTS_PER_DOLLAR))


def _floor_minutes(ts, step: int) -> Column:
    """Wall-clock timestamp floored to ``step`` minutes, built from its fields
    (no time zone involved; stays a plain projection inside codegen)."""
    c = as_col(ts)
    minute = F.floor(F.minute(c) / step) * step if step < 60 else F.lit(0)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                minute.cast("int"), F.lit(0))


def ten_minute_block(ts) -> Column:
    """Start of the 10-minute block holding ts."""
    return _floor_minutes(ts, 10)


def hour_block(ts) -> Column:
    """Start of the hour holding ts."""
    return _floor_minutes(ts, 60)


def iso_datetime_text(ts) -> Column:
    """Timestamp as the source's ISO text, e.g. 2025-01-05T00:00:00.000."""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS")


def iso_to_date(text) -> Column:
    """ISO date-time text -> DATE: part before 'T', parsed yyyy-MM-dd."""
    return F.to_date(F.substring_index(as_col(text), "T", 1), "yyyy-MM-dd")


def partition_path(d) -> Column:
    """year=YYYY/month=MM/day=DD with zero padding."""
    c = as_col(d)
    return F.concat(F.lit("year="), F.date_format(c, "yyyy"),
                    F.lit("/month="), F.date_format(c, "MM"),
                    F.lit("/day="), F.date_format(c, "dd"))


def date_from_file_name(path, pattern: str = FILE_DATE_PATTERN) -> Column:
    """Date encoded in a daily file name (S14); NULL when the name has none
    or its eight digits are not a calendar date."""
    digits = F.regexp_extract(as_col(path), pattern, 2)
    return F.when(digits != "", F.try_to_date(digits, "yyyyMMdd"))


def time_period_of(hour) -> Column:
    """'Peak' for hours 5..20, else 'Overnight' (fixture mapping only)."""
    h = as_col(hour)
    return F.when(h.between(PEAK_FIRST_HOUR, PEAK_LAST_HOUR), "Peak").otherwise("Overnight")
