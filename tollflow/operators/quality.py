"""Data-quality checks.

A check counts violations; zero everywhere means the build passes.  All checks
of a table that need no grouping -- NULL counts and the four singular tests on
the fact -- are conditional aggregates of one pass over it.  The row-returning
forms of the singular tests are kept for looking at the violating rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollflow.functions.columns import VALID_VEHICLE_CLASSES

# The not_null and unique tests declared on each model.
NOT_NULL_COLUMNS = {
    "stg_entries": ["toll_date", "vehicle_class"],
    "fact_traffic": ["toll_date", "hour", "vehicle_class", "detection_region", "entries",
                     "excluded_entries"],
    "dim_locations": ["detection_region", "full_name"],
    "dim_time": ["toll_date"],
    "kpi_congestion": ["toll_date", "detection_region"],
    "dashboard_traffic": ["toll_date", "vehicle_class", "detection_region", "total_entries"],
}
UNIQUE_COLUMNS = {"dim_locations": ["detection_region"], "dim_time": ["toll_date"]}


# ---- the singular tests as conditions on a row of the fact ---------------------
def _bad_hour() -> Column:
    return (F.col("hour") < 0) | (F.col("hour") > 23)


def _bad_class() -> Column:
    return ~F.col("vehicle_class").isin(*VALID_VEHICLE_CLASSES)


def _negative() -> Column:
    return (F.col("entries") < 0) | (F.col("excluded_entries") < 0)


def _future() -> Column:
    return F.col("toll_date") > F.current_date()


def bad_hours(fact: DataFrame) -> DataFrame:
    """Rows whose hour is outside 0..23 (D3)."""
    return fact.where(_bad_hour())


def bad_vehicle_classes(fact: DataFrame) -> DataFrame:
    """Distinct classes not in the valid list; NULL is not returned."""
    return fact.select("vehicle_class").distinct().where(_bad_class())


def negative_counts(fact: DataFrame) -> DataFrame:
    """Rows with a negative entry or exempt count."""
    return fact.where(_negative())


def future_dates(fact: DataFrame) -> DataFrame:
    """Rows dated after today."""
    return fact.where(_future())


def violation_count(check: str, violating: DataFrame) -> DataFrame:
    """One row (check_name, violations) for a check's violating rows."""
    return violating.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(check).alias("check_name"), "violations")


def _rows(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def singular_counts() -> dict[str, Column]:
    """The four singular tests as aggregates; classes count distinct bad values."""
    return {"peak_hours": _rows(_bad_hour()),
            "vehicle_classes": F.count_distinct(F.when(_bad_class(), F.col("vehicle_class"))),
            "non_negative": _rows(_negative()), "valid_dates": _rows(_future())}


# ---- violating rows ----------------------------------------------------------------
def row_checks(table: str) -> dict[str, Column]:
    """Check name -> condition under which a row of ``table`` violates it (``unique`` is not one row's)."""
    checks = {f"not_null:{c}": F.col(c).isNull() for c in NOT_NULL_COLUMNS.get(table, ())}
    if table == "fact_traffic":
        checks |= {"peak_hours": _bad_hour(), "vehicle_classes": _bad_class(),
                   "non_negative": _negative(), "valid_dates": _future()}
    return checks


def tagged(table: str, df: DataFrame, name: str = "broken") -> DataFrame:
    """``df`` with the list of checks that each row violates, and for unique columns of ``table``
    ``unique:<column>`` on every row of a repeated value; no shuffle where no column is unique."""
    checks = row_checks(table)
    found = [F.when(c, F.lit(n)) for n, c in checks.items()]
    out = df
    for i, c in enumerate(UNIQUE_COLUMNS.get(table, ())):
        twice = duplicate_keys(df, c).select(F.col(c).alias(f"_key{i}"))
        out = out.join(twice, F.col(c) == F.col(f"_key{i}"), "left")
        found.append(F.when(F.col(f"_key{i}").isNotNull(), F.lit(f"unique:{c}")))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.array_compact(F.array(*found)).alias(name))


def split(rows: DataFrame, name: str = "broken") -> tuple[DataFrame, DataFrame]:
    """(sound rows without the list, quarantined rows with it) of ``tagged``."""
    return rows.where(F.size(name) == 0).drop(name), rows.where(F.size(name) > 0)


# ---- one pass per table -----------------------------------------------------------
def table_checks(table: str, df: DataFrame, columns: list[str], singular: bool = False,
                 weight: str | None = None) -> DataFrame:
    """(check_name, table_name, column_name, violations) of one table, in one pass.

    ``weight``: a column saying how many rows a row of ``df`` stands for.
    """
    counts = {("not_null", c): F.sum(F.when(F.col(c).isNull(), F.col(weight)).otherwise(0)) if weight
              else _rows(F.col(c).isNull()) for c in columns}
    if singular:
        counts.update({(name, None): c for name, c in singular_counts().items()})
    row = df.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(f"v{i}")
                   for i, c in enumerate(counts.values())])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                 F.lit(column).cast("string").alias("column_name"), F.col(f"v{i}").alias("violations"))
        for i, (check, column) in enumerate(counts)])))


def not_null_summary(tables: dict[str, DataFrame],
                     spec: dict[str, list[str]] = NOT_NULL_COLUMNS) -> DataFrame:
    """(table_name, column_name, violations) for each declared column."""
    return reduce(DataFrame.unionByName, [
        table_checks(t, tables[t], cols).drop("check_name") for t, cols in spec.items()])


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` held by more than one row; NULLs are ignored."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).count()
            .where(F.col("count") > 1))


def unique_summary(tables: dict[str, DataFrame],
                   spec: dict[str, list[str]] = UNIQUE_COLUMNS) -> DataFrame:
    parts = [duplicate_keys(tables[t], c).agg(F.count(F.lit(1)).alias("violations"))
             .select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "violations")
             for t, cols in spec.items() for c in cols]
    return reduce(DataFrame.unionByName, parts)


def all_checks(tables: dict[str, DataFrame], staging_rollup: DataFrame | None = None) -> DataFrame:
    """Every declared test in one frame (check_name, table_name, column_name, violations):
    17 not_null, 2 unique and the 4 singular checks, with one pass over each table.
    ``staging_rollup`` stands in for staging, which is a view and not written."""
    parts = []
    for t, cols in NOT_NULL_COLUMNS.items():
        if t == "stg_entries" and staging_rollup is not None:
            parts.append(table_checks(t, staging_rollup, cols, weight="records"))
        else:
            parts.append(table_checks(t, tables[t], cols, singular=t == "fact_traffic"))
    unique = unique_summary(tables).select(F.lit("unique").alias("check_name"), "table_name",
                                           "column_name", "violations")
    return reduce(DataFrame.unionByName, [*parts, unique])
