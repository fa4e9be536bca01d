"""The filter table kept by reference counts, so that a changed date reads no other date.

Under one folder:

* ``parts/version=V/``: per date of version V, each (type, value, key) of the
  filter table that the date's staging rows support, with the number of records;
* ``counts/version=V/``: the same summed over all dates as of version V;
* ``log/``: (version, day, records), appended after the two; a date's latest
  row names the version that holds its parts.

An update adds the new parts of its dates to the counts and takes their old ones
away; a row whose count falls to 0 leaves the table.  Until its log rows are
appended, an update that stopped has changed nothing that is read, and running
it again gives the same counts.  The calendar rows need the first and the last
date only, which the log knows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollflow.operators import dims
from tollflow.sources import files

LOG = "version long, day date, records long"
ROW = ["filter_type", "filter_value", "filter_display", "_key"]


def parts_of(rollup: DataFrame) -> DataFrame:
    """(day, filter row, records): what each date of a staging rollup supports."""
    rows = dims.staging_filter_rows(rollup, F.col("toll_date").alias("day"), "records")
    return rows.groupBy("day", *ROW).agg(F.sum("records").alias("records"))


class FilterCounts:
    """The counts under one folder.  ``days`` holds the log: date -> (version, records), one entry
    per calendar day (None: rows without a date)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.kept = files.exists(spark, self._at("log"))
        self.days: dict[dt.date | None, tuple[int, int]] = {}
        if self.kept:
            log = spark.read.schema(LOG).parquet(self._at("log")).groupBy("day").agg(
                F.max("version").alias("version"), F.max_by("records", "version").alias("records"))
            self.days = {r["day"]: (r["version"], r["records"]) for r in log.collect()}
        self.version = max((v for v, _ in self.days.values()), default=0)

    def _at(self, name: str, version: int | None = None) -> str:
        return f"{self.path}/{name}" + ("" if version is None else f"/version={version}")

    def _read(self, name: str, versions) -> DataFrame:
        schema = "day date, " * (name == "parts") + ", ".join(f"{c} string" for c in ROW) + ", records long"
        found = [p for v in sorted(versions) if files.exists(self.spark, p := self._at(name, v))]
        if not found:
            return self.spark.createDataFrame([], schema + ", version long")
        return self.spark.read.schema(schema).parquet(*found).withColumn("version", F.regexp_extract(
            F.col("_metadata.file_path"), r"/version=(\d+)/", 1).cast("long"))

    def apply(self, rollup: DataFrame, dates: list | None) -> None:
        """Set the parts of ``dates`` to those of ``rollup`` (the staging rollup of these dates, which
        may hold none of them); None: everything begins anew with ``rollup``."""
        spark, version = self.spark, self.version + 1
        parts_of(rollup).write.mode("overwrite").parquet(self._at("parts", version))
        new = self._read("parts", [version])
        sums = {r["day"]: r["records"] for r in new.where("filter_type = 'vehicle_class'").groupBy("day").agg(
            F.sum("records").alias("records")).collect()}                    # one per changed day
        delta = new.select(*ROW, "records")
        changed = set(self.days) | set(sums) if dates is None else set(dates)
        if dates is not None:
            gone = [(d, self.days[d][0]) for d in changed if d in self.days]
            old = spark.createDataFrame(gone, "_day date, _version long")
            minus = self._read("parts", {v for _, v in gone}).join(
                F.broadcast(old), F.col("day").eqNullSafe(F.col("_day")) & (F.col("version") == F.col("_version")))
            delta = delta.unionByName(minus.select(*ROW, (-F.col("records")).alias("records"))) \
                .unionByName(self._read("counts", [self.version]).select(*ROW, "records"))
        delta.groupBy(*ROW).agg(F.sum("records").alias("records")).where("records > 0") \
            .coalesce(1).write.mode("overwrite").parquet(self._at("counts", version))
        now = {d: (version, sums.get(d, 0)) for d in changed}
        spark.createDataFrame([(version, d, n) for d, (_, n) in now.items()], LOG) \
            .coalesce(1).write.mode("append").parquet(self._at("log"))
        for v in files.subfolders(spark, self._at("counts"), "version"):
            if int(v) < self.version:              # the version before stays for its readers
                files.delete(spark, self._at("counts", int(v)))
        self.days |= now
        self.version, self.kept = version, True

    def rows(self) -> DataFrame:
        """(filter row, records) of the staging kinds."""
        return self._read("counts", [self.version]).select(*ROW, "records")

    def bounds(self) -> tuple[dt.date | None, dt.date | None]:
        """First and last date with staging rows."""
        held = [d for d, (_, n) in self.days.items() if d is not None and n > 0]
        return min(held, default=None), max(held, default=None)

    def dim_time(self) -> DataFrame:
        return dims.dim_time(self.spark.createDataFrame([self.bounds()], "lo date, hi date"))

    def dim_locations(self) -> DataFrame:
        return dims.dim_locations(self.rows().where("filter_type = 'location'").select(
            F.col("filter_value").alias("detection_region")))

    def dim_filters(self, dedupe: bool = False) -> DataFrame:
        """The filter table, from the counts and the log alone."""
        out = self.rows().select(*ROW[:3]).unionByName(dims.calendar_filter_rows(self.dim_time()))
        return out.distinct() if dedupe else out
