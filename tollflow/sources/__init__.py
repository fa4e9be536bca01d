"""Sources and sinks: driver tables, landed pages, daily Parquet files."""
