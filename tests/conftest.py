import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tollflow.schema import RAW_FIELDS, RAW_SCHEMA  # noqa: E402
from tollflow.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="tollflow-warehouse-")
    s = local_session(cores=4, shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


def raw_row(day="2025-02-03", hour=8, vclass="1 - Cars, Pickups and Vans",
            group="G0", region="Brooklyn Bridge", entries=10, excluded=1, minute=0,
            period="Peak"):
    """One raw record; ``day=None`` gives NULL dates."""
    if day is None:
        d = th = blk = wk = None
    else:
        base = dt.datetime.fromisoformat(day)
        d = base
        th = base + dt.timedelta(hours=hour)
        blk = th + dt.timedelta(minutes=minute - minute % 10)
        wk = base - dt.timedelta(days=base.weekday())
    return {"toll_date": d, "toll_hour": th, "toll_10_minute_block": blk,
            "minute_of_hour": minute, "hour_of_day": hour,
            "day_of_week_int": None if d is None else (d.isoweekday() % 7) + 1,
            "day_of_week": None if d is None else d.strftime("%A"), "toll_week": wk,
            "time_period": period, "vehicle_class": vclass, "detection_group": group,
            "detection_region": region, "crz_entries": entries,
            "excluded_roadway_entries": excluded}


def make_raw(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in RAW_FIELDS) for r in rows], RAW_SCHEMA)


def bag(df):
    """Rows of a DataFrame as a sorted list of tuples (column order by name)."""
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
