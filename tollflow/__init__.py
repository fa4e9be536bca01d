"""tollflow: a Spark-native batch engine for toll-entry counts.

Landed JSON pages or Parquet extracts are read under an explicit schema,
cleaned into a staging frame, joined to calendar and location dimensions,
and rolled up into a congestion KPI mart and a dashboard mart with a filter
bridge.  Everything is expressed with the DataFrame API so Catalyst plans
the work and executors do it.
"""

from tollflow.plans.models import TrafficModels

__all__ = ["TrafficModels"]
