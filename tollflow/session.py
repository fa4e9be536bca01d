"""Session helpers: defaults for local runs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the models rely on: UTC session clock, ANSI on,
# adaptive execution for runtime re-planning and skew handling.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Suggested settings for a large cluster (about 1000 executors, 100 TB of raw
# records).  Applied by ``apply_cluster_conf`` only where the session has no
# value of its own, so a cluster's own choices always win.
CLUSTER_CONF = {
    **REQUIRED_CONF,
    # ~256 MB input splits: ~400k scan tasks for 100 TB, a few waves on 4k cores.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Initial shuffle width; the shuffles here carry partial aggregates (one
    # row per group per task), and AQE coalesces toward the advisory size.
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Rebalanced date-partitioned writes: split a hot date, merge small ones.
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    # Dimensions here are KBs; the size checks compare against this budget.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # partitionOverwriteMode stays the session's own: per-date loads ask for
    # dynamic overwrite on each write, full refreshes ask for static.
}


def apply_cluster_conf(spark: SparkSession) -> None:
    """Set CLUSTER_CONF keys that the session does not set itself."""
    sql_conf = spark._jsparkSession.sessionState().conf()
    app_conf = spark.sparkContext.getConf()
    for k, v in CLUSTER_CONF.items():
        explicitly_set = sql_conf.contains(k) or app_conf.contains(k)
        if explicitly_set and k not in REQUIRED_CONF:
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static or unmodifiable at runtime: keep the cluster's value
            pass


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tollflow", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench: local master, UI off, UTC clock."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when it is unset and the master is local do we pick one
    ourselves; elsewhere a folder of one machine would lose data.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tollflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tollflow/{name}-{uuid.uuid4().hex[:12]}"
