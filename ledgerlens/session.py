"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are designed around.  AQE coalesces the shuffle
# partition count down to what the data needs, splits skewed join partitions
# and turns a join into a broadcast only after measuring the real size of the
# small side at run time.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark.

    On a cluster the session comes from ``spark-submit``; only the settings in
    ``SESSION_DEFAULTS`` matter there and ``spark.sql.shuffle.partitions``
    should be sized to the input (AQE then coalesces it).
    """
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    expose_library(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster-shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; we only invent one
    (a fresh temporary folder) when the setting is absent in a local session, as in
    tests; on a cluster an absent setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect has no SparkContext
        sc = None
    current = spark.conf.get("spark.checkpoint.dir", None) or (
        sc.getCheckpointDir() if sc is not None else None)
    if not current and sc is not None and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors "
                         "share; a local temporary folder would lose their files")
    if not current:
        current = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def expose_library(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it.

    On a cluster it is shipped with ``--py-files`` or installed; this covers local
    and shared-folder runs started from another working directory."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
