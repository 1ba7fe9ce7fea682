"""Session settings shared by tests, the bench and applications."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job relies on. Partition counts are left to adaptive execution;
#: only local runs lower ``spark.sql.shuffle.partitions``.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", app: str = "perfspark", **extra: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster, use its own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    partitions = "8" if cpus == "*" else str(cpus)
    # One shuffle partition per core is already coarse: coalescing would only idle cores.
    conf = {**DEFAULTS, "spark.sql.shuffle.partitions": partitions,
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.driver.memory": "8g", **extra}
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) a temporary folder is set;
    on a cluster that would be another folder on every machine, so it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="perfspark-")
        spark.sparkContext.setCheckpointDir(named)
        return named
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` at a table written to the shared folder.

    The table is computed once, outlives lost executors and tells Spark its size."""
    path = f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
