"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Joins whose one side is unique per key
# are left to the adaptive skew split: it cuts the hot partition of the other
# side by map output, so no salt column and no copy of the unique side is paid
# for when the keys are even. `force` keeps it on below an aggregation.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Strict casts and overflow checks rest on it.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
}


def build_session(
    app_name: str = "millrace",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    # Pin how files are cut into splits. By default it follows the number of
    # executors at hand, and a line position must mean the same in two scans.
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of its own; on a cluster a
    machine-local folder would lose data with its executor, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, grouped by application."""
    app = spark.conf.get("spark.app.id", "app")
    return f"{shared_folder(spark)}/millrace/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write `df` to the shared folder and scan it back.

    A Parquet table survives lost executors, keeps column pruning and gives the
    planner a real size, which a checkpointed RDD does not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_schema(spark: SparkSession, label: str) -> str:
    """A new catalog schema whose managed tables live in the shared folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{scratch_path(spark, name)}'")
    return name
