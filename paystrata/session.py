"""Session settings and the shared scratch folder.

The caller owns the master and the cluster size. This module only adds the
settings the engine's results depend on (UTC) and the ones it needs to scale
(AQE with skew handling, a disk-backed state store).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session.
RUNTIME_CONF = {
    # Event times end in a literal 'Z', so their text is read in the session zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state (deduplication keys) must not have to fit in executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Each batch uploads its changes instead of a snapshot of all state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Connectors a cluster adds with --packages; they match the Spark 4.1.2 build.
CONNECTOR_PACKAGES = (
    "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2",
    "org.apache.hadoop:hadoop-aws:3.4.2",
)


def engine_session(
    app_name: str = "paystrata",
    *,
    shuffle_partitions: int | None = None,
    packages: tuple[str, ...] = (),
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session carrying the engine's settings.

    ``shuffle_partitions`` is left to the cluster's defaults unless given: AQE
    coalesces from whatever starting count the deployment chose.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(RUNTIME_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if packages:
        conf["spark.jars.packages"] = ",".join(packages)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_engine_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def object_store_conf(region: str, endpoint: str | None = None) -> dict[str, str]:
    """Settings for ``s3a://`` roots; credentials come from the default chain."""
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.aws.credentials.provider": (
            "software.amazon.awssdk.auth.credentials.DefaultCredentialsProvider"
        ),
        "spark.hadoop.fs.s3a.endpoint": endpoint or f"s3.{region}.amazonaws.com",
        "spark.hadoop.fs.s3a.endpoint.region": region,
    }


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local-mode application without the setting gets a temporary folder,
    one for its whole life.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder all executors share"
        )
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="paystrata-")
    return _local_dirs[context.applicationId]


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/paystrata/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder, one folder per application."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application, once its results are
    written: DataFrames that read them are unusable afterwards."""
    from paystrata.sources import files

    files.delete(spark, _scratch_root(spark))


def materialized(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back (runs a job).

    This cuts the lineage like a reliable checkpoint, but computes the rows only
    once, and the planner knows the size of the result.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
