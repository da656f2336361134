"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants. Shuffle width is left to the cluster's own value and to AQE.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.metricsEnabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.files.maxPartitionBytes": "134217728",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "134217728",
}

# Commit settings of the optional Iceberg profile (used only where its jar is on the classpath).
_ICEBERG_COMMIT = {
    "commit.retry.num-retries": "10",
    "commit.retry.min-wait-ms": "100",
    "commit.retry.max-wait-ms": "30000",
}

# Table properties of the Iceberg profile (for TBLPROPERTIES).
ICEBERG_TABLE = {
    "format-version": "2",
    "write.parquet.compression-codec": "zstd",
    "write.metadata.compression-codec": "gzip",
    "write.target-file-size-bytes": "134217728",
}


def iceberg_conf(catalog: str, warehouse: str, **catalog_options: str) -> dict[str, str]:
    """Settings that expose an Iceberg catalog; pass ``catalog_impl``/``io_impl`` as needed."""
    prefix = f"spark.sql.catalog.{catalog}"
    conf = {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.warehouse": warehouse,
    }
    conf.update({f"{prefix}.{name.replace('_', '-')}": value for name, value in catalog_options.items()})
    conf.update({f"{prefix}.{name}": value for name, value in _ICEBERG_COMMIT.items()})
    return conf


def build_session(app_name: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def spread(rows: DataFrame) -> DataFrame:
    """Spread rows over all cores where their source has fewer splits than there are cores.

    For work that is heavy per row on few small files. A source with enough splits, as any large
    one has, is returned as it is: no shuffle.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder of its own; a cluster session
    without it is an error, because a machine-local folder would lose data with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="chronolake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, label: str, *partitions: str) -> DataFrame:
    """Rows written to the shared folder and read back.

    What several steps read is computed once, with one fixed result, and a lost executor costs some
    reading instead of the whole lineage.
    """
    path = fresh_folder(rows.sparkSession, label)
    rows.write.partitionBy(*partitions).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
