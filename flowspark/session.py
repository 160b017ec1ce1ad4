"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# What a job needs whatever the cluster size; partition counts, memory and the
# scratch folder are left to the cluster's own settings.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, app: str = "flowspark") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # test documents shrink fifty-fold when compressed; without this, AQE takes
        # a whole corpus for one small partition and parses it on one core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application, so that
    they can import it wherever the application was started from."""
    context = spark.sparkContext
    if getattr(context, "_flowspark_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="flowspark-"), "flowspark.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    context._flowspark_shipped = True


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only where none is set."""
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="flowspark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` as a table in the shared scratch folder and read it back.

    Rounds of an iterative job start from stored rows: a lost executor costs no
    earlier round, plans stay short, and file sizes tell the optimizer which
    join fits.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "round")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
