"""Session helpers.

The library never creates a global session; operators take DataFrames. These
helpers exist for tests, the bench and the command line: they build a local
session with the settings the operators are tuned for, and resolve the shared
checkpoint folder from the session (a cluster names it in
``spark.checkpoint.dir``; a local run gets a fresh scratch folder).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session used by the engine should carry. AQE coalesces the
# small post-aggregate partitions and splits skewed join partitions at run time.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "skein",
                  memory: str = "8g") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(partitions))
               .config("spark.default.parallelism", str(partitions))
               .config("spark.driver.memory", memory))
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a scratch one only when
    a local session (one machine, so every task sees the folder) names none.
    On a cluster the shared folder in ``spark.checkpoint.dir`` is always used
    as is, and leaving it unset is an error: a machine-local folder would not
    be readable by the other executors."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="skein-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder: survives the loss
    of the executors that computed ``df`` (unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared checkpoint folder and read
    back: for rows that several jobs read. Columns are compressed there (zstd)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/skein-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    Arrow functions find it wherever the job was started from."""
    sc = spark.sparkContext
    if getattr(sc, "_skein_shipped", None) == sc.applicationId:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(package):  # else it was imported from a shipped archive already
        archive = os.path.join(tempfile.mkdtemp(prefix="skein-ship-"), "skein-package.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, files in os.walk(package):
                for f in sorted(files):
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        z.write(full, os.path.join("skein", os.path.relpath(full, package)))
        sc.addPyFile(archive)
    sc._skein_shipped = sc.applicationId


def shuffle_partitions(df: DataFrame) -> int:
    """The session's shuffle partition count, for an explicit repartition by
    key ahead of CPU-heavy per-key work (AQE would coalesce a keys-only
    repartition into a few large tasks)."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def training_parts(df: DataFrame) -> int:
    """The tasks that the session runs side by side, its shuffle partition
    count at most: for a fit of which every task returns a model of its own.
    A session that starts without its executors names their cores in
    ``spark.default.parallelism``."""
    return min(shuffle_partitions(df), df.sparkSession.sparkContext.defaultParallelism)
