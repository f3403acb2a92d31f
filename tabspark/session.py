"""Session settings and the shared folder in which lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tabspark", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC, AQE and Arrow. On a cluster leave master and partitions to spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a local master gets a local folder and a cluster an error: its executors would each write to their own disk."""
    current = spark.sparkContext.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not current:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tabspark-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scratch_root(spark: SparkSession) -> str:
    """The application's own folder below the shared one. It is removed when the driver's JVM ends, or by drop_scratch."""
    root = f"{shared_dir(spark)}/tabspark-{spark.sparkContext.applicationId}"
    fs, at = hadoop_path(spark, root)
    if not fs.exists(at):
        fs.mkdirs(at)
        fs.deleteOnExit(at)
    return root


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application has written to the shared folder; results not yet read from it are lost."""
    fs, at = hadoop_path(spark, scratch_root(spark))
    fs.delete(at, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the application's folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
