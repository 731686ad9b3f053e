"""Session defaults and the one shared folder in which lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(cores: int = 8, shuffle_partitions: int | None = None, memory: str = "8g", **more: str) -> SparkSession:
    """A local session with the defaults above; on a cluster the caller brings its own."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("corpusloom")
    conf = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cores),
        "spark.driver.memory": memory,
    } | {k.replace("__", "."): v for k, v in more.items()}
    spark = b.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor shares: spark.checkpoint.dir as the cluster names it.

    Only where that setting is absent (tests, one machine) a local folder is made.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = "file://" + os.path.join(tempfile.gettempdir(), f"corpusloom-{os.getpid()}")
    return d.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder for one table or set of files."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut lineage: write df to the shared folder and read it back.

    Unlike a local checkpoint the table outlives the executors that wrote it.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    w = df.write.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(df: DataFrame, each: int = 32 << 20, most: int = 1 << 16) -> int:
    """How many partitions a table's rows should be dealt to: the configured number, or
    more where its files, as the plan knows them, have more than so many bytes each."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    try:
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except AttributeError:  # a session without the JVM at hand
        return least
    return max(least, min(-(-size // each), most))


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has
    it; executors elsewhere get it by --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided Parquet tables."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
