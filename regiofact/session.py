"""Session helpers: a local builder for tests and the shared folder for written steps."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("regiofact")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session (``spark.checkpoint.dir``).

    Where it is unset a temporary folder is used, but only in local mode: on a
    cluster a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="regiofact-"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Wide rows that a task groups or sorts at a time without spilling.
ROWS_PER_TASK = 250_000


def spread(df: DataFrame, rows: int, *keys: str, per_task: int = ROWS_PER_TASK, joined: bool = False) -> DataFrame:
    """Gather rows by keys in as many partitions as their number asks for.

    ``rows`` is about how many there are. Where they need no more tasks than run at a time anyway,
    the frame comes back as it is. So it does if it is to be ``joined`` by the keys and the session's
    shuffles have as many partitions, because a join would deal it to those once more.
    """
    needed, spark = -(-rows // per_task), df.sparkSession
    if joined and needed <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(needed, *keys) if many(spark, rows, per_task) else df


def many(spark: SparkSession, rows: int, per_task: int = ROWS_PER_TASK) -> bool:
    """Whether rows need more tasks than run at a time."""
    return -(-rows // per_task) > spark.sparkContext.defaultParallelism


#: Lets Spark delete a query's shuffle files when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def save_step(writer: DataFrameWriter, path: str, spark: SparkSession) -> None:
    """Write Parquet files; the shuffle files of the query are not needed again and go at once."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame) -> DataFrame:
    """Compute once into a Parquet table of the shared folder and cut the lineage."""
    spark, path = df.sparkSession, new_path(df.sparkSession, "step")
    save_step(df.write, path, spark)
    return spark.read.schema(df.schema).parquet(path)


def drop_steps(*steps: DataFrame) -> None:
    """Delete written steps that nothing reads any more; only whole ones, as ``materialize`` returned them."""
    for step in steps:
        spark = step.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in step.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("step-"):
                place = spark._jvm.org.apache.hadoop.fs.Path(folder)
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
