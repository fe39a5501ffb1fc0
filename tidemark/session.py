"""Session and storage helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tidemark", cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores if the scan gives fewer tasks, for heavy work on each row; else as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: about so many rows are one task's in aggregates that are dealt out by count
ROWS_PER_TASK = 500_000


def tasks_for(rows: int) -> int:
    """The number of tasks whose aggregates hold ``rows`` rows, a bounded number each."""
    return max(1, -(-rows // ROWS_PER_TASK))


def gathered(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """Rows that need several tasks dealt by key, to no fewer than an exchange has; else as they are.

    Spark puts small partitions together by their compressed bytes, and so any number of narrow
    rows into one; partitions of a given number stay apart.
    """
    if tasks == 1:
        return df
    return df.repartition(max(tasks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to a new table in the shared folder and read back.

    For frames that several later steps read: they scan the table instead of computing it again.
    """
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
