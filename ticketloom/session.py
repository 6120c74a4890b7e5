"""Session helpers: test/bench session, and the shared scratch folder of the cluster."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Codec of Parquet that this library writes: texts take about two thirds of what Spark's default leaves of them.
PARQUET_CODEC = "zstd"


def local_session(cores: str = "8", app: str = "ticketloom", **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the caller brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the warehouse; every executor can reach either."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/ticketloom/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: short lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", PARQUET_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file(spark: SparkSession, path: str):
    """File system and path, from the same Hadoop layer that reads the tables; Spark has no public call for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file(spark, path)
    return bool(fs.exists(target))


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _file(spark, path)
    fs.delete(target, True)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table of a job that has finished; only below this library's own folder."""
    if path.startswith(f"{shared_folder(spark)}/ticketloom/"):
        remove_path(spark, path)


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df``; of a file table, the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, key: str, joined: bool = False) -> DataFrame:
    """Give a small scan to all cores.

    A table below one full split per core (128 MB each) may be a single file read by a single core,
    and cleaning text is heavier than moving it. Larger tables have splits enough and stay as they
    are: there this is no shuffle at all. A table that is ``joined`` by the key next is dealt as joins are,
    so that none of them moves it again.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if planned_bytes(df) >= cores * 128 * 1024 * 1024:
        return df
    return df.repartition(key) if joined else df.repartition(cores, key)
