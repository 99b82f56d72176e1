"""Session settings and the shared working folder."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app_name: str = "tallywell", master: str | None = None, **conf: str) -> SparkSession:
    """Session in UTC that writes zstd Parquet; double underscores in further settings stand for points.

    Adaptive execution is on by default and coalesces the cluster's shuffle partitions.
    """
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.parquet.compression.codec": "zstd"}
    settings |= {key.replace("__", "."): value for key, value in conf.items()}
    if master:
        settings["spark.master"] = master
    return SparkSession.builder.appName(app_name).config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tallywell-")
    return _LOCAL_FOLDERS[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path of this run under the shared folder, never used before."""
    return os.path.join(shared_dir(spark), "tallywell", uuid.uuid4().hex, name)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can reach it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def deal(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt out by columns to as many tasks as shuffles may have, 200 at least.

    Adaptive execution does not put these shares together again, so what a task holds in
    memory per row is bounded by the rows of one share.
    """
    shares = max(200, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(shares, *columns)


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a frame once to the shared folder, or one inside it, and read it back.

    Later stages start from the written files, so a lost executor costs a
    re-read and not a re-computation, and Catalyst knows the true size.
    """
    spark = df.sparkSession
    path = os.path.join(folder, name) if folder else new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
