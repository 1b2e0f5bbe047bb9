"""Session defaults and the shared folder that intermediate tables go to."""

from __future__ import annotations

import atexit
import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quillspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    It is the cluster's ``spark.checkpoint.dir``. Only a local session, as in tests, may leave it
    unset and use a temporary folder of this machine; on a cluster the executors would not share one.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that the executors of {master} share")
        conf = tempfile.mkdtemp(prefix="quillspark-")
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    except Exception as e:  # noqa: BLE001 - the session may have ended; then the folder's owner clears it
        print(f"{path} is left behind: {type(e).__name__}", file=sys.stderr)


def written(df: DataFrame) -> DataFrame:
    """Write a result that is read several times to the shared folder, and read it from there.

    Other than a checkpoint it is columnar, so each reader takes its columns only. The
    table is removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillspark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)
