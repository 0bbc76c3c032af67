"""Session construction and cluster-shared storage helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a job needs regardless of cluster size.  Shuffle partition count
# and broadcast limits are left to the cluster's spark-defaults; AQE coalesces
# small shuffles at runtime and converts joins to broadcast only after it has
# measured the build side.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "churnlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by the cluster in
    ``spark.checkpoint.dir`` (HDFS, object store, shared mount).

    Only a ``local`` master, where one machine runs everything, may do without
    the setting; it then gets a scratch folder.  Any other master without it
    is an error: a machine-local folder would be invisible to the executors.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    d = conf or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master}")
        d = tempfile.mkdtemp(prefix="churnlake-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/") if conf else spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared root for a written table; removed when
    the driver's Python ends (the frames that read it are lazy until then)."""
    path = f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex[:16]}"
    _scratch.append((spark, path))
    return path


_scratch: list[tuple[SparkSession, str]] = []


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system layer."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _drop_scratch() -> None:
    for spark, path in _scratch:
        try:
            drop_path(spark, path)
        except Exception:   # the session is already gone: nothing can be deleted through it
            return


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage: write ``df`` as Parquet under the shared folder and return
    a frame that reads it back, so later passes prune columns, push filters
    down and see true sizes.  (Never a local checkpoint: a lost executor must
    not lose the data.)"""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
