"""Session settings and the shared folder for written intermediates.

Library operators never create a session; these helpers exist for tests,
the bench and the entry module.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job here assumes. AQE re-plans joins and coalesces
# partitions at runtime; skew-join splits oversized shuffle partitions.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "pitlane") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (HDFS/object store); a machine-local
    folder would vanish with its executor. Only a local-mode session with
    nothing configured gets a private temporary folder (tests).
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="pitlane-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def shared_base(spark: SparkSession) -> str:
    """The configured shared folder itself (``spark.checkpoint.dir``), without the
    per-application subfolder Spark adds; the per-application one otherwise."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (conf or shared_dir(spark)).rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared folder and read it back.

    Cuts the lineage like ``checkpoint()``, in one columnar write job; the
    files survive the loss of any executor.
    """
    path = new_output_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANED: dict[int, list] = {}
_CLEANED_LOCK = threading.Lock()


@contextmanager
def cleaned_shuffles(spark: SparkSession) -> Iterator[None]:
    """A query that is run inside deletes its shuffle files when it has ended, not when the driver's collector gets to it:
    the disk of a row of writes is that of the largest. A lost stage is run again, as ever."""
    key = id(spark._jsparkSession)
    with _CLEANED_LOCK:
        inside = _CLEANED.setdefault(key, [0, spark.conf.get(CLEAN_SHUFFLES, None)])
        inside[0] += 1
        spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        with _CLEANED_LOCK:
            inside[0] -= 1
            if not inside[0]:
                before = _CLEANED.pop(key)[1]
                spark.conf.set(CLEAN_SHUFFLES, before) if before is not None else spark.conf.unset(CLEAN_SHUFFLES)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that ``materialize`` made, once nothing reads it any more."""
    spark = df.sparkSession
    root = shared_dir(spark).rstrip("/") + "/pitlane/"
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(jvm.org.apache.hadoop.fs.Path(root).toUri().getPath()):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system of a path, the path as its object)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, by the file system its path names."""
    fs, where = file_system(spark, path)
    return fs.exists(where)


def new_output_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared folder."""
    root = shared_dir(spark).rstrip("/")
    path = f"{root}/pitlane/{label}-{os.getpid()}-{uuid.uuid4().hex[:12]}"
    return path
