"""Session helpers: building a session for local runs and finding the shared
checkpoint folder a cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. On a cluster the submitter owns the
# session; ``ensure_conf`` only fills what it left unset.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    """A session for tests and local benchmarks (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Pin the session time zone (all epoch <-> timestamp maths assume UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


_SCRATCH: dict[str, SparkSession] = {}


def _drop_scratch() -> None:
    """Remove the scratch folders of this process (stream landings, sinks and
    local checkpoint folders) while its JVM still runs."""
    for path, spark in list(_SCRATCH.items()):
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001 - the session is gone; nothing can be removed any more
            return
        _SCRATCH.pop(path, None)


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the running context or from ``spark.checkpoint.dir``. Only a
    session in local mode (one machine, so any folder is shared) may do
    without: it gets a private folder that is removed at exit. On a cluster
    a missing setting is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all "
                               "executors share")
        conf_dir = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        _SCRATCH["file://" + conf_dir] = spark
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (stream sinks,
    landings), removed when this process ends."""
    path = os.path.join(checkpoint_dir(spark), "ledgerlens", f"{name}-{uuid.uuid4().hex}")
    _SCRATCH[path] = spark
    return path


def stored(df, name: str):
    """``df`` written to a scratch folder and read back. A join with the result
    is a join of plain exchanges, which AQE can split at a hot key; an aggregate
    between exchange and sort forbids it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


atexit.register(_drop_scratch)
