"""Session settings and the shared scratch location.

The library never assumes a machine-local folder on a cluster: intermediate
tables and sink round trips go under ``spark.checkpoint.dir`` when the cluster
names one. Only when it is unset (local runs, tests) do we create our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "adperf") -> SparkSession:
    """A local session for tests and benchmarks (clusters bring their own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("ADPERF_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001  (sessions without a JVM context, e.g. Spark Connect)
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may do without: it gets a folder of its own. On a
    cluster executors would each write to their own disk, so that is an error.
    """
    sc = _context(spark)
    current = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if sc is None or not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="adperf-ckpt-")
        sc.setCheckpointDir(current)
    return current


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a written table; ``drop_scratch`` deletes it."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/adperf-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a written table through the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if path in _SCRATCH:
        _SCRATCH.remove(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on the file system that would hold it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_scratch(spark: SparkSession, keep: set[str] = frozenset()) -> None:
    """Deletes the tables that queries of this process have written, once their results have been used."""
    for path in [p for p in _SCRATCH if p not in keep]:
        drop_path(spark, path)


def materialize(df, name: str = "stage"):
    """Cut lineage: write the frame as a Parquet table in the shared folder and read it back.

    Columnar and compressed (cheaper than an RDD checkpoint for wide frames),
    reliable storage, and later reads get column pruning and pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def spread(df, key: str):
    """df dealt by a key where its scan has fewer tasks than there are cores (one small file); else df itself. Results are the same."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
