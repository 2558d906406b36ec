"""Session defaults shared by the library, the tests and the bench.

The library never creates a session behind the caller's back: operators take
DataFrames.  ``configure`` only sets what results depend on (UTC session time
zone) and the planner settings the operators are designed around (AQE with
skew-join splitting and partition coalescing).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_REQUIRED = {
    # results depend on it: timestamp_ntz <-> timestamp casts and date_trunc
    "spark.sql.session.timeZone": "UTC",
}

_PLANNER = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partial top-k before the shuffle for row_number() <= k filters
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in _REQUIRED.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in _PLANNER.items():
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # static or unknown in this build: leave as is
            pass
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "kestrel") -> SparkSession:
    """Local/test session.  On a cluster, pass the session you already have to
    ``configure`` instead."""
    master = master or os.environ.get("KESTREL_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**_REQUIRED, **_PLANNER}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A session on a ``local`` master (tests) may leave it unset and gets a fresh folder;
    on any other master a folder of one machine would lose data, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="kestrel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the checkpoint folder for a written intermediate table; the
    random part keeps runs apart that share the folder (process ids repeat in containers)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists in the store that the path names; errors of the store are raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a folder of this library's own output, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
