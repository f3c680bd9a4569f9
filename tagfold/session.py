"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC clock for epoch-millis conversions and AQE
# for runtime coalescing, skew-join splitting and broadcast conversion.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove reliable checkpoint files once their RDDs are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "tagfold",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. On a cluster pass ``master=None`` and let
    spark-submit decide; locally ``local[N]`` with N shuffle partitions."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir) from the
    session. Only where neither is set and the master is local, as in tests, a
    fresh local folder is created; a cluster has to name a shared one.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tagfold-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{next(_counter)}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """The package itself for the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        top = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(), "tagfold_package.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for n in names:
                    if n.endswith(".py"):
                        f = os.path.join(folder, n)
                        z.write(f, os.path.relpath(f, os.path.dirname(top)))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)


_TABLES: dict[tuple, str] = {}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in any file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def materialized(spark: SparkSession, key: str, build, partition_by: list[str] | None = None):
    """Write ``build()`` once per application as a parquet table under the
    shared checkpoint folder and return a scan of it.

    Used for the tables a job chain hands from one step to the next (the
    formatted log, a stored portrait): every later query reads parquet with
    pushdown and pruning instead of re-deriving the input, and the lineage is
    cut, so a lost executor re-reads files rather than recomputing joins.
    """
    k = (spark.sparkContext.applicationId, key)
    path = _TABLES.get(k)
    if path is None:
        path = scratch_path(spark, "tbl")
        w = build().write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        _TABLES[k] = path
    return spark.read.parquet(path)


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
