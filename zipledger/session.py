"""Session helpers: a local session for tests/bench and the shared staging root."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "zipledger") -> SparkSession:
    """Local session for tests and the benchmark (never used by library code)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.speculation", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset (a local test session) do we create one.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="zipledger-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir()
    return root


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as Spark resolves it: without a scheme it lies on the default file system."""
    if "://" in path or path.startswith("file:"):
        return path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    default = conf.get("fs.defaultFS") or "file:///"
    if default.startswith("file:"):
        return path
    if path.startswith("/"):
        return default.rstrip("/") + path
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(conf).makeQualified(where).toString()


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint root."""
    root = checkpoint_root(spark)
    base = root[len("file:"):] if root.startswith("file:") else root
    return os.path.join(base, "zipledger-staging", f"{name}-{uuid.uuid4().hex[:12]}")
