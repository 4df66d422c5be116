"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(master)
        .appName("demandtide")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shared(spark: SparkSession) -> str | None:
    """The shared folder the cluster names."""
    return spark.conf.get("spark.checkpoint.dir", None)


def _own_folder(spark: SparkSession, root: str) -> str:
    """The application's own part of the shared folder."""
    return posixpath.join(root, f"demandtide-{spark.sparkContext.applicationId}")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the application's part of the shared folder the cluster names.

    Without ``spark.checkpoint.dir`` only a local master may fall back to a
    temporary folder: on a cluster the executors could not see it.
    """
    root = _shared(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="demandtide-")
    return posixpath.join(_own_folder(spark, root), f"{label}-{uuid.uuid4().hex}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote under the shared folder. To be called at its end: tables that the
    operators returned may still be read from there."""
    root = _shared(spark)
    if root:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark, root))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
