"""Session helpers: a local session for tests and the bench, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"

# Whole-stage code for a declared transform (parse, zone shifts, problem text) can exceed the
# JVM's 8000-byte limit for JIT compilation, and such a method then runs interpreted, several
# times slower. This option lets the JIT compile it; set it in
# ``spark.executor.extraJavaOptions`` on a cluster too.
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


_METHOD_LIMIT_KEY, _METHOD_LIMIT_DEFAULT, _JIT_LIMIT = "spark.sql.codegen.hugeMethodLimit", "65535", "8000"


def fit_methods(spark: SparkSession, java_options: str) -> None:
    """Where the executors lack :data:`JIT_OPTIONS`, have Spark give up whole-stage code whose method the JIT would
    refuse: the same expressions then run as many small methods, which it compiles. A limit that the
    session has set itself stays."""
    if JIT_OPTIONS not in java_options.split() and spark.conf.get(_METHOD_LIMIT_KEY, _METHOD_LIMIT_DEFAULT) == _METHOD_LIMIT_DEFAULT:
        spark.conf.set(_METHOD_LIMIT_KEY, _JIT_LIMIT)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench. On a cluster the caller supplies the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("asofspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ASOF_DRIVER_MEMORY", "16g"))
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local folder is created and registered only when the session has none and runs in one
    process (tests, bench). On a cluster the setting is read, never replaced, and its absence is
    an error: a machine's own folder would hide the files from the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(_CHECKPOINT_KEY, None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError(f"{_CHECKPOINT_KEY} is not set: name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="asofspark-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for a job's written intermediate tables."""
    return f"{shared_dir(spark)}/asof-{name}-{uuid.uuid4().hex[:12]}"


def ship_library(spark: SparkSession) -> None:
    """Send this package to the executors, once a session: functions that run inside tasks are
    found there whatever folder the driver was started in."""
    sc = spark.sparkContext
    fit_methods(spark, sc.getConf().get("spark.executor.extraJavaOptions", ""))
    if getattr(sc, "_asofspark_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="asofspark-lib-"), "asofspark_lib.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
    sc._asofspark_shipped = True
