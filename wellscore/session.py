"""Session helpers: local sessions for tests and the bench, checkpoint dir lookup."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "wellscore") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and read here; a local scratch
    folder is created only when the setting is absent (tests, bench).
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="wellscore-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled_methods(spark: SparkSession):
    """Inside, no generated method is longer than the 8,000 bytes up to which the JVM compiles one.

    A wide projection fused into one longer method runs interpreted; above the limit Spark splits it instead."""
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, min(int(before), 8000))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{os.getpid()}-{next(_counter)}")


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
