"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(name: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benches; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """Folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: there the driver's own
    temporary folder is the shared one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="dimwright-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: lineage ends here and later
    readers prune columns from the stored files."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """Run independent steps side by side, so that the jobs of one fill the
    cores another leaves idle; returns their results in order."""
    with ThreadPoolExecutor(len(steps)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [f.result() for f in futures]
