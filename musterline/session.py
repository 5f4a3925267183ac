"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks. A cluster job brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("musterline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary folder, because
    the driver and the executors of a cluster do not share one.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        master = spark.sparkContext.master  # local-cluster has executors with folders of their own
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="musterline-")
    return f"{root.rstrip('/')}/musterline-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the work folder and return a reader of it.

    This cuts the lineage at a place that survives lost executors, keeps column pruning for
    later readers, and freezes values that a second evaluation could compute differently.
    """
    spark = df.sparkSession
    path = folder or work_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
