"""Session helpers.

Operators never build a session; they receive DataFrames.  `local_session`
exists for tests and the bench.  `shared_dir` resolves the folder the cluster
names in `spark.checkpoint.dir`, which is where intermediate tables (lake
layers written by round-trip queries, streaming checkpoints) go.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "stratus") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings to start a cluster session with, sized from the input.

    Shuffle partitions start at about one per `target_partition_bytes` of
    input (at least 2 per core) and AQE coalesces the small ones and splits
    skewed ones at run time; scans split files into ~256 MB tasks.  Joins
    keep Spark's own broadcast threshold, in bytes.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; sets a local one only when none is set."""
    try:
        sc = spark.sparkContext
    except PySparkException:      # a Spark Connect session has no SparkContext
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or None
        if not root:
            # Local tests may go without; on a cluster a machine-local folder
            # would hold files that the other machines cannot see.
            if sc is not None and not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="stratus-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/stratus/{name}-{uuid.uuid4().hex[:12]}"
