"""Session helpers: a local session for tests/bench and the checkpoint folder.

On a cluster the session is supplied by the caller; we only read
``spark.checkpoint.dir`` from it.  A folder of our own is set only when the
setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "propal", conf: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Settings for a cluster run sized from the input volume: shuffle
    partitions so that a partition holds ~``target_partition_bytes`` (at
    least 2 waves of the cores, so a lost executor only re-runs small tasks),
    AQE with skew-join splitting, and scan splits of 256 MB.  The distributed
    ranks use ``spark.sql.shuffle.partitions`` range partitions, so this also
    sizes them."""
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when unset, and on one
    machine (``local``), create one.  A cluster without it raises: executors
    do not share a temporary folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="propal-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a
    machine-local temp dir on a cluster)."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, by: Sequence[str] = (), plain: bool = True) -> DataFrame:
    """``df`` written once to the shared scratch folder, as Parquet (a folder per
    value of ``by``), and read from there: for tables that several passes (fits,
    folds, scores, months) read.  Written plain: a split of 128 MB then holds as
    many rows as they have bytes, not the many more that compress into it;
    ``plain=False`` compresses what is only shuffled on, not fitted on."""
    path = scratch_path(df.sparkSession, name)
    write = df.write.partitionBy(*by)
    if plain:
        write = write.option("compression", "none").option("parquet.enable.dictionary", "false")
    write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor
    loss; never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
