"""Session helpers: building a session for tests/bench, checkpoint location,
and partition sizing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "citeweave",
                  extra: dict | None = None) -> SparkSession:
    """A local session with AQE on and the UI off (tests and bench only)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        # Remove checkpoint files once nothing references them (per-round
        # PageRank checkpoints are garbage after the ranks are kept).
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it if needed.

    A cluster names its shared checkpoint folder in ``spark.checkpoint.dir``;
    that setting is always preferred. Only a local-mode session without any
    setting gets a private scratch folder (tests); a cluster session without
    one is an error, because a machine-local folder does not survive the loss
    of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="citeweave-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
    return sc.getCheckpointDir()


def keep(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and read it back.

    The lineage is cut, a lost executor costs nothing that was written, and
    later scans read only the columns they need. ``drop_kept`` removes the
    files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*(partition_by or [])).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_path = path
    return out


def drop_kept(*frames: DataFrame) -> None:
    """Delete the files of frames that ``keep`` gave, and of those that a frame
    names in ``_kept``; others are left alone."""
    for df in frames:
        drop_kept(*getattr(df, "_kept", []))
        path = getattr(df, "_kept_path", None)
        if path is not None:
            target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
