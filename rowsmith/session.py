"""Session helpers: a tuned local session and the shared folder for materialised data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark. On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rowsmith")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local master with the setting unset; a cluster
    without it is an error, because a machine-local folder would lose data.
    """
    context = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        app = context.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="rowsmith-")
        path = _local_dirs[app]
    if path.startswith("file:") and not context.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_CONF} names a folder of one machine: {path}")
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder; nothing is ever overwritten."""
    return f"{shared_dir(spark)}/rowsmith/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table below the shared folder: read often, computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
