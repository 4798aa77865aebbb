"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on. Skewed joins are split by AQE even where the
# split costs one more exchange, so that a single hot key never sits in one task.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app: str = "fundscape", master: str | None = None, shuffle_partitions: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings above. On a cluster leave ``master`` unset and let
    spark-submit choose it; ``shuffle_partitions`` should give 100-200 MB each."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which every executor can reach.

    A cluster must have that setting. A local session without it, as in tests, gets one
    temporary folder per process; the session's settings stay as they are."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="fundscape-"))
        base = _own[0]
    return f"{base.rstrip('/')}/fundscape-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write a table that several outputs read to the scratch folder and read it again.
    Nothing stays in executor memory, and no later job depends on this one's executors. ``codec`` is
    the Parquet compression, the session's by default."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", codec) if codec else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
