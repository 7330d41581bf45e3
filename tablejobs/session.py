"""Session settings the jobs rely on, and the shared folder they write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Skewed joins are left to adaptive execution: it sees the real partition sizes, splits the hot ones and broadcasts a side
# only when its measured size is below spark.sql.autoBroadcastJoinThreshold. Forcing the split keeps it working even when the
# next aggregation would have liked the join's partitioning.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

SHUFFLE_BYTES = 512 * 1024 * 1024  # input per shuffle partition; pruned columns make it less on the wire


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of the Parquet files below a folder, from their listing; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(folder).agg(F.sum("length")).first()[0] or 0


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply SETTINGS; with ``input_bytes`` also raise the shuffle partitions to the size of the input (never lower them).

    Adaptive execution merges partitions that turn out small, so the number only has to be large enough.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        wanted = -(-input_bytes // SHUFFLE_BYTES)
        if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
            spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only for a local session that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tablejobs-")
    return f"{base.rstrip('/')}/tablejobs/{label}-{uuid.uuid4().hex}"
