"""Session settings, shared scratch tables and the check for over-full keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A key with more rows than this gets its rows spread over several tasks.
HOT_KEY_ROWS = 1_000_000
# Visits that a task of a layout holds: some 500 bytes each, several times at once, and up to three rows each by window.
LAYOUT_ROWS = 250_000
# Bytes of files that a task reads. Rows of visits are many times larger in memory than in files: from whole default splits
# a task would spill what it shuffles.
SPLIT_BYTES, DEFAULT_SPLIT_BYTES = "32m", 128 << 20

# Bytes of a batch of rows sent to Python. An executor holds a batch for each of its tasks and its Python worker holds it again,
# with what is made of it: Spark's ten thousand whole texts, or 64 MB, are too much for that.
BATCH_BYTES = "4m"


def session(app: str = "journeylens", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(
        map={
            "spark.sql.session.timeZone": "UTC",
            "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
            **conf,
        }
    )
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """UTC, joins that keep a layout and smaller splits of files, if none are set, everywhere; on one machine also small partitions, so that small inputs use all cores."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.sql.files.maxPartitionBytes") in (f"{DEFAULT_SPLIT_BYTES}b", "128MB"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)
    # A side laid out by fewer columns than it is joined by stays where it is.
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Batches for Python of BATCH_BYTES and a row at most, unless the session has a bound of its own."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="journeylens-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/journeylens/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives Catalyst the true
    size of the table, so it broadcasts it only below `autoBroadcastJoinThreshold`.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def layout_tasks(rows: int, spark: SparkSession) -> int | None:
    """Tasks for a layout of so many rows, if the shuffle partitions of the session are too few; None leaves it to them."""
    asked = -(-rows // LAYOUT_ROWS)
    return asked if asked > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def materialize_by(df: DataFrame, keys: list[str], buckets: int | None = None) -> DataFrame:
    """`materialize` as a table bucketed by `keys`, so that windows and aggregations whose keys hold them need no shuffle.

    `df` should be laid out by `keys`, in as many partitions as the `buckets` or, if not given, as a shuffle makes.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"journeylens_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, *keys).option("path", scratch_path(spark)).format("parquet").saveAsTable(name)
    return spark.table(name)


def hot_keys(df: DataFrame, keys: list[str], limit: int = HOT_KEY_ROWS) -> DataFrame:
    """Keys with more than `limit` rows: at most rows / limit of them, so a small table."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    return materialize(counted.filter(F.col("key_rows") > limit).select(*keys))
