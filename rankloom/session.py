"""Session set-up, and the two ways a result is pinned: small and local, or reliably checkpointed."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A fitted state table up to this many rows and bytes is kept as literal rows, so that Catalyst knows its size and may
# broadcast it; anything larger is written to the reliable checkpoint folder and joined by shuffle.
SMALL_STATE_ROWS = 20_000
SMALL_STATE_BYTES = 8 << 20

# A cached table that many jobs read has a partition for so many rows, and so many partitions at least.
PACKED_ROWS = 1 << 14
LEAST_PACKED = 8
# One that is dealt anew has a partition for each core, or more, so that none has more rows than this.
DEALT_ROWS = 1 << 17


def local_session(app: str = "rankloom", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and laptops. On a cluster the session comes from spark-submit."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Small inputs still spread over the cores of one machine; a cluster keeps Spark's own minimum.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``; only a local master may fall back to its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="rankloom-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def pin_state(df: DataFrame, small_rows: int = SMALL_STATE_ROWS, known_rows: int | None = None) -> DataFrame:
    """Evaluate a state table once. Small ones become literal rows of known size, large ones a checkpoint.

    ``known_rows`` is the row count where the caller has counted it already.
    """
    if known_rows is not None and known_rows > small_rows:
        return durable(df)
    head = (df if known_rows is not None else df.limit(small_rows + 1)).toArrow()
    if head.num_rows <= small_rows and head.nbytes <= SMALL_STATE_BYTES:
        return df.sparkSession.createDataFrame(head, df.schema)  # Arrow data becomes a LocalRelation
    return durable(df)


@contextmanager
def packed(df: DataFrame) -> Iterator[DataFrame]:
    """The table, cached, in no more partitions than its rows need. A job starts a task for each partition, so an iterative fit on
    a small table that came out of a shuffle would spend its time on starting tasks. A large table stays as it is dealt, unless
    one partition has more than twice its share: a file of one row group is read by one task, and every pass of a fit would be
    that task's."""
    kept = df.persist()
    try:
        each = kept.groupBy(F.spark_partition_id().alias("_part")).agg(F.count(F.lit(1)).alias("n"))
        total, largest = each.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
        wanted = max(LEAST_PACKED, -(-total // PACKED_ROWS))
        dealt = min(wanted, max(df.sparkSession.sparkContext.defaultParallelism, -(-total // DEALT_ROWS)))
        if largest > max(PACKED_ROWS, 2 * -(-total // dealt)):
            spread = kept.repartition(dealt).persist()
            spread.count()
            kept.unpersist()
            kept = spread
        yield kept.coalesce(wanted) if kept.rdd.getNumPartitions() > wanted else kept
    finally:
        kept.unpersist()
