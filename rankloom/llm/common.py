"""What the operators share: scratch tables in the shared folder, column picking, fold numbers and size checks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.session import ensure_checkpoint_dir

#: A side of a join is broadcast only if its counted rows times its row width stay under this many bytes.
BROADCAST_BYTES = 64 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read it back: cuts the lineage, survives the
    loss of executors, and no later stage computes it again. The table goes with that folder."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def compact(df: DataFrame, rows: int, per_task: int = 1_000_000) -> DataFrame:
    """No more tasks, and so files, than ``rows`` need: at least two for each core, else one for ``per_task`` rows. For
    narrow rows only; a cluster whose shuffles have many small partitions would write as many small files."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, buckets_for(rows, per_task)))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_enough(rows: int, row_bytes: int) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES


def joined(left: DataFrame, right: DataFrame, on: str | list[str], how: str, right_rows: int, row_bytes: int) -> DataFrame:
    """Join with ``right`` broadcast if its counted size is below the bound, by shuffle otherwise."""
    return left.join(F.broadcast(right) if small_enough(right_rows, row_bytes) else right, on, how)


def fold(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def buckets_for(rows: int, per_bucket: int) -> int:
    """How many hash buckets keep about ``per_bucket`` rows each."""
    return max(1, -(-rows // per_bucket))
