"""What several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.plans.lineage import cut, ensure_checkpoint_dir

__all__ = ["by_batch", "cut", "held_out", "in_pieces", "stored", "table"]

WHITE = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below the checkpoint folder and read again: smaller than a checkpoint."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids whose labels no model may learn from; a NULL id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def in_pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what is built from a batch of long texts stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def by_batch(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], rows: int = 512):
    """A function for ``mapInArrow``: ``make`` runs once per task, what it returns runs on each small batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in in_pieces(batches, rows):
            yield work(batch)

    return run
