"""Files that arrive, taken in once each, and the latest entry kept current."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cardloom.operators.latest import latest_of_each
from cardloom.sources.storage import Snapshots, written


def ingest_arrivals(spark: SparkSession, folder: str, schema: str | StructType, checkpoint: str, batch: Callable[[DataFrame, int], None], file_format: str = "parquet", pattern: str | None = None, files_per_batch: int = 1000) -> None:
    """Runs ``batch`` over the files that arrived since the last call; the checkpoint
    keeps what was taken, so that a file is taken once."""
    reader = spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    query = reader.load(folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def keep_latest(snapshots: Snapshots, keys: Sequence[str], time: str, tie: str, keep: int = 2, older_than_s: int = 3600) -> Callable[[DataFrame, int], None]:
    """A batch function that merges the newest row of each key into a table.

    The table is held in buckets by key, and a batch rewrites those in which its keys lie;
    what older batches left is removed.  Merging takes the greater (time, tie), whenever
    it arrives, so late rows change nothing, nor does a batch that is run again.
    """
    store = snapshots.store

    def merge(batch: DataFrame, number: int) -> None:
        newest = written(latest_of_each(batch, keys, time, tie), "newest")
        store.rewrite("rows", keys, newest, lambda held: newest if held is None else latest_of_each(held.unionByName(newest), keys, time, tie))
        store.clean(keep, older_than_s)

    return merge
