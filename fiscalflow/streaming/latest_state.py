"""The newest message of each key, held in the streaming state store.

``latest_available`` streams new log batches through ``max_by`` in update mode: the state keeps one message
for each key (RocksDB, so it lies on disk and is saved by changes), and a run costs what was added.  The
newest version of every note is read from the state itself with ``latest_state``; no history is aggregated.
It equals ``normalize.latest_messages`` over the same batches: messages without a key are all kept.

A lost checkpoint loses only the state: the next run, with a new checkpoint, reads the log from the start.
The number of state partitions is ``spark.sql.shuffle.partitions`` of the first run, for good; map tasks combine first, so a
key with a third of all messages reaches its partition as one row for each task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.normalize import MESSAGE_ORDER
from ..session import FREED, folder_exists, settings
from ..sources.messages import STORED, FileLog

MAX_FILE_AGE = "36500d"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COLUMNS = "key string, value string, timestamp timestamp, batch bigint, partition int, offset bigint"

# older states than the last finished batch and the one before are only disk, as is space that stores take ahead of their rows
COMPACT = {"spark.sql.streaming.minBatchesToRetain": "2", "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
           "spark.sql.streaming.stateStore.rocksdb.compression": "zstd"}
STATE = {PROVIDER: ROCKSDB, **COMPACT, **FREED}


def latest_available(spark: SparkSession, log: FileLog, checkpoint: str, max_files_per_trigger: int | None = None,
                     on_change: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery | None:
    """Bring the state below ``checkpoint`` up to the end of the log; None while the log has no message.

    ``on_change(messages, epoch)`` gets the newest message of the keys that a batch touched; an epoch may come
    twice, so it should replace what it wrote for it.
    """
    if not folder_exists(spark, log.path):
        return None
    reader = spark.readStream.schema(STORED).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # the place in the stored batch, which rises with the offset
    rows = reader.parquet(log.path).withColumnRenamed("seq", "offset")
    position = F.struct(*MESSAGE_ORDER)
    keyless = F.coalesce(F.trim("key"), F.lit("")) == ""
    newest = (rows.select("*", F.when(~keyless, F.col("key")).alias("__key"), F.when(keyless, position).alias("__lone"))
              .groupBy("__key", "__lone").agg(F.max_by(F.struct("key", "value", *MESSAGE_ORDER), position).alias("newest")))

    def epoch(batch_df: DataFrame, epoch_id: int) -> None:
        if on_change:
            on_change(batch_df.select("newest.*"), epoch_id)
        else:
            batch_df.write.format("noop").mode("overwrite").save()

    with settings(spark, STATE):
        q = (newest.writeStream.outputMode("update").foreachBatch(epoch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return q


def latest_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """key, value and position of the newest message of each key, as the last finished batch left them."""
    if not folder_exists(spark, f"{checkpoint}/state"):
        return spark.createDataFrame([], COLUMNS)
    state = spark.read.format("statestore").load(checkpoint)
    winner = state.schema["value"].dataType.names[0]   # of max_by: the row, then its order
    return state.select(F.col("value").getField(winner).alias("newest")).select("newest.*")
