"""Pluggable message log (S6, S7): a Parquet file log by default, Kafka by option.

Both expose the rows a Kafka source supplies -- ``key, value, topic, partition, offset,
timestamp`` -- plus ``batch`` (the writing run), so downstream code does not care
which one is used.

The file log appends one ``batch=<id>`` folder per write, written by Spark's committer, so a
failed or retried job leaves no partial batch behind.  Offsets have no gaps within a
``partition``: each writing task sorts its messages by partition and stores their place in the task's output
(``seq``); an index row for each (batch, partition, task) says at which offset that piece begins.  Messages are written
once and never shuffled for it; the index is made from two narrow columns of what was written, and a
batch counts from the moment its index is there.  Reads between offsets take the pieces they need from the
index, so batches outside are never listed or opened.

One writer at a time; any number of readers, which see whole batches.  The Kafka connector jar is not bundled;
``KafkaLog`` only builds the reader/writer with the reference's options.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import DEFAULT_LOG_PARTITIONS, DEFAULT_TOPIC
from ..operators.joins import maybe_broadcast
from ..operators.ranking import POSITION_BITS
from ..schemas import MESSAGE_LOG_DDL
from ..session import CODEC, folder_exists

LOG_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp", "batch")
# of a stored batch; seq is unique within a batch and rises along the offsets of a partition
STORED = "key string, value string, partition int, seq bigint, timestamp timestamp, batch bigint"
INDEX = "partition int, task int, first_seq bigint, begins bigint, n bigint, batch bigint"
# no two messages are alike: dictionaries and bounds of them cost time and tell nothing
PLAIN = {f"parquet.{what}#{c}": "false" for what in ("enable.dictionary", "column.statistics.enabled") for c in ("key", "value")}
MOST_LISTED = 10_000   # batches that are named one by one in a read

# offset of each partition: the first that is read, or the first that isn't
Offsets = Mapping[int, int]


def _task(seq):
    return F.shiftright(seq, POSITION_BITS).cast("int")


@dataclass(frozen=True)
class FileLog:
    root: str
    topic: str = DEFAULT_TOPIC
    partitions: int = DEFAULT_LOG_PARTITIONS

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/topic={self.topic}"

    @property
    def index_path(self) -> str:
        return f"{self.root.rstrip('/')}/index/topic={self.topic}"

    def write(self, messages: DataFrame, batch: int | None = None, replace_batch: bool = False) -> int:
        """Append ``(key, value)`` rows as one batch; returns the batch id.

        ``replace_batch=True`` overwrites only that batch's folder (dynamic partition
        overwrite), so re-running the same batch id -- e.g. a retried streaming epoch --
        leaves exactly one copy, at the same first offsets.  A batch that others follow can only be replaced by
        as many messages of each partition, since offsets don't move.
        """
        spark = messages.sparkSession
        batch = int(time.time() * 1000) if batch is None else int(batch)
        index = self.index(spark)
        known = replace_batch and not index.where(F.col("batch") == batch).isEmpty()
        if not replace_batch and not index.where(F.col("batch") == batch).isEmpty():
            raise ValueError(f"batch {batch} is in the log; replace it with replace_batch=True")
        out = messages.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.pmod(F.hash(F.col("key")), F.lit(self.partitions)).alias("partition"),
        ).sortWithinPartitions("partition").select(
            "key", "value", "partition", F.monotonically_increasing_id().alias("seq"),
            F.current_timestamp().alias("timestamp"), F.lit(batch).cast("long").alias("batch"),
        )
        # a batch without an index was left by a writer that died, and is overwritten
        out.write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**CODEC, **PLAIN).parquet(self.path)
        self._write_index(spark, batch, index, known)
        return batch

    def _write_index(self, spark: SparkSession, batch: int, index: DataFrame, known: bool) -> None:
        """(partition, task, first_seq, begins, n) of the batch that was written."""
        if not folder_exists(spark, f"{self.path}/batch={batch}"):
            return   # no message
        written = spark.read.schema(STORED).parquet(f"{self.path}/batch={batch}")
        pieces = (written.groupBy("partition", _task(F.col("seq")).alias("task"))
                  .agg(F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("n")))
        if known:
            starts = index.where(F.col("batch") == batch).groupBy("partition").agg(F.min("begins").alias("start"))
            starts = self._checked(pieces, index, batch, starts)
        else:
            starts = index.groupBy("partition").agg(F.max(F.col("begins") + F.col("n")).alias("start"))
        before = Window.partitionBy("partition").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        placed = pieces.join(starts, "partition", "left").select(
            "partition", "task", "first_seq",
            (F.coalesce("start", F.lit(0)) + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("begins"), "n",
            F.lit(batch).cast("long").alias("batch"))
        placed.coalesce(1).write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.index_path)

    def _checked(self, pieces: DataFrame, index: DataFrame, batch: int, starts: DataFrame) -> DataFrame:
        """First offsets of a batch that is replaced, by partition (a partition it had no message in begins at its end)."""
        others = index.where(F.col("batch") != batch)
        ends = {r[0]: r[1] for r in others.groupBy("partition").agg(F.max(F.col("begins") + F.col("n"))).collect()}
        start = {r[0]: r[1] for r in starts.collect()}
        old = {r[0]: r[1] for r in index.where(F.col("batch") == batch).groupBy("partition").agg(F.sum("n")).collect()}
        new = {r[0]: r[1] for r in pieces.groupBy("partition").agg(F.sum("n")).collect()}
        for p in old.keys() | new.keys():
            start.setdefault(p, ends.get(p, 0))
            if old.get(p, 0) != new.get(p, 0) and ends.get(p, 0) > start[p]:
                raise ValueError(f"batch {batch}: later batches follow its offsets in partition {p}")
        return index.sparkSession.createDataFrame(sorted(start.items()), "partition int, start bigint")

    def index(self, spark: SparkSession) -> DataFrame:
        """A row for each piece of a batch: ``n`` messages of a partition from offset ``begins`` on."""
        if not folder_exists(spark, self.index_path):
            return spark.createDataFrame([], INDEX)
        return spark.read.schema(INDEX).parquet(self.index_path)

    def end_offsets(self, spark: SparkSession) -> dict[int, int]:
        """The offset after the last message of each partition: a snapshot to read up to."""
        ends = {r[0]: r[1] for r in self.index(spark).groupBy("partition").agg(F.max(F.col("begins") + F.col("n"))).collect()}
        return {p: ends.get(p, 0) for p in sorted({*range(self.partitions), *ends})}

    def read(self, spark: SparkSession, starting: Offsets | None = None, ending: Offsets | None = None) -> DataFrame:
        """The messages from ``starting`` on and before ``ending``, by partition (S7); by default all.

        A partition that ``starting`` doesn't name is read from its first message, one that ``ending`` doesn't name to its
        last.  An empty frame while nothing was written yet.
        """
        pieces = self.index(spark)
        low, high = _bound(starting, 0), _bound(ending, (1 << 63) - 1)
        pieces = pieces.where((F.col("begins") < high) & (F.col("begins") + F.col("n") > low))
        batches = [r[0] for r in pieces.select("batch").distinct().limit(MOST_LISTED + 1).collect()]
        if not batches:
            return spark.createDataFrame([], MESSAGE_LOG_DDL).withColumn("topic", F.lit(self.topic)).select(*LOG_COLUMNS)
        stored = spark.read.schema(STORED).parquet(self.path)
        if len(batches) <= MOST_LISTED:
            stored = stored.where(F.col("batch").isin(batches))
        named = maybe_broadcast(pieces.select("batch", "partition", "task", "first_seq", "begins"))
        offset = F.col("begins") + F.col("seq") - F.col("first_seq")
        rows = (stored.withColumn("task", _task(F.col("seq"))).join(named, ["batch", "partition", "task"])
                .select("key", "value", F.lit(self.topic).alias("topic"), "partition", offset.alias("offset"), "timestamp", "batch"))
        if starting is None and ending is None:
            return rows
        return rows.where((F.col("offset") >= low) & (F.col("offset") < high))


def _bound(offsets: Offsets | None, otherwise: int):
    """The bound of a row's partition."""
    c = F.lit(otherwise)
    for p, o in (offsets or {}).items():
        c = F.when(F.col("partition") == p, F.lit(int(o))).otherwise(c)
    return c.cast("bigint")


@dataclass(frozen=True)
class KafkaLog:
    bootstrap_servers: str
    topic: str = DEFAULT_TOPIC
    extra: dict = field(default_factory=dict)

    def writer_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.bootstrap_servers, "topic": self.topic, **self.extra}

    def offsets(self, bound: Offsets | None, otherwise: str) -> str:
        """Kafka's JSON form of bounds; partitions that aren't named have to be in it, so name all or none."""
        return otherwise if bound is None else json.dumps({self.topic: {str(p): int(o) for p, o in sorted(bound.items())}})

    def reader_options(self, starting: str = "earliest", ending: str = "latest") -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.bootstrap_servers, "subscribe": self.topic,
                "startingOffsets": starting, "endingOffsets": ending, **self.extra}

    def write(self, messages: DataFrame, batch: int | None = None, replace_batch: bool = False) -> int | None:
        """Append the messages.  A topic can't replace what it has, so ``replace_batch`` is refused."""
        if replace_batch:
            raise ValueError("a topic can't replace a batch; write with replace_batch=False and read the newest message of each key")
        (messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
         .write.format("kafka").options(**self.writer_options()).save())
        return batch

    def read(self, spark: SparkSession, starting: Offsets | None = None, ending: Offsets | None = None) -> DataFrame:
        options = self.reader_options(self.offsets(starting, "earliest"), self.offsets(ending, "latest"))
        return normalize_kafka(spark.read.format("kafka").options(**options).load())


def normalize_kafka(df: DataFrame) -> DataFrame:
    """Kafka source rows -> log rows (binary key/value cast to text, P8)."""
    return df.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp", F.lit(None).cast("long").alias("batch"),
    )
