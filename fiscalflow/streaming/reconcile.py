"""Headers against items as they arrive (R3 over streams).

Two streams, headers and items, meet in a full outer stream-stream join with watermarks.  The watermark
doesn't follow the data, whose times may lie years apart or ahead, but ticks: ``until`` closes all that is older
than ``until - slack``.  What can't wait for its partner has a defined outcome, and no row is dropped:

* ``matched``: an item with its header;
* ``header_only``, ``item_only``: closed without a partner;
* ``late_header``, ``late_item``: read when its time was closed already, without a time or before 1970.

Rows lie below ``root/rows`` by epoch, written under the epoch's id, so that a retried one leaves one copy.  ``reconciled`` puts
header and items of a note together whatever their outcome: late ones correct the note.  Headers that are still
open and have no item yet aren't in it.  After a lost checkpoint both inputs are read again; a header or item that is there twice counts once.

A note's items are spread over ``salts`` join keys, to which its (narrow) header is copied, so that the state of a note with
a third of all items lies in several partitions.  State is held in RocksDB until it is closed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality
from ..session import folder_exists, settings
from .incremental import MAX_FILE_AGE, _append_epoch, _until_consumed
from .latest_state import STATE

HEADER = ("total_vProd", "total_vDesc", "total_vTotTrib", "total_vNF")
ITEM = ("vProd", "vDesc", "vTotTrib")
# what the watermark is behind; ticks are put as far ahead, so that they alone move it
DELAY = "36500 days"
EXCLUDED = "spark.sql.optimizer.excludedRules"
# one store for each partition of the join, not four
JOIN = {"spark.sql.streaming.join.stateFormatVersion": "3", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
# where Spark's watermark begins; what is older is late from the start
START = "1970-01-01 00:00:00"


def closed_until(spark: SparkSession, root: str) -> str | None:
    """The latest tick, as text; None before the first."""
    if not folder_exists(spark, f"{root}/ticks"):
        return None
    return spark.read.schema("tick timestamp").parquet(f"{root}/ticks").select(F.max("tick").cast("string")).first()[0]


def _tick(spark: SparkSession, root: str, until: str) -> None:
    one = spark.range(1).select(F.lit(until).cast("timestamp").alias("tick"))
    one.write.mode("append").parquet(f"{root}/ticks")


def reconcile_available(spark: SparkSession, headers: DataFrame, items: DataFrame, root: str, checkpoint: str,
                        keys: Sequence[str] = ("chNFe",), number: str = "nItem", time: str = "event_time",
                        until: str | None = None, slack: str = "30 days", salts: int = 8) -> StreamingQuery:
    """Join what is new in the streams ``headers`` (keys, time, totals) and ``items`` (keys, number, time, amounts).

    ``number``: what tells an item from the others of its note, of any type.  Where item numbers repeat, take the row's place
    in its file (``place_in_file``).
    ``until``: a time, as text, up to which both are taken to be complete.  Earlier than the last one, it changes nothing.
    ``slack``, ``salts`` and the keys have to stay the same for a checkpoint.
    """
    before = closed_until(spark, root)
    first = F.lit(before or START).cast("timestamp")
    if until is not None or before is None:
        later = until is not None and (before is None or spark.range(1).select(F.lit(until).cast("timestamp") > first).first()[0])
        if later or before is None:
            _tick(spark, root, until if later else START)
    ticks = (spark.readStream.schema("tick timestamp").option("maxFileAge", MAX_FILE_AGE).parquet(f"{root}/ticks")
             .select((F.col("tick") + F.expr(f"interval {DELAY}")).alias("clock")))
    # no row may move the watermark beyond the ticks: times further ahead wait as if they were the furthest
    furthest = F.greatest(first, F.lit(until).cast("timestamp")) + F.expr(f"interval {DELAY}")
    open_ = F.coalesce(F.col(time) > first, F.lit(False))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])

    def live(df: DataFrame, side: str, row: Column, salt: Column) -> DataFrame:
        rows = df.where(open_).select(F.struct(*keys).alias("key"), F.when(whole, F.struct(*keys)).alias("join"), salt.alias("salt"), row.alias("row"),
                                      F.least(F.col(time), furthest).alias("clock"))
        both = rows.unionByName(ticks, allowMissingColumns=True)
        # join keys are never null: rows without a whole key and ticks have one of their side
        both = both.select("key", F.coalesce(F.to_json("join"), F.lit(side)).alias("join"), F.coalesce("salt", F.lit(-1)).alias("salt"), "row", "clock")
        both = both.withWatermark("clock", DELAY)
        return both.select(*[F.col(c).alias(f"{side}_{c}") for c in both.columns])

    h_row, i_row = F.struct(time, *HEADER), F.struct(F.col(number).alias("number"), time, *ITEM)
    h = live(headers, "h", h_row, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    i = live(items, "i", i_row, F.pmod(F.xxhash64(number, *ITEM), F.lit(salts)).cast("int"))
    gap = F.expr(f"interval {slack}")
    same = (F.col("h_join") == F.col("i_join")) & (F.col("h_salt") == F.col("i_salt"))
    near = (F.col("i_clock") >= F.col("h_clock") - gap) & (F.col("i_clock") <= F.col("h_clock") + gap)
    has_h, has_i = F.col("h_row").isNotNull(), F.col("i_row").isNotNull()
    outcome = F.when(has_h & has_i, "matched").when(has_h, "header_only").otherwise("item_only")
    joined = h.join(i, same & near, "full_outer").where(has_h | has_i).select(
        *[F.coalesce(F.col("h_key").getField(c), F.col("i_key").getField(c)).alias(c) for c in keys],
        F.col("h_row").alias("header"), F.col("i_row").alias("item"), outcome.alias("outcome"))
    late_h = headers.where(~open_).select(*keys, h_row.alias("header"), F.lit("late_header").alias("outcome"))
    late_i = items.where(~open_).select(*keys, i_row.alias("item"), F.lit("late_item").alias("outcome"))
    rows = joined.unionByName(late_h, allowMissingColumns=True).unionByName(late_i, allowMissingColumns=True)

    def write_epoch(batch_df: DataFrame, epoch_id: int) -> None:
        if not folder_exists(spark, f"{root}/rows/epoch=-1"):   # tells the columns while there are no rows
            spark.createDataFrame([], batch_df.schema).write.parquet(f"{root}/rows/epoch=-1")
        _append_epoch(batch_df, f"{root}/rows", epoch_id)

    # in a batch whose ticks or rows are empty this rule takes the union away, after which the join's state is read wrongly
    rules = [spark.conf.get(EXCLUDED, None), "org.apache.spark.sql.catalyst.optimizer.PropagateEmptyRelation"]
    with settings(spark, {**STATE, **JOIN, EXCLUDED: ",".join(r for r in rules if r)}):
        return _until_consumed(rows, write_epoch, checkpoint)


def place_in_file() -> Column:
    """File and row of a Parquet stream's rows: the same whenever they are read.  The file goes by the 16 bytes of its path's MD5,
    as the join's state holds it with every row."""
    return F.struct(F.unhex(F.md5(F.col("_metadata.file_path").cast("binary"))).alias("file"), F.col("_metadata.row_index").alias("row"))


def _newest(rows: DataFrame, part: str, by: Sequence[str]) -> DataFrame:
    """The part of the rows that have it, once for each ``by``: the one of the latest time, then of the greatest amounts."""
    return (rows.where(F.col(part).isNotNull()).groupBy(*by).agg(F.max(part).alias("newest"))
            .select(*by, "newest.*"))


def joined_rows(spark: SparkSession, root: str) -> DataFrame:
    """Every row that the join gave: keys, header, item, outcome, epoch.  A header is in it once for each salt or item."""
    return spark.read.parquet(f"{root}/rows")


def reconciled(spark: SparkSession, root: str, keys: Sequence[str] = ("chNFe",)) -> DataFrame:
    """``quality.reconcile_totals`` of the headers that are matched, closed or late, with all their items so far."""
    rows = joined_rows(spark, root)
    itens = rows.where("item is not null").select(*keys, "item.*").groupBy(*keys, "number").agg(
        F.max_by(F.struct(*ITEM), F.struct(*[c for c in rows.schema["item"].dataType.names if c != "number"])).alias("newest"))
    return quality.reconcile_totals(_newest(rows, "header", keys), itens.select(*keys, "newest.*"), keys, keys)


def items_without_header(spark: SparkSession, root: str, keys: Sequence[str] = ("chNFe",)) -> DataFrame:
    """Keys, number and amounts of closed and late items whose note has no header so far."""
    rows = joined_rows(spark, root)
    known = rows.where("header is not null").select(*keys).distinct()
    return rows.where("outcome in ('item_only', 'late_item')").select(*keys, "item.*").join(known, list(keys), "left_anti")
