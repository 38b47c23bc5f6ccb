"""Global places without a one-partition window.

``row_number() OVER (ORDER BY ...)`` sends all rows to one task.  Here rows are dealt to ranges
of the sort keys and sorted in each, saved once, and numbered by their position in the saved
partition plus the number of rows in the partitions before.  Only those counts, one a partition, reach
the driver.  ``ranked`` gives SQL's rank() and dense_rank(): it numbers the distinct keys, so that a key with a
third of all rows is one row while places are made.

Defined cases: nulls sort as Spark sorts them (first when ascending, last when descending); rows that are equal in
all sort keys get different numbers in ``numbered`` (any of them) and one place in ``ranked``; an empty
frame gives an empty frame.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import STAGED, checkpoint_dir
from .joins import maybe_broadcast

# sort key: (column, descending)
Order = Sequence[tuple[str, bool]]

POSITION_BITS = 33   # of monotonically_increasing_id, below the partition


def _sorting(order: Order) -> list[Column]:
    return [F.col(c).desc() if down else F.col(c).asc() for c, down in order]


def _saved(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _staged(df: DataFrame, folder: str | None) -> DataFrame:
    """Saved as compressed columns; ids of rows have to be among them, as a read deals rows anew."""
    path = f"{folder or checkpoint_dir(df.sparkSession) + '/fiscalflow-ranking'}/{uuid.uuid4().hex}"
    df.write.options(**STAGED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _in_ranges(df: DataFrame, order: Order) -> DataFrame:
    """Saved in sort order, with ``__part`` and ``__at`` (0, 1, ... inside each partition).

    Ties are spread over partitions by a hash of the row and, for equal rows, a random number.
    """
    by = _sorting(order)
    tie = df.withColumn("__tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).withColumn("__dice", F.rand(1))
    dealt = tie.repartitionByRange(*by, "__tie", "__dice").sortWithinPartitions(*by, "__tie", "__dice").drop("__tie", "__dice")
    place = F.monotonically_increasing_id()
    return (_saved(dealt).withColumn("__id", place).withColumn("__part", F.shiftright("__id", POSITION_BITS).cast("int"))
            .withColumn("__at", F.col("__id").bitwiseAND((1 << POSITION_BITS) - 1)).drop("__id"))


def _before(df: DataFrame, total: Column) -> DataFrame:
    """(__part, __before): the sum of ``total`` over the partitions before each."""
    spark = df.sparkSession
    sizes = sorted((r[0], r[1]) for r in df.groupBy("__part").agg(total.alias("n")).collect())
    rows, so_far = [], 0
    for part, n in sizes:
        rows.append((part, so_far))
        so_far += n
    return spark.createDataFrame(rows, "__part int, __before bigint")


def numbered(df: DataFrame, order: Order, out: str = "place") -> DataFrame:
    """``df`` with ``out``: its row number from 1 in ``order``."""
    placed = _in_ranges(df, order)
    offsets = _before(placed, F.count(F.lit(1)))
    return (placed.join(maybe_broadcast(offsets), "__part")
            .withColumn(out, F.col("__before") + F.col("__at") + 1).drop("__part", "__at", "__before"))


def ranked(df: DataFrame, order: Order, out: str = "place", dense: bool = False) -> DataFrame:
    """``df`` with ``out``: rank() in ``order``, or dense_rank()."""
    names = [c for c, _ in order]
    keys = df.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    if dense:
        placed = numbered(keys, order, out).drop("__n")
    else:
        inside = _in_ranges(keys, order)
        offsets = _before(inside, F.sum("__n"))
        above = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
        placed = (inside.join(maybe_broadcast(offsets), "__part")
                  .withColumn(out, F.col("__before") + F.coalesce(F.sum("__n").over(above), F.lit(0)) + 1)
                  .drop("__part", "__at", "__before", "__n"))
    right = placed.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(names)], out)
    same = F.lit(True)
    for i, c in enumerate(names):
        same &= F.col(f"`{c}`").eqNullSafe(F.col(f"__k{i}"))
    return df.join(right, same).drop(*[f"__k{i}" for i in range(len(names))])


def numbered_within(df: DataFrame, key: str, out: str = "number", folder: str | None = None) -> DataFrame:
    """``df`` with ``out``: a number from 0 without gaps within each value of ``key``, in any order, and no shuffle of its rows.

    Each partition is sorted by key and saved; a row's number is its place in the key's piece of that partition plus
    the length of the pieces before, of which a key has at most one a partition.  ``folder``: where what is saved goes, to be removed
    once the result was written.
    """
    saved = _staged(df.sortWithinPartitions(key).withColumn("__id", F.monotonically_increasing_id()), folder)
    saved = saved.withColumn("__part", F.shiftright("__id", POSITION_BITS))
    pieces = saved.groupBy(key, "__part").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = _staged(pieces.withColumn("__begins", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"), folder)
    right = maybe_broadcast(pieces.select(F.col(key).alias("__key"), F.col("__part").alias("__p"), "__first", "__begins"))
    joined = saved.join(right, F.col(f"`{key}`").eqNullSafe(F.col("__key")) & (F.col("__part") == F.col("__p")))
    return joined.withColumn(out, F.col("__begins") + F.col("__id") - F.col("__first")).drop("__id", "__part", "__key", "__p", "__first", "__begins")
