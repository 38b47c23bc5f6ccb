"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import sys
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalflow.operators.joins import maybe_broadcast

# texts turned into Python objects at once
TEXTS = 500
# rows of one input partition that are numbered together, as a power of two
CHUNK_BITS = 10


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a scratch folder only in local mode."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="llm-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """The frame, written once to the shared folder; later reads survive lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a saved frame of at most ``rows`` rows and 64 MB of text, else the frame as it is."""
    return maybe_broadcast(df, rows)


def batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
            schema: T.StructType | str, rows: int | None = None) -> DataFrame:
    """``mapInArrow`` with the modules of ``fn`` sent along, as executors may not have them installed.

    ``rows``: the most rows ``fn`` gets at once, which bounds the Python objects made of texts.
    """
    def sliced(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(b.slice(i, rows) for b in it for i in range(0, len(b), rows))

    for f in (fn, sliced):
        cloudpickle.register_pickle_by_value(sys.modules[f.__module__])
    return df.mapInArrow(sliced if rows else fn, schema)


def number_within(df: DataFrame, key: str, out: str) -> DataFrame:
    """Adds ``out``: a gapless number from 0 within each value of ``key`` (never null).

    Rows are cut into chunks of at most 2**CHUNK_BITS rows of one partition.  Rows are
    ranked inside (key, chunk), and a running sum over the chunk counts of a key shifts
    them, so no task ever sorts all rows of a key.  ``df`` should be narrow: it is saved
    once, which also fixes the order that the numbers follow.
    """
    d = saved(df.withColumn("__rid", F.monotonically_increasing_id()))
    d = d.withColumn("__chunk", F.shiftright("__rid", CHUNK_BITS))
    counts = d.groupBy(key, "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "__chunk", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    ranked = d.withColumn("__rank", F.row_number().over(Window.partitionBy(key, "__chunk").orderBy("__rid")))
    return (ranked.join(offsets, [key, "__chunk"])
            .withColumn(out, (F.col("__offset") + F.col("__rank") - 1).cast("long"))
            .drop("__rid", "__chunk", "__rank", "__offset"))


def text_bytes(text: Column) -> Column:
    """UTF-8 length; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long); root is the component's least node.

    Alternates large-star and small-star steps until the edges are stars around their
    least node.  Every step is a partial aggregate and a join on node ids; the edges of
    each round are saved, so neither lineage nor any driver-side list grows.
    Self links and repeated links are allowed; an empty frame gives an empty frame.
    """
    e = saved(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        e = saved(small)
        now = tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1000003)).first())
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
