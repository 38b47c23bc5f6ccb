"""Distributed XML invoice scan.

Default form: ``spark.read.text(dir, wholetext=True)`` gives one row per file and
``from_xml`` parses it on the executors in PERMISSIVE mode, so a malformed file becomes
a row with ``_corrupt_record`` set instead of failing the job, and a file with the wrong
root becomes a row without ``NFe``.  Both land in the rejects with the file path.
For files that hold many invoices, ``read_xml_rows`` cuts the text at the closing tags, which
splits large files across tasks, and parses each piece like a file.

The directory is passed whole with ``pathGlobFilter`` rather than as an expanded glob,
which would start a listing job per path.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import parsed_once
from ..operators.records import DOC, RECORD, document_to_record, reject_reason
from ..schemas import CORRUPT_COLUMN, XML_SCHEMA
from ..session import local_path

XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_COLUMN,
    "ignoreNamespace": "true",
    "attributePrefix": "_",
    "ignoreSurroundingSpaces": "true",
}


def read_xml_documents(spark: SparkSession, path: str, glob: str = "*.xml",
                       recursive: bool = False) -> DataFrame:
    """One row per non-empty file: ``file``, ``doc`` (parsed), ``raw`` (text)."""
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    text = reader.text(path, wholetext=True)
    return parse_xml_text(text.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw")))


def files_without_rows(spark: SparkSession, path: str, read: DataFrame, glob: str = "*.xml", recursive: bool = False,
                       scan: DataFrame | None = None) -> DataFrame:
    """The files below ``path`` (``file``) that ``read`` (``file``) has no row of, such as those of no bytes.

    No file source gives a row for a file of no bytes, so the names come from the listing that Spark's file index
    holds on the driver for any scan of the folder; the names alone become a frame, which is anti-joined.  ``scan``: the frame that
    scanned the folder, whose listing is taken then, without another one.
    """
    if scan is None:
        reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
        if recursive:
            reader = reader.option("recursiveFileLookup", "true")
        scan = reader.load(path)
    # as one text, since a list would cross to Python name by name; names are encoded, so no line break is in them
    names = spark._jvm.org.apache.hadoop.util.StringUtils.join("\n", scan._jdf.inputFiles())
    listed = spark.createDataFrame(pa.table({"file": pa.array(names.split("\n") if names else [], pa.string())})).withColumn("__name", _one_slash("file"))
    seen = read.select(_one_slash("file").alias("__name")).distinct()
    return listed.join(seen, "__name", "left_anti").select("file")


def write_single_files(texts: DataFrame, folder: str) -> None:
    """Each row of ``texts`` (name, value) as a text file of its own in ``folder``; names differ.

    In a local or mounted folder the tasks write the files themselves: Hadoop's local file system, without its native library, starts
    two processes for each file it makes.  A task that is tried again writes the same names.  Elsewhere Spark's writer makes a file a row, under
    names of its own, put into place by the tasks, as the driver would move one after the other.
    """
    local = local_path(texts.sparkSession, folder)
    if local is None:
        texts.select("value").write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder)
        return
    os.makedirs(local, exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in batches:
            for name, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with open(f"{local}/{name}", "w", encoding="utf-8", newline="") as f:
                    f.write((value or "") + "\n")
            n += len(b)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    texts.select("name", "value").mapInArrow(run, "n long").agg(F.sum("n")).collect()


def _one_slash(file: str) -> Column:
    """``file:///a`` and ``file:/a`` are one name."""
    return F.regexp_replace(file, "^([a-z0-9]+):/+", "$1:/")


def parse_xml_text(df: DataFrame, text_col: str = "raw", schema: StructType = XML_SCHEMA) -> DataFrame:
    """Add the parsed document column ``doc`` to a frame holding XML text.

    ``schema=XML_ITEM_SCHEMA`` parses only what the item table needs.
    """
    keep = [c for c in df.columns if c != DOC]
    return df.select(*keep, parsed_once(F.from_xml(F.col(text_col), schema, XML_OPTIONS)).alias(DOC))


def read_xml_rows(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """Files that hold many ``nfeProc`` documents: one row per document, ``raw`` its text.

    Text is read with the closing tag as line separator, so large files are split across
    tasks (the ``xml`` source reads a file in one task).  What stands before ``<nfeProc`` is
    the batch root's own markup.  A piece without ``<nfeProc`` is the end of a file: closing
    tags, comments and blanks are dropped, anything else goes on as a document, to be
    rejected with its reason.  Sub-folders are read recursively.
    """
    opening, closing = "<nfeProc", "</nfeProc>"
    text = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .option("lineSep", closing).text(path))
    v = F.col("value")
    tail = v.rlike(r"^(\s|</[^<>]*>|<!--[\s\S]*?-->)*$")
    pieces = text.select(F.col("_metadata.file_path").alias("file"), v).where(v.contains(opening) | ~tail)
    raw = F.when(v.contains(opening), F.concat(F.expr(f"substring(value, locate('{opening}', value))"), F.lit(closing))).otherwise(v)
    return parse_xml_text(pieces.select("file", raw.alias("raw")))


def split_documents(docs: DataFrame, to_record=document_to_record) -> tuple[DataFrame, DataFrame]:
    """(records, rejects).  Records carry ``file`` and the invoice record ``nfe``
    (``to_record=document_items`` for the item-path record of a narrow parse); rejects
    carry ``file``, ``reason`` and the raw text when it was malformed (R6)."""
    doc = F.col(DOC)
    tagged = docs.withColumn("reason", reject_reason(doc, doc.getField(CORRUPT_COLUMN)))
    good = tagged.filter(F.col("reason").isNull()).select("file", to_record(doc).alias(RECORD))
    bad = tagged.filter(F.col("reason").isNotNull()).select(
        "file", "reason", doc.getField(CORRUPT_COLUMN).alias("raw"))
    return good, bad
