"""Write invoice records as batch XML files: ``<nfeLote>`` wrapping many ``nfeProc``.

Spark's ``xml`` source parses each file as one XML document, so a file holding many
invoices needs one root element around them.  Tooling for tests and the bench: one
file per batch folder, about ``docs_per_file`` invoices each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.operators import records

BATCH_ROOT = "nfeLote"


def write_xml_batches(recs: DataFrame, path: str, docs_per_file: int = 10_000) -> int:
    """Write ``recs`` (column ``nfe``) as batch XML files under ``path``; returns #files."""
    n = recs.count()
    files = max(1, -(-n // docs_per_file))
    x = records.to_xml_text(recs).withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(files)))
    docs = x.groupBy("batch").agg(
        F.concat(F.lit(f"<{BATCH_ROOT}>"), F.concat_ws("", F.collect_list("xml")), F.lit(f"</{BATCH_ROOT}>"))
        .alias("doc"))
    docs.repartition(files, "batch").write.mode("overwrite").partitionBy("batch").text(path)
    return files
