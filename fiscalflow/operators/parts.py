"""Invoices as messages in parts (P5, P14, S4): no row is ever as long as the longest invoice.

The reference puts all items of an invoice into one message.  Here an invoice of more than ``max_items`` items is published
as several messages with the same header, each with at most that many items, its number ``parte`` (from 0), the number of
parts ``partes``, and the name of the publication, ``publicacao``.  Messages without these fields are invoices of one part.

A publication of an invoice counts once all its parts are there.  Of the complete publications the newest by message position
counts; parts of an incomplete one are rejects, and the invoice stays as it was.  A part that was sent twice counts
once, the newest.  All of that is worked out on (key, publication, part, position); the items go from the
message to the item table by themselves and are never put together.

Defined cases: an invoice without items is one part with an empty list; items whose invoice isn't among the records are left
out; a part number beyond ``partes`` makes its publication incomplete.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORRUPT_COLUMN, INVOICE_SCHEMA
from . import normalize
from .joins import maybe_broadcast
from .normalize import MESSAGE_ORDER
from .ranking import numbered_within
from .records import RECORD

PART_FIELDS = ("parte", "partes", "publicacao")
PART_SCHEMA = T.StructType(INVOICE_SCHEMA.fields + [T.StructField(f, T.StringType()) for f in PART_FIELDS]
                           + [T.StructField(CORRUPT_COLUMN, T.StringType())])
MAX_ITEMS = 1000


def item_parts(items: DataFrame, key: str = "chNFe", item: str = "item", max_items: int = MAX_ITEMS, folder: str | None = None) -> DataFrame:
    """(key, parte, partes, itens) of (key, item): lists of at most ``max_items``.

    Only the keys with more items than that, which are few, are numbered; the others are one list each.  ``folder``: see ``numbered_within``.
    """
    counts = items.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_items)
    large = maybe_broadcast(counts.select(F.col(key).alias("__key"), F.ceil(F.col("n") / F.lit(max_items)).cast("int").alias("partes")))
    marked = items.join(large, items[key] == F.col("__key"), "left").drop("__key")
    split = numbered_within(marked.where("partes is not null"), key, "__number", folder)
    split = split.withColumn("parte", (F.col("__number") / F.lit(max_items)).cast("int")).drop("__number")
    whole = marked.where("partes is null").withColumn("partes", F.lit(1)).withColumn("parte", F.lit(0))
    both = split.select(key, "parte", "partes", item).union(whole.select(key, "parte", "partes", item))
    return both.groupBy(key, "parte", "partes").agg(F.collect_list(item).alias("itens"))


def to_part_messages(records: DataFrame, items: DataFrame, publication: Column, max_items: int = MAX_ITEMS, record: str = RECORD,
                     folder: str | None = None) -> DataFrame:
    """``(key, value)`` messages in parts: ``records`` without items, ``items`` (chNFe, item), the name of the publication of each record."""
    parts = item_parts(items, max_items=max_items, folder=folder)
    r = F.col(record)
    head = records.select(r.alias(record), r.getField("chNFe").alias("key"), publication.cast("string").alias("publicacao"))
    j = head.join(parts, head["key"] == parts["chNFe"], "left")
    fields = [r.getField(f.name).alias(f.name) for f in INVOICE_SCHEMA.fields if f.name != "itens"]
    none = F.array().cast(INVOICE_SCHEMA["itens"].dataType)
    value = F.struct(*fields, F.coalesce("itens", none).alias("itens"), F.coalesce("parte", F.lit(0)).cast("string").alias("parte"),
                     F.coalesce("partes", F.lit(1)).cast("string").alias("partes"), "publicacao")
    return j.select("key", F.to_json(value).alias("value"))


def parsed_parts(log_rows: DataFrame) -> DataFrame:
    """Parsed messages with ``chave``, ``publicacao``, ``parte``, ``partes`` and their position; one without a key is left out."""
    parsed = normalize.parse_messages(log_rows, schema=PART_SCHEMA, keep=MESSAGE_ORDER)
    r = F.col(RECORD)
    rows = parsed.select(*MESSAGE_ORDER, RECORD, r.getField("chNFe").alias("chave"), F.coalesce(r.getField("publicacao"), F.lit("")).alias("publicacao"),
                         F.coalesce(r.getField("parte").try_cast("int"), F.lit(0)).alias("parte"),
                         F.coalesce(r.getField("partes").try_cast("int"), F.lit(1)).alias("partes"))
    return rows.where(F.coalesce(F.trim("chave"), F.lit("")) != "")


def publications(parts: DataFrame) -> DataFrame:
    """(chave, publicacao, partes, presentes, completa, posicao) of every publication; ``parts``: from parsed_parts."""
    position = F.struct(*MESSAGE_ORDER)
    once = parts.groupBy("chave", "publicacao", "parte").agg(F.max("partes").alias("partes"), F.max(position).alias("posicao"))
    whole = once.groupBy("chave", "publicacao").agg(
        F.max("partes").alias("partes"), F.count(F.lit(1)).alias("presentes"), F.max("parte").alias("ultima"), F.max("posicao").alias("posicao"))
    complete = (F.col("presentes") == F.col("partes")) & (F.col("ultima") < F.col("partes"))
    return whole.select("chave", "publicacao", "partes", "presentes", complete.alias("completa"), "posicao")


def newest_parts(parts: DataFrame) -> DataFrame:
    """The parts of the newest complete publication of every invoice, each once."""
    position = F.struct(*MESSAGE_ORDER)
    complete = publications(parts).where("completa")
    newest = complete.groupBy("chave").agg(F.max_by("publicacao", "posicao").alias("publicacao"))
    once = parts.groupBy("chave", "publicacao", "parte").agg(F.max(position).alias("p")).join(newest, ["chave", "publicacao"])
    n = once.select(F.col("chave").alias("__c"), F.col("publicacao").alias("__v"), F.col("parte").alias("__q"), *[F.col(f"p.{c}").alias(f"__{c}") for c in MESSAGE_ORDER])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in MESSAGE_ORDER],
                  (F.col("chave") == F.col("__c")) & (F.col("publicacao") == F.col("__v")) & (F.col("parte") == F.col("__q")))
    return parts.join(n, same, "left_semi")


def tables_of(newest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(header rows with ``publicacao``, item rows) of the newest parts; an invoice's header comes from its part 0."""
    return normalize.notas(newest.where("parte = 0"), keep=("publicacao",)), normalize.itens(newest)


def incomplete(parts: DataFrame) -> DataFrame:
    """(key, publicacao, partes, presentes, reason) of publications that lack parts."""
    return publications(parts).where("not completa").select(
        F.col("chave").alias("key"), "publicacao", "partes", "presentes", F.lit("incomplete").alias("reason"))
