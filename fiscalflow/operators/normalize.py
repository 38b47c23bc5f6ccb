"""Messages -> parsed records -> flat header / item tables (P8-P15), and dedup.

The flat projections are driven by the column maps in ``fiscalflow.schemas``.  Numbers
use ``try_cast`` so text that is no number becomes NULL (N7: Spark 4 runs with ANSI on,
where a plain cast of ``""`` raises).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import parsed_once
from ..schemas import CORRUPT_COLUMN, INVOICE_PARSE_SCHEMA, ITENS_COLUMNS, NOTAS_COLUMNS
from .joins import fits

JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
RECORD = "nfe"


# text a double cast accepts without any digit in it
_FLOAT_WORDS = ("nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


def typed(c: Column, typ: str) -> Column:
    """``try_cast(c AS typ)`` for message text.

    Text without a digit (``""``, codes, words) cannot be a number except for the
    float words, so it is mapped to NULL before the cast: a failing cast costs an
    exception per row, the digit test a byte scan.
    """
    if typ == "string":
        return c
    maybe = c.rlike("[0-9]")
    if typ in ("double", "float"):
        maybe = maybe | F.lower(F.trim(c)).isin(*_FLOAT_WORDS)
    return F.when(maybe, c.try_cast(typ))


def parse_messages(messages: DataFrame, schema=INVOICE_PARSE_SCHEMA, keep: Sequence[str] = ()) -> DataFrame:
    """``from_json(CAST(value AS STRING), schema)`` as column ``nfe``."""
    parsed = F.from_json(F.col("value").cast("string"), schema, JSON_OPTIONS)
    return messages.select(*keep, parsed_once(parsed).alias(RECORD))


def message_reason(value: Column, record: Column) -> Column:
    """Why a message cannot become table rows, or NULL when it can."""
    return (F.when(value.isNull() | (F.trim(value.cast("string")) == ""), F.lit("empty"))
            .when(record.isNull() | record.getField(CORRUPT_COLUMN).isNotNull(), F.lit("malformed"))
            .when(F.coalesce(F.trim(record.getField("chNFe")), F.lit("")) == "", F.lit("missing_key")))


def tagged_messages(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, the record ``nfe``, ``reason`` and, for rejects, the text ``raw``.

    One rule for batch and stream; each message is parsed once.
    """
    parsed = parse_messages(messages, keep=(*keep, "value"))
    reason = message_reason(F.col("value"), F.col(RECORD))
    tagged = parsed.select(*keep, RECORD, reason.alias("reason"), F.col("value").cast("string").alias("raw"))
    return tagged.withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("raw")))


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of parsed messages whose text isn't at hand: no JSON object, or no key."""
    r = F.col(RECORD)
    bad = r.isNull() | r.getField(CORRUPT_COLUMN).isNotNull() | (F.coalesce(F.trim(r.getField("chNFe")), F.lit("")) == "")
    return parsed.filter(~bad), parsed.filter(bad)


def notas(parsed: DataFrame, record: str = RECORD, keep: Sequence[str] = ()) -> DataFrame:
    """Invoice header table, 34 columns (P10-P12); ``keep`` carries extra columns."""
    return parsed.select(*keep, *[typed(F.col(f"{record}.{path}"), typ).alias(name)
                                  for name, path, typ in NOTAS_COLUMNS])


def itens(parsed: DataFrame, record: str = RECORD, outer: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Invoice item table, one row per array element, 13 columns.

    ``explode`` drops notes whose item list is NULL or empty, as the reference does
    (N9); ``outer=True`` keeps them with NULL item columns.
    """
    gen = F.explode_outer if outer else F.explode
    r = F.col(record)
    exploded = parsed.select(
        *keep,
        r.getField("chNFe").alias("chNFe"),
        r.getField("ide").getField("nNF").alias("nNF"),
        gen(r.getField("itens")).alias("item"),
    )
    return exploded.select(*keep, "chNFe", "nNF",
                           *[typed(F.col(path), typ).alias(name) for name, path, typ in ITENS_COLUMNS])


def latest_by_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key, "latest" meaning greatest ``order`` tuple.

    Written as ``max_by(row, order)`` per key: a combinable aggregate, so each map task
    keeps one row per key before the shuffle and a key holding a third of all rows
    still reaches the reducer as one row per map task.  (``row_number`` over a window
    would send every row of that key to a single task.)  ``order`` should be unique
    per key -- e.g. ``(timestamp, batch, partition, offset)`` for messages.
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*payload), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload])


MESSAGE_ORDER = ("timestamp", "batch", "partition", "offset")


def latest_messages(log_rows: DataFrame) -> DataFrame:
    """Newest message per key from a message log (de-duplicates re-publication, N15).

    The newest position per key is found on narrow columns; only then are the messages joined to
    it, so text is shuffled once and never sorted or compared.  Where few keys are there twice, which hashes of the keys
    tell, only the messages of those are compared, and no text is shuffled.  Messages without a key are kept: nothing says they
    are the same.
    """
    keyed = F.coalesce(F.trim("key"), F.lit("")) != ""
    winners = (log_rows.where(keyed).groupBy("key").agg(F.max(F.struct(*MESSAGE_ORDER)).alias("_w"), F.count(F.lit(1)).alias("_n"))
               .select(F.col("key").alias("_k"), *[F.col(f"_w.{c}").alias(f"_{c}") for c in MESSAGE_ORDER], "_n"))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in MESSAGE_ORDER])
    # every repeated key is among the repeated hashes
    again = log_rows.where(keyed).groupBy(F.xxhash64("key").alias("_h")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if fits(again):
        few = F.broadcast(winners.where("_n > 1"))
        older = keyed & (F.col("key") == F.col("_k")) & ~same
        return log_rows.join(few, older, "left_anti")
    same &= F.col("key") == F.col("_k")
    return log_rows.where(keyed).join(winners, same, "left_semi").unionByName(log_rows.where(~keyed))
