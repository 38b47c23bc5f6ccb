"""Text-at-path helpers for the XML -> message step (P1, P2, P7; N1-N3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: str | Column) -> Column:
    """Trimmed text, or ``""`` when the element is absent or empty."""
    return F.coalesce(F.trim(_c(c)), F.lit(""))


def block_text(block: str | Column, field: str, default: str = "") -> Column:
    """Child text of ``block``; ``default`` when the whole block is absent.

    A present block with a missing child still gives ``""``.
    """
    b = _c(block)
    return F.when(b.isNull(), F.lit(default)).otherwise(text_or_empty(b.getField(field)))


def strip_literal(c: str | Column, literal: str) -> Column:
    """Remove every occurrence of ``literal`` (``Id.replace("NFe", "")``, P3)."""
    return F.replace(_c(c), F.lit(literal), F.lit(""))


def parsed_once(expr: Column) -> Column:
    """Emit ``expr`` through a one-element generator so it is evaluated once per row.

    A filter on a projected expression is pushed below the projection with the
    expression pasted into every reference, which for a parser (``from_xml``,
    ``from_json``) means one parse per field the predicate reads.  Predicates on a
    generator's output stay above it, so the parse runs exactly once.
    """
    return F.explode(F.array(expr))
