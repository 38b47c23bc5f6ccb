"""Join helpers with an explicit size check before any broadcast.

A side is broadcast only after its first ``max_rows + 1`` rows proved that it holds at most
``max_rows`` rows and ``max_bytes`` bytes of text; the check reads at most ``max_rows + 1`` rows
per partition, so it stays cheap even when the side turns out to be large.  Beyond the bound the join is a
plain shuffle join, and AQE (skew-join splitting, runtime broadcast conversion) does the
rest -- see ``fiscalflow.session.SCALE_CONF``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 100_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def fits(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and, as JSON text, ``max_bytes`` bytes."""
    text = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(text), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when its size is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if fits(df, max_rows) else df


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Join a fact frame to a dimension; the dimension is broadcast only when checked small."""
    return fact.join(maybe_broadcast(dim, max_rows), on=on, how=how)
