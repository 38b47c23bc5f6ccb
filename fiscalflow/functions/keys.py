"""Access-key functions (R1, R2): layout split and modulo-11 check digit.

The check digit is an unrolled weighted sum over the 43 leading digits, so it stays a
plain arithmetic expression inside whole-stage codegen (no UDF, no lambda).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    ACCESS_KEY_LAYOUT,
    CHECK_DIGIT_MAX_WEIGHT,
    CHECK_DIGIT_MIN_WEIGHT,
    CHECK_DIGIT_MODULUS,
)

BODY_LENGTH = sum(w for _, w in ACCESS_KEY_LAYOUT) - 1   # 43 digits before the check digit


def weight(position: int, length: int = BODY_LENGTH) -> int:
    """Weight of 1-based ``position``: 2, 3, ..., 9, 2, ... counted from the right."""
    span = CHECK_DIGIT_MAX_WEIGHT - CHECK_DIGIT_MIN_WEIGHT + 1
    return CHECK_DIGIT_MIN_WEIGHT + (length - position) % span


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


CHUNK_DIGITS = 18   # digits that always fit in a bigint


def _chunks() -> list[tuple[int, int]]:
    return [(st, min(CHUNK_DIGITS, BODY_LENGTH - st + 1)) for st in range(1, BODY_LENGTH + 1, CHUNK_DIGITS)]


def weighted_remainder_sql(chunk_cols: list[str]) -> str:
    """SQL of ``(sum of digit x weight) mod 11`` from bigint chunk columns of the body.

    Every digit is ``(chunk div 10^e) % 10``: long arithmetic on column references,
    which generated code runs without allocating per-digit strings.
    """
    terms = []
    for name, (start, length) in zip(chunk_cols, _chunks()):
        for p in range(start, start + length):
            e = start + length - 1 - p
            digit = f"(`{name}` % 10)" if e == 0 else f"((`{name}` div {10 ** e}) % 10)"
            terms.append(f"{digit} * {weight(p)}")
    return f"pmod({' + '.join(terms)}, {CHECK_DIGIT_MODULUS})"


def with_check_digit(df: DataFrame, name: str, out: str) -> DataFrame:
    """Add ``out``: the modulo-11 check digit of the first 43 characters of ``name``
    (a 43-digit body or a full key); NULL unless those are 43 digits.

    Three small projections: the body is cut into bigint chunks once, the weighted
    digit sum reads the chunk columns, and the digit reads the remainder once.
    """
    cols = [f"_dv_chunk{i}" for i in range(len(_chunks()))]
    valid, rem = "_dv_valid", "_dv_rem"
    src = F.col(name)
    df = df.select("*", *[F.substring(src, st, ln).try_cast("bigint").alias(c)
                          for c, (st, ln) in zip(cols, _chunks())],
                   F.coalesce(src.rlike(f"^[0-9]{{{BODY_LENGTH}}}"), F.lit(False)).alias(valid))
    df = df.withColumn(rem, F.expr(weighted_remainder_sql(cols)).cast("int")).drop(*cols)
    r = F.col(rem)
    dv = F.when(~F.col(valid), F.lit(None).cast("int")).when(r < 2, F.lit(0)).otherwise(
        F.lit(CHECK_DIGIT_MODULUS) - r)
    return df.withColumn(out, dv).drop(valid, rem)


def key_part_columns(key: str | Column, prefix: str = "") -> list[Column]:
    """One substring column per layout field of a 44-digit access key."""
    k = _c(key)
    cols, pos = [], 1
    for name, width in ACCESS_KEY_LAYOUT:
        cols.append(F.substring(k, pos, width).alias(prefix + name))
        pos += width
    return cols


def compose_key_body(cuf: Column, aamm: Column, cnpj: Column, mod: Column, serie: Column,
                     nnf: Column, tpemis: Column, cnf: Column) -> Column:
    """43-digit key body from its parts, each left-padded with zeros to its width.

    NULL if a part is longer than its field: a key is never cut.
    """
    widths = dict(ACCESS_KEY_LAYOUT)
    parts = [(cuf, "cUF"), (aamm, "AAMM"), (cnpj, "CNPJ"), (mod, "mod"), (serie, "serie"),
             (nnf, "nNF"), (tpemis, "tpEmis"), (cnf, "cNF")]
    texts = [(c.cast("string"), widths[n]) for c, n in parts]
    return F.concat(*[F.when(F.length(c) <= w, F.lpad(c, w, "0")) for c, w in texts])


def with_access_key(df: DataFrame, out: str, cuf: Column, aamm: Column, cnpj: Column, mod: Column,
                    serie: Column, nnf: Column, tpemis: Column, cnf: Column) -> DataFrame:
    """Add the 44-digit key ``out`` (body plus check digit).  The body is projected
    first, so the digit sum reads columns instead of repeating the body expression."""
    body, dv = "_key_body", "_key_dv"
    df = df.withColumn(body, compose_key_body(cuf, aamm, cnpj, mod, serie, nnf, tpemis, cnf))
    df = with_check_digit(df, body, dv)
    return df.withColumn(out, F.concat(F.col(body), F.col(dv).cast("string"))).drop(body, dv)
