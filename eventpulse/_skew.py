"""Salting for joins of a large table to a side table on a possibly hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

SALT = "_salt"


def salted(large: DataFrame, side: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """Both tables with a column ``_salt`` to add to the join condition.

    Rows of ``large`` are spread by a hash of their plain columns, so a lost and
    recomputed partition gets the same salts again; ``side`` is repeated once
    per salt.
    """
    every_salt = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    return large.withColumn(SALT, row_salt(large, salts)), side.withColumn(SALT, every_salt)


def row_salt(table: DataFrame, salts: int) -> Column:
    plain = [f.name for f in table.schema if isinstance(f.dataType, T.AtomicType)]
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(salts).cast("bigint"))


def digest(text: str) -> Column:
    """SHA-256 of a text, as a short key in its place when rows are shuffled per word."""
    return F.unhex(F.sha2(F.col(f"`{text}`").cast("binary"), 256))
