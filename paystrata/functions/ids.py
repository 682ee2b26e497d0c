"""Identifiers and hash-derived uniform numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_id(prefix: str, number: Column, width: int = 6) -> Column:
    """``prefix`` + zero-padded number; longer numbers keep all their digits."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.concat(F.lit(prefix), padded)


def has_id(txn_id: Column) -> Column:
    """True for an id that can name a transaction: neither NULL nor blank."""
    return F.coalesce(F.trim(txn_id) != "", F.lit(False))


def hashed_id(prefix: str, key: Column, length: int = 12) -> Column:
    """``prefix`` + upper-case hex digits that depend on ``key`` alone."""
    return F.concat(F.lit(prefix), F.upper(F.substring(F.md5(key), 1, length)))


def unit_interval(key: Column) -> Column:
    """A uniform number in [0, 1) that depends on ``key`` alone (32 hash bits)."""
    bits = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double")
    return bits / F.lit(float(2**32))
