"""Checked narrowing of key columns to int (ALS and the schemas use int keys)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def checked_int(c: str | Column, name: str | None = None) -> Column:
    """``CAST(c AS INT)`` that fails on out-of-range values whatever the
    session's ANSI setting (a plain cast without ANSI would wrap around)."""
    col = F.col(c) if isinstance(c, str) else c
    label = name or (c if isinstance(c, str) else "key")
    bad = (col < F.lit(INT_MIN)) | (col > F.lit(INT_MAX))
    return F.when(bad, F.raise_error(F.concat(F.lit(f"{label} out of int range: "), col.cast("string")))).otherwise(
        col
    ).cast("int")


def int_key(name: str, strict: bool = False) -> Column:
    """A text or number column as an int key.

    A whole number outside the int range fails, however many digits it has.
    Text that is no whole number becomes null, or fails if ``strict``.
    """
    text = F.trim(F.col(name).cast("string"))
    whole = text.rlike(r"^[+-]?[0-9]+$")
    value = text.try_cast("int")
    failure = F.raise_error(F.concat(F.lit(f"{name} out of int range or not a whole number: "), text))
    fails = (text.isNotNull() if strict else whole) & value.isNull()
    return F.when(fails, failure).when(whole, value).cast("int")
