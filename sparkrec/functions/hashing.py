"""Seeded key hash for reproducible splits.

The bucket of a (user, item) pair is the first 32 bits of
``md5("<user>|<item>|<seed>")`` read as an unsigned number, so it is the same
on every run, partitioning and engine, and all copies of a pair land in the
same split. It is a per-row projection: no shuffle, no sampling state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32


def pair_bucket(user: str = "user_id", item: str = "item_id", seed: int = 37) -> Column:
    """Bucket in [0, 2**32) of the pair, as BIGINT."""
    digest = F.md5(F.concat_ws("|", F.col(user).cast("string"), F.col(item).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def pair_bucket_sql(user: str = "user_id", item: str = "item_id", seed: int = 37, dialect: str = "duckdb") -> str:
    """The same bucket as SQL text, for DuckDB or Spark SQL."""
    if dialect == "spark":
        return (
            f"CAST(conv(substring(md5(concat_ws('|', CAST({user} AS STRING), CAST({item} AS STRING), '{seed}')), 1, 8), 16, 10) AS BIGINT)"
        )
    return (
        f"CAST(('0x' || substring(md5(concat_ws('|', CAST({user} AS VARCHAR), CAST({item} AS VARCHAR), '{seed}')), 1, 8)) AS BIGINT)"
    )


def unit_number(key: str, seed: int, j: int) -> Column:
    """A number in (0, 1) from the md5 of ``"<key>|<seed>|<j>"``; exact in double."""
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)), F.lit(str(j))))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(HASH_SPACE))


def unit_number_sql(key: str, seed: int, j: int) -> str:
    """The same number as DuckDB SQL."""
    digest = f"md5(concat_ws('|', CAST({key} AS VARCHAR), '{seed}', '{j}'))"
    return f"(CAST(CAST(('0x' || substring({digest}, 1, 8)) AS BIGINT) AS DOUBLE) + 0.5) / {float(HASH_SPACE)!r}"


def split_bounds(weights: Sequence[float]) -> list[int]:
    """Upper bucket bounds of all but the last part; weights are normalised."""
    if not weights or any(w < 0 for w in weights) or sum(weights) <= 0:
        raise ValueError(f"weights must be non-negative with a positive sum: {weights!r}")
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w
        bounds.append(int(acc / total * HASH_SPACE))
    return bounds


def split_label(bucket: Column, names: Sequence[str], weights: Sequence[float]) -> Column:
    """Name of the part a bucket falls in (a chain of range tests)."""
    if len(names) != len(weights):
        raise ValueError("one name per weight")
    bounds = split_bounds(weights)
    expr = None
    for name, bound in zip(names[:-1], bounds):
        expr = F.when(bucket < F.lit(bound), F.lit(name)) if expr is None else expr.when(bucket < F.lit(bound), F.lit(name))
    return F.lit(names[-1]) if expr is None else expr.otherwise(F.lit(names[-1]))


def split_label_sql(bucket_sql: str, names: Sequence[str], weights: Sequence[float]) -> str:
    bounds = split_bounds(weights)
    arms = " ".join(f"WHEN {bucket_sql} < {b} THEN '{n}'" for n, b in zip(names[:-1], bounds))
    return f"CASE {arms} ELSE '{names[-1]}' END" if arms else f"'{names[-1]}'"
