"""Joins with a table that is small today: broadcast behind a measured size, shuffled beyond it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024

# Counted on top of the text of a row: the fixed part of a row in a hashed relation.
_ROW_OVERHEAD = 64


def is_literal(df: DataFrame) -> bool:
    """Whether the rows of `df` stand in its plan, so that its planned size is its size."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return plan.getClass().getSimpleName() == "LocalRelation"


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's own estimate of the size of `df`; runs no job. For files it is their compressed size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def row_bytes(df: DataFrame):
    text = [F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) for f in df.schema.fields]
    return sum(text, F.lit(_ROW_OVERHEAD)).cast("long")


def fits(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether `df` is proven to be at most `limit` bytes.

    The planned size counts for literal rows only. All else is measured by one distributed aggregate
    that brings back a single number: files may be compressed and rows exploded.
    """
    if is_literal(df) and planned_bytes(df) <= limit // 8:
        return True
    measured = df.select(F.sum(row_bytes(df)).alias("bytes")).first()["bytes"]
    return (measured or 0) <= limit


def lookup(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", limit: int = BROADCAST_BYTES) -> DataFrame:
    """`big` joined with `small` on equal names: a broadcast if `small` is proven to fit, else a shuffle.

    A shuffled join leaves hot keys to AQE, which splits them by their measured size; nothing is copied
    for keys that are not hot.
    """
    return big.join(F.broadcast(small) if fits(small, limit) else small, on, how)
