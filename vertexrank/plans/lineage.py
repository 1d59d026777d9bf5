"""Cutting lineage and releasing cached tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..session import checkpoint_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into the session's shared checkpoint folder.

    The result keeps the hash partitioning of ``df``'s physical plan, so a
    state written here still joins its co-partitioned edge table without an
    exchange, and a lost executor costs a re-read, not a replay of every
    earlier iteration.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def keep(df: DataFrame, registry: list[DataFrame]) -> DataFrame:
    """Persist ``df`` (memory, spilling to disk) and remember it for release."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    registry.append(df)
    return df


def release(registry: list[DataFrame]) -> None:
    while registry:
        registry.pop().unpersist(blocking=False)
