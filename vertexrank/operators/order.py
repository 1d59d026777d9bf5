"""Global order of ranks: ascending rank, vertex id breaking ties."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.lineage import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row in partition


def order_ranks(ranks: DataFrame) -> DataFrame:
    """Sort ascending by rank, then vertex (range-partitioned global sort)."""
    return ranks.orderBy(F.col("rank").asc(), F.col("vertex").asc())


def number_rows(df: DataFrame, keys: list[str], name: str, num_partitions: int | None = None, start: int = 0) -> DataFrame:
    """``df`` with a column ``name``: consecutive numbers from ``start`` in the order
    of ``keys`` (which tell all rows apart), computed in parallel.

    The rows are range-partitioned and sorted within partitions, then
    checkpointed so partition contents are fixed. A partition's first number
    is the number of rows in all earlier partitions: one count per partition
    (a table with one row per partition, summed with a running window), joined
    back as a broadcast of that bounded table. No row passes through a single
    task or the driver.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(k).asc() for k in keys]
    ordered = cut_lineage(df.repartitionByRange(n, *by).sortWithinPartitions(*by))
    tagged = ordered.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_id"))
    sizes = tagged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_off"))
    in_part = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return tagged.join(F.broadcast(offsets), "_p").select(
        *df.columns, (F.col("_off") + in_part + F.lit(start)).cast("long").alias(name)
    )


def with_positions(ranks: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Ranks in global order with a 1-based ``position`` (see :func:`number_rows`)."""
    return number_rows(ranks.select("vertex", "rank"), ["rank", "vertex"], "position", num_partitions, start=1)
