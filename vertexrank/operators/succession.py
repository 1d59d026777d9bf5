"""Next row within a group, without gathering any group into one task.

``successor_pairs`` gives, for rows ordered by ``(group, *order)``, the pair
(value of a row, value of the next row of the same group) - what
``lead(value) OVER (PARTITION BY group ORDER BY order)`` gives, minus the last
row of each group. A window per group would send every row of a group to one
task; a group holding a third of the data would make that task a straggler.
Here:

1. rows are dealt by range of ``(group, *order)``, so a large group is split
   over several ranges, and written once with their range number: everything
   below reads that one evaluation, whatever Spark reuses or samples anew;
2. ``lead`` runs per (range, group), at most a range's rows;
3. the last row of each range is paired with the first row of the next one,
   from a table of one row per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.lineage import cut_lineage
from ..session import scratch_path

HOT_GROUP_ROWS = 1_000_000  # rows of one group that a task may hold; larger groups are split


def split_large_groups(df: DataFrame, group: str, most: int = HOT_GROUP_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the groups with at most ``most`` rows, which may be dealt by group, and
    those of all larger ones (``None`` if there are none). ``group`` is not null.

    The sizes come from a partial aggregate over the one column; at most one group
    per ``most`` rows is large, so their keys may be broadcast.
    """
    large = cut_lineage(df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(group))
    if large.isEmpty():
        return df, None
    return df.join(F.broadcast(large), group, "left_anti"), df.join(F.broadcast(large), group, "left_semi")


def successor_pairs(
    df: DataFrame, group: str, order: list[str], value: str, num_partitions: int | None = None
) -> DataFrame:
    """``src, dst``: each row's ``value`` and the next row's, within ``group``
    in ``(group, *order)`` order (rows tied on every key are interchangeable).

    The number of ranges defaults to the session's shuffle partitions.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"_k{i}" for i in range(1 + len(order))]
    path = scratch_path(df.sparkSession, "ranges")
    (
        df.select(*[F.col(c).alias(k) for c, k in zip([group, *order], keys, strict=True)], F.col(value).alias("_v"))
        .repartitionByRange(n, *keys)
        .withColumn("_p", F.spark_partition_id())
        .write.parquet(path)
    )
    dealt = df.sparkSession.read.parquet(path)
    # the value goes last, so that rows tied on every key have one order everywhere
    row = F.struct(*keys, "_v")
    within = Window.partitionBy("_p", "_k0").orderBy(*keys[1:], "_v")
    # a null value of the next row and no next row are different things
    inner = dealt.select(F.col("_v").alias("src"), F.lead(F.struct("_v")).over(within).alias("_n")).where("_n IS NOT NULL")
    ends = dealt.groupBy("_p").agg(F.min(row).alias("head"), F.max(row).alias("tail"))
    ends = ends.select("tail", F.lead("head").over(Window.orderBy("_p")).alias("head"))
    cross = ends.where(F.col("head").isNotNull() & F.col("tail._k0").eqNullSafe(F.col("head._k0")))
    return inner.select("src", F.col("_n._v").alias("dst")).unionByName(
        cross.select(F.col("tail._v").alias("src"), F.col("head._v").alias("dst"))
    )
