"""Rank sinks: text lines, TSV, parquet; per-iteration history; reading back.

Output is written by every task in parallel, in global rank order: part files
taken in name order are ascending. There is no single-file option, which
would send every row through one task; ``part_bytes`` sets the size of the files.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.order import order_ranks
from ..plans.lineage import cut_lineage

FORMATS = ("tuple", "tsv", "parquet")


def format_rank_line(fmt: str):
    """Text of one rank row: ``(vertex,rank)`` or ``vertex<TAB>rank``.

    The double is printed as Spark casts it to text (Java's shortest form that
    reads back to the same value, e.g. ``0.15``, ``1.0E-4``).
    """
    v, r = F.col("vertex").cast("string"), F.col("rank").cast("string")
    if fmt == "tuple":
        return F.concat(F.lit("("), v, F.lit(","), r, F.lit(")"))
    if fmt == "tsv":
        return F.concat(v, F.lit("\t"), r)
    raise ValueError(f"no text form for {fmt!r}")


def _lines(fmt: str) -> Column:
    # an id with a line break would come back as two lines
    broken = F.col("vertex").cast("string").rlike(r"[\r\n]")
    return F.when(broken, F.raise_error(F.lit("vertex id with a line break; write parquet"))).otherwise(format_rank_line(fmt)).cast("string")


def order_in_parts(ranks: DataFrame, part_bytes: int, size: Column, finer: int = 4) -> DataFrame:
    """``ranks`` in ascending order over partitions of about ``part_bytes`` of ``size``.

    The rows are dealt to ``finer`` times as many ranges as parts are needed,
    and the bytes of each range are counted; a part is the ranges that start within
    its share of the running total. A part differs from ``part_bytes`` by at most
    one range: about ``1 / finer`` of it, and whatever the sampled range bounds err.
    """
    by = [F.col("rank").asc(), F.col("vertex").asc()]
    total = ranks.agg(F.sum(size)).first()[0] or 0
    n = max(1, math.ceil(total / part_bytes))
    dealt = cut_lineage(ranks.select("vertex", "rank").repartitionByRange(finer * n, *by)).withColumn("_range", F.spark_partition_id())
    counts = dealt.groupBy("_range").agg(F.sum(size).alias("_bytes"))  # one row per range
    before = F.coalesce(F.sum("_bytes").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = counts.select("_range", F.least(F.floor(before / F.lit(max(total, 1)) * n), F.lit(n - 1)).cast("int").alias("_part"))
    placed = dealt.join(F.broadcast(parts), "_range")
    return placed.repartitionById(n, F.col("_part")).sortWithinPartitions(*by).select("vertex", "rank")


def write_ranks(ranks: DataFrame, path: str, fmt: str = "tuple", mode: str = "error", part_bytes: int | None = None) -> None:
    """Write ranks sorted ascending by rank (vertex breaking ties), in part files of
    about ``part_bytes`` of text each (Parquet: of its text form before
    compression); by default as many files as the session has shuffle partitions."""
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    if part_bytes is not None and part_bytes < 1:
        raise ValueError("part_bytes must be at least 1")
    if part_bytes is None:
        ordered = order_ranks(ranks)
    else:
        ordered = order_in_parts(ranks, part_bytes, F.octet_length(format_rank_line("tsv" if fmt == "parquet" else fmt)) + 1)
    if fmt == "parquet":
        ordered.write.mode(mode).parquet(path)
    else:
        ordered.select(_lines(fmt).alias("value")).write.mode(mode).text(path)


def read_ranks(spark: SparkSession, path: str, fmt: str = "tuple", vertex_type: str = "string") -> DataFrame:
    """Read ranks written by :func:`write_ranks` back as ``vertex, rank``."""
    if fmt == "parquet":
        return spark.read.parquet(path).select("vertex", "rank")
    lines = spark.read.text(path)
    if fmt == "tuple":
        # vertex ids may contain commas: the rank is after the last one
        pattern = r"(?s)^\((.*),([^,]*)\)$"
        v, r = F.regexp_extract("value", pattern, 1), F.regexp_extract("value", pattern, 2)
    elif fmt == "tsv":
        pattern = r"(?s)^(.*)\t([^\t]*)$"
        v, r = F.regexp_extract("value", pattern, 1), F.regexp_extract("value", pattern, 2)
    else:
        raise ValueError(f"fmt must be one of {FORMATS}")
    return lines.select(v.cast(vertex_type).alias("vertex"), r.cast("double").alias("rank"))


def read_rank_history(spark: SparkSession, path: str) -> DataFrame:
    """Per-iteration ranks written by ``rank(..., history_path=...)``:
    ``iteration, vertex, rank`` (iteration 0 is the initial state)."""
    return spark.read.parquet(path).select(F.col("iteration").cast("int"), "vertex", "rank")
