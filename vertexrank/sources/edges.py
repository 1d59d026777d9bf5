"""Edge sources: text edge lists and key columns of any table.

Every function returns a lazy DataFrame ``src, dst``; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import (
    SENTINEL,
    field,
    is_well_formed,
    line_fields,
    not_sentinel,
    strip_quotes,
)


def read_edge_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines of one or more text files (a path or a list of paths), one row per line (column ``value``).

    ``read.text`` rather than ``read.csv``: the CSV reader would keep doubled
    quotes and skip blank lines, which then could not be counted as malformed.
    """
    return spark.read.text(path)


def parse_edge_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Well-formed lines as ``src, dst`` strings (duplicates and sentinel kept).

    Fields 0 and 1 of the TAB split are used, further fields are ignored, and all
    outer double quotes are stripped; spaces are part of the id.
    """
    fields = line_fields(F.col(value_col))
    return (
        lines.select(fields.alias("_f"))
        .where(is_well_formed(F.col("_f")))
        .select(
            strip_quotes(field(F.col("_f"), 0)).alias("src"),
            strip_quotes(field(F.col("_f"), 1)).alias("dst"),
        )
    )


def edge_line_report(lines: DataFrame, value_col: str = "value", sentinel=SENTINEL) -> DataFrame:
    """One row of counts: lines read, malformed lines, lines naming the sentinel.

    A malformed line (under two fields) would stop the original job; here it is
    dropped and counted. One pass with a partial aggregate.
    """
    fields = line_fields(F.col(value_col))
    parsed = lines.select(fields.alias("_f")).select(
        is_well_formed(F.col("_f")).alias("ok"),
        strip_quotes(field(F.col("_f"), 0)).alias("src"),
        strip_quotes(field(F.col("_f"), 1)).alias("dst"),
    )
    sentinel_hit = F.col("ok") & ~(not_sentinel(F.col("src"), sentinel) & not_sentinel(F.col("dst"), sentinel))
    return parsed.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(~F.col("ok")).alias("n_malformed"),
        F.count_if(F.col("ok")).alias("n_parsed"),
        F.count_if(sentinel_hit).alias("n_sentinel"),
    )


def sort_edge_lines(lines: DataFrame, value_col: str = "value", sentinel=SENTINEL) -> DataFrame:
    """Every line with what becomes of it: ``src, dst, value, problem``.

    ``problem`` is null for an edge, else ``malformed`` (under two fields; no
    ``src, dst``) or ``sentinel`` (one end is the sentinel id). Rejected lines keep
    their text in ``value``; edges do not carry it.
    """
    fields = line_fields(F.col(value_col))
    parsed = lines.select(fields.alias("_f"), F.col(value_col).alias("_line"))
    ok = F.coalesce(is_well_formed(F.col("_f")), F.lit(False))  # a null line is malformed
    parsed = parsed.select(
        "_line", ok.alias("_ok"), *[F.when(ok, strip_quotes(field(F.col("_f"), i))).alias(c) for i, c in enumerate(("src", "dst"))]
    )
    kept = not_sentinel(F.col("src"), sentinel) & not_sentinel(F.col("dst"), sentinel)
    problem = F.when(~F.col("_ok"), "malformed").when(~kept, "sentinel")
    return parsed.select("src", "dst", F.when(problem.isNotNull(), F.col("_line")).alias("value"), problem.alias("problem"))


def store_edge_lines(lines: DataFrame, folder: str, value_col: str = "value", sentinel=SENTINEL) -> tuple[DataFrame, DataFrame]:
    """Edges and rejected lines from one scan of ``lines``.

    The sorted lines are written once under ``folder`` (a path not yet in use),
    parted by ``outcome``; returned are the clean, distinct edges and the rejects
    ``value, problem``, each reading only its own part.
    """
    spark = lines.sparkSession
    outcome = F.when(F.col("problem").isNull(), "edge").otherwise("reject").alias("outcome")
    sorted_lines = sort_edge_lines(lines, value_col, sentinel).select("*", outcome)
    sorted_lines.write.partitionBy("outcome").parquet(folder)
    stored = spark.read.schema(sorted_lines.schema).parquet(folder)
    edges = stored.where("outcome = 'edge'").select("src", "dst")
    return normalize_edges(edges, sentinel=None), stored.where("outcome = 'reject'").select("value", "problem")


def normalize_edges(
    edges: DataFrame, src: str = "src", dst: str = "dst", sentinel=SENTINEL
) -> DataFrame:
    """Clean an edge list: drop nulls and edges touching ``sentinel``, then
    collapse duplicates. Self-loops are kept (they count as an out-edge).

    The ``distinct`` runs as a partial aggregate before its shuffle, so heavily
    repeated edges are collapsed map-side. ``sentinel=None`` keeps every id.
    """
    cols = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    if isinstance(sentinel, str) and dict(cols.dtypes)["src"] != "string":
        sentinel = int(sentinel)
    return (
        cols.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .where(not_sentinel(F.col("src"), sentinel) & not_sentinel(F.col("dst"), sentinel))
        .distinct()
    )


def read_edges(spark: SparkSession, path: str | list[str], sentinel=SENTINEL) -> DataFrame:
    """Text edge list to a clean, distinct ``src, dst`` string edge table."""
    return normalize_edges(parse_edge_lines(read_edge_lines(spark, path)), sentinel=sentinel)


def edges_from_table(
    table: DataFrame, src_col: str, dst_col: str, sentinel=None
) -> DataFrame:
    """Edges from two key columns of any table, keeping the columns' type and
    every id (the sentinel ``0`` is a rule of text files; pass it to apply it).

    Only the two columns are selected, so a parquet scan reads just those.
    """
    return normalize_edges(table, src_col, dst_col, sentinel=sentinel)
