"""A graph laid out on disk, for any number of rank runs.

``save_graph`` writes, under one folder:

* ``edges``: ``src, dst, from_source``, bucketed by ``src`` into ``n`` files, each
  sorted by ``src``;
* ``hub_edges``: the same columns for sources above the hub threshold, spread over
  ``n`` files;
* ``vertices``: ``id, out_degree, in_degree, source_in``, bucketed by ``id`` into
  ``n`` files;
* ``about``: one row of counts, written last; a folder without it is unfinished.

A run reads the buckets as the hash partitions the loop needs, so neither cleaning,
nor degrees, nor an exchange of the edges is repeated; and cached edges lost with
an executor are read again from their bucket, not derived again from the source.
The buckets are plain Parquet files: the table over them is declared anew in each
session (``open_graph``), no metastore has to remember it.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sums import order_free_sum
from ..operators.topology import degree_table, join_source
from ..session import list_folder, path_exists, sql_conf
from ..sources.edges import normalize_edges
from .layout import STATE_COLUMNS, GraphLayout, _count_stats, choose_hubs, choose_partitions
from .lineage import cut_lineage, keep, release

# Read buckets as partitions even where a single plan does not need them (the
# cached edges are joined later), and trust their order: one sorted file each.
BUCKETED_READ = {
    "spark.sql.sources.bucketing.enabled": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


@dataclass(frozen=True)
class SavedGraph:
    """A folder written by :func:`save_graph`."""

    spark: SparkSession
    path: str
    num_partitions: int
    hot_threshold: int
    n_vertices: int
    n_edges: int
    n_dangling: int
    n_sources: int
    n_hot: int
    id_type: str

    @property
    def _edge_columns(self) -> str:
        return f"src {self.id_type}, dst {self.id_type}, from_source BOOLEAN"

    def _bucketed(self, name: str, key: str, columns: str, tables: list[str]) -> DataFrame:
        """The bucketed files as a table of this session (dropped with the layout)."""
        folder = f"{self.path}/{name}"
        table = f"vertexrank_{os.urandom(8).hex()}"
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
            f"INTO {self.num_partitions} BUCKETS LOCATION '{folder}'"
        )
        tables.append(table)
        return self.spark.table(table)

    def layout(self, *, prune_sources: bool = False, initial_rank: float = 1.0) -> GraphLayout:
        """The loop's layout; run inside a settings scope as ``rank`` does."""
        spark, cached, tables = self.spark, [], []
        spark.conf.set("spark.sql.shuffle.partitions", str(self.num_partitions))
        wanted = ~F.col("from_source") if prune_sources else F.lit(True)
        with sql_conf(spark, BUCKETED_READ):
            cold = hot = state = factored = None
            if self.n_vertices:
                cold = keep(self._bucketed("edges", "src", self._edge_columns, tables).where(wanted).select("src", "dst"), cached)
                if cold.isEmpty():
                    cold = None
                if self.n_hot:
                    hot = keep(spark.read.schema(self._edge_columns).parquet(f"{self.path}/hub_edges").where(wanted).select("src", "dst"), cached)
                    if hot.isEmpty():
                        hot = None
                # renamed: a column that keeps its table's name loses the partitioning when the
                # checkpointed state meets itself in the step's join
                columns = f"id {self.id_type}, out_degree BIGINT, in_degree BIGINT, source_in DOUBLE"
                vertices = self._bucketed("vertices", "id", columns, tables).withColumnRenamed("id", "vertex")
                r0 = F.lit(float(initial_rank))
                here = {
                    "is_dangling": F.col("out_degree") == 0,
                    "is_hot": F.col("out_degree") > self.hot_threshold,
                    "source_in": F.col("source_in") if prune_sources else F.lit(0.0),
                    "rank": r0,
                    "prev_rank": r0,
                }
                inner = vertices.where(F.col("in_degree") > 0) if prune_sources else vertices
                state = cut_lineage(inner.withColumns(here).select(*STATE_COLUMNS))
                if prune_sources:
                    factored = cut_lineage(vertices.where(F.col("in_degree") == 0).select("vertex"))
        return GraphLayout(
            num_partitions=self.num_partitions, strategy="shuffle", prune_sources=prune_sources, hot_threshold=self.hot_threshold,
            n_vertices=self.n_vertices, n_edges=self.n_edges, n_dangling=self.n_dangling, n_sources=self.n_sources, n_hot=self.n_hot,
            n_state=self.n_vertices - (self.n_sources if prune_sources else 0),
            cold_edges=cold, hot_edges=hot, state=state, factored=factored, cached=cached, tables=tables,
        )


def save_graph(
    edges: DataFrame, path: str, *, num_partitions: int | None = None, hot_threshold: int | None = None, order_free: bool = False,
    distinct: bool = False,
) -> SavedGraph:
    """Clean ``edges`` (``src, dst``; null and repeated ones go, unless ``distinct`` says
    that there are none) and lay them out under ``path``, a folder not yet in use. At most ``num_partitions`` sources are
    hubs by default (out-degree above an even share of the edges); a given ``hot_threshold`` is
    raised where its hubs would be too many to broadcast."""
    spark, path = edges.sparkSession, path.rstrip("/")
    if path_exists(spark, path):
        raise FileExistsError(f"path is in use: {path}")
    caches: list[DataFrame] = []
    try:
        clean = keep(edges.select("src", "dst") if distinct else normalize_edges(edges, sentinel=None), caches)
        n_edges = clean.count()
        n = num_partitions or choose_partitions(
            n_edges, int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
        )
        with sql_conf(spark, {"spark.sql.shuffle.partitions": str(n)}):
            degrees = keep(degree_table(clean), caches)
            stats = _count_stats(degrees)
            threshold, n_hot = choose_hubs(degrees, n_edges, n, hot_threshold)
            is_hot = F.col("out_degree") > threshold
            facts = degrees.where("out_degree > 0").select(F.col("vertex").alias("src"), "out_degree", (F.col("in_degree") == 0).alias("from_source"))
            tagged = keep(join_source(clean, facts), caches)
            columns = ["src", "dst", "from_source"]
            _write_buckets(tagged.where(~is_hot).select(*columns), f"{path}/edges", "src", n)
            tagged.where(is_hot).select(*columns).repartition(n, "src", "dst").write.parquet(f"{path}/hub_edges")
            share = tagged.where("from_source").select(F.col("dst").alias("vertex"), (F.lit(1.0) / F.col("out_degree")).alias("w"))
            inflow = share.groupBy("vertex").agg((order_free_sum("w") if order_free else F.sum("w")).alias("source_in"))
            vertices = degrees.select("vertex", "out_degree", "in_degree").join(inflow, "vertex", "left")
            vertices = vertices.withColumn("source_in", F.coalesce("source_in", F.lit(0.0))).withColumnRenamed("vertex", "id")
            _write_buckets(vertices, f"{path}/vertices", "id", n)
            about = {"num_partitions": n, "hot_threshold": threshold, "n_hot": n_hot}
            about |= {c: stats[c] for c in ("n_vertices", "n_edges", "n_dangling", "n_sources")}
            id_type = F.lit(dict(clean.dtypes)["src"]).alias("id_type")
            one = spark.range(1).select(*[F.lit(int(v)).cast("long").alias(c) for c, v in about.items()], id_type)
            one.write.parquet(f"{path}/about")
    finally:
        release(caches)
    return open_graph(spark, path)


def _write_buckets(rows: DataFrame, folder: str, key: str, n: int) -> None:
    """One sorted file per bucket: a task holds exactly the rows of one."""
    spark, table = rows.sparkSession, f"vertexrank_{os.urandom(8).hex()}"
    rows.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", folder).format("parquet").saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")  # the table only: its files are at a path of their own


def open_graph(spark: SparkSession, path: str) -> SavedGraph:
    """The graph :func:`save_graph` wrote under ``path``."""
    path = path.rstrip("/")
    if "_SUCCESS" not in list_folder(spark, f"{path}/about"):
        raise FileNotFoundError(f"no finished graph: {path}")
    return SavedGraph(spark, path, **spark.read.parquet(f"{path}/about").first().asDict())
