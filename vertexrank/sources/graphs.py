"""Graphs derived from the benchmark tables, used by tests, queries and the bench.

* ``returned_part_chain``: part -> next returned part within an order (line order).
* ``part_chain``: the same over every line item.
* ``order_chain``: every order as a path, customer -> first part -> ... -> last
  part -> supplier of the last line; customers are sources, suppliers dangling,
  and parts a densely linked core (ids prefixed ``c``/``p``/``s``).
* ``customer_supplier``: customer -> supplier for every line item of an order;
  ids are prefixed (``c``/``s``) because the two keys share one number space.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.succession import HOT_GROUP_ROWS, split_large_groups, successor_pairs
from ..session import scratch_path
from .edges import normalize_edges


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def part_chain_edges(lineitem: DataFrame, returned_only: bool = True) -> DataFrame:
    """Edge from each line's part to the part of the next line of the same order.

    Lines are ordered by line number, then part and supplier key (the line
    number alone is not unique). Part key 0 is the sentinel and drops out.
    The "next line" is found without a per-order window, so an order with a
    huge number of lines is still split across tasks (``successor_pairs``).
    """
    li = lineitem
    if returned_only:
        li = li.where(F.col("l_returnflag") == "R")
    pairs = successor_pairs(li, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], "l_partkey")
    return normalize_edges(pairs, sentinel=0)


def customer_supplier_edges(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Edge from the customer of an order to each supplier of its line items."""
    li = lineitem.select("l_orderkey", "l_suppkey").distinct()
    o = orders.select("o_orderkey", "o_custkey")
    pairs = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst"),
    )
    return normalize_edges(pairs, sentinel=None)


def order_chain_edges(orders: DataFrame, lineitem: DataFrame, hot_group_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Edges along every order: customer, its parts in line order, last supplier.

    The lines are dealt by order once. There a line sees whether it is the first or
    the last of its order, which gives its edge (to the next part, or to the
    supplier), and the order's customer is joined in place. The lines of orders
    with more than ``hot_group_rows`` lines take the path that splits an order
    over tasks instead: first and last line from a partial aggregate, the pairs
    from :func:`successor_pairs`.
    """
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    edge = lambda src, dst: F.struct(src.alias("src"), dst.alias("dst"))
    lines = lineitem.where("l_orderkey IS NOT NULL").select("l_orderkey", *order)
    buyers = orders.select("o_orderkey", "o_custkey")
    of_order = F.col("l_orderkey") == F.col("o_orderkey")
    lines, large = split_large_groups(lines, "l_orderkey", hot_group_rows)
    within = Window.partitionBy("l_orderkey").orderBy(*order)
    placed = lines.withColumns(
        {
            "first": F.lag("l_orderkey").over(within).isNull(),
            "last": F.lead("l_orderkey").over(within).isNull(),
            "next": F.lead("l_partkey").over(within),
        }
    ).join(buyers, of_order, "left")
    onward = edge(name("p", "l_partkey"), F.when(F.col("last"), name("s", "l_suppkey")).otherwise(name("p", "next")))
    bought = edge(F.when(F.col("first"), name("c", "o_custkey")), name("p", "l_partkey"))
    edges = placed.select(F.inline(F.array(onward, bought)))
    if large is not None:
        line = F.struct(*order)
        ends = large.groupBy("l_orderkey").agg(F.min(line).alias("a"), F.max(line).alias("z"))
        buys = ends.join(buyers, of_order).select(name("c", "o_custkey").alias("src"), name("p", "a.l_partkey").alias("dst"))
        ships = ends.select(name("p", "z.l_partkey").alias("src"), name("s", "z.l_suppkey").alias("dst"))
        parts = successor_pairs(large, "l_orderkey", order, "l_partkey").select(name("p", "src").alias("src"), name("p", "dst").alias("dst"))
        edges = edges.unionByName(buys).unionByName(parts).unionByName(ships)
    return normalize_edges(edges, sentinel=None)


def order_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The F graph, derived once: its clean, distinct edges are written as Parquet
    into the shared checkpoint folder, and every reader starts from there."""
    path = scratch_path(spark, "order-chain")
    order_chain_edges(load_table(spark, sf_dir, "orders"), load_table(spark, sf_dir, "lineitem")).write.parquet(path)
    return spark.read.parquet(path)


def returned_part_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_chain_edges(load_table(spark, sf_dir, "lineitem"), returned_only=True)


def part_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_chain_edges(load_table(spark, sf_dir, "lineitem"), returned_only=False)


def customer_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_supplier_edges(
        load_table(spark, sf_dir, "orders"), load_table(spark, sf_dir, "lineitem")
    )
