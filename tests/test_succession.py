from pyspark.sql import Window
from pyspark.sql import functions as F

import pytest

from vertexrank.operators.succession import successor_pairs
from vertexrank.plans.inspect import plan_text, python_nodes, shuffle_count
from vertexrank.session import sql_conf
from vertexrank.sources.graphs import order_chain, order_chain_edges

from .conftest import SF001


def window_lead(df, group, order, value):
    w = Window.partitionBy(group).orderBy(*order)
    return sorted(
        map(tuple, df.select(F.col(value).alias("src"), F.lead(value).over(w).alias("dst"))
            .where("src IS NOT NULL AND dst IS NOT NULL").collect())
    )


def test_matches_window_lead_with_one_hot_group(spark):
    # group 7 holds 60% of the rows and spans many range partitions
    df = spark.range(20000).select(
        F.when(F.col("id") < 12000, F.lit(7)).otherwise(F.col("id") % 37).alias("g"),
        (F.col("id") * 7919 % 20011).alias("o"),
        (F.col("id") * 3).alias("v"),
    )
    got = sorted(map(tuple, successor_pairs(df, "g", ["o"], "v", num_partitions=16).collect()))
    assert got == window_lead(df, "g", ["o"], "v")
    assert len(got) == 20000 - df.select("g").distinct().count()  # all values non-null


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("n", [16, 64])
def test_exact_whatever_is_reused(spark, n, reuse):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    with sql_conf(spark, {"spark.sql.exchange.reuse": reuse}):
        got = sorted(map(tuple, successor_pairs(li, "l_orderkey", order, "l_partkey", num_partitions=n).collect()))
    assert got == window_lead(li, "l_orderkey", order, "l_partkey")


def test_ties_nulls_and_empty_partitions(spark):
    rows = [(1, 1, 10), (1, 1, 10), (1, 2, None), (1, 3, 30), (None, 1, 40), (None, 2, 50), (2, 1, 60)]
    df = spark.createDataFrame(rows, "g long, o long, v long")
    got = sorted(map(tuple, successor_pairs(df, "g", ["o"], "v", num_partitions=12)
                            .where("src IS NOT NULL AND dst IS NOT NULL").collect()))
    assert got == window_lead(df, "g", ["o"], "v")


def test_runs_without_python_udf_rows(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("g"), "id")
    plan = successor_pairs(df, "g", ["id"], "id")
    assert not python_nodes(plan)


def test_order_chain_is_the_same_with_orders_split_over_tasks(spark):
    orders, li = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("orders", "lineitem"))
    # one order without a customer row, one with lines that tie, null keys
    odd = spark.createDataFrame(
        [(-1, 1, 5, 1), (-1, 1, 5, 1), (-1, 2, 6, 2), (-2, 1, 7, None), (-2, 2, None, 3), (None, 1, 8, 4)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long",
    )
    li = li.select(*odd.columns).unionByName(odd)
    whole = sorted(map(tuple, order_chain_edges(orders, li).collect()))
    for most in (3, 0):  # some orders are large, then all are
        assert sorted(map(tuple, order_chain_edges(orders, li, hot_group_rows=most).collect())) == whole
    assert ("p5", "p6") in whole and ("p6", "s2") in whole and len(whole) == len(set(whole))


def test_order_chain_is_derived_once(spark):
    # every reader of the edges used to repeat the whole derivation, exchanges included
    assert shuffle_count(order_chain(spark, SF001)) == 0
    orders, li = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("orders", "lineitem"))
    plan = order_chain_edges(orders, li)
    assert plan_text(plan).count("Window ") == 1 and shuffle_count(plan) <= 3  # lines, orders, distinct
