"""N-gram Jaccard join by multiple-global-order filtering.

Two texts link when the Jaccard similarity of their sets of word shingles
reaches ``share`` per cent. Under any global order of the shingles, two such
sets share one of their first ``p = n - ceil(share * n / 100) + 1`` shingles.
Here that must hold under several orders at once:

* order k puts a fixed share of the shingle hashes first (a third more than the
  longest prefix: a fifth at 85 per cent), by ascending class
  of document frequency (the logarithm of the count, singles first) and, within
  a class, by a hash of its own; the other shingles follow by hash;
* only that share (and, for short texts, the few shingles beyond it that a
  prefix reaches) is ever shuffled and counted; shingles of one text are
  dropped, since no other text can share them, but keep their place in every
  prefix. Most texts without a near copy have prefixes of singles only, and
  leave the join here;
* texts that share a shingle of their prefixes in the first order meet in
  families (see ``linking``); a pair of a family is a candidate if its prefixes
  also intersect under all other orders, and is verified on the whole sets.

Texts with equal sets are one node (a 64-bit fingerprint of the set), so
copies are never expanded into pairs. Shingles are compared by 64-bit hashes.

Defined cases: null, empty or wordless texts have no shingles and link with
nothing, not even each other; a text of fewer than ``n`` words has its whole
sequence as one shingle; repeated rows (also of one doc_id) are copies; a null
``doc_id`` takes part but is never a component id unless its whole component
has none; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, final, join_checked, list_of, released, scratch, utf8
from .hashing import U, as_long, distinct_sets, mix, range_sums, shingles
from .linking import link_groups

ORDERS = 3


def counted_below(share: int) -> int:
    """Hashes below this are counted: 4/3 of a prefix's share of all shingles."""
    return (1 << 64) * 4 * (100 - share) // 300


def prefix_length(n: np.ndarray, share: int) -> np.ndarray:
    return n - -(-share * n // 100) + 1


def _profile(n: int, share: int):
    def make(part: pa.RecordBatch) -> dict:
        data, offsets = utf8(part.column("text"))
        values, ranges = distinct_sets(*shingles(data, offsets, n))
        size = np.diff(ranges)
        low = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values < U(counted_below(share)), out=low[1:])
        counted = low[ranges[1:]] - low[ranges[:-1]]
        taken = np.where(size > 0, np.maximum(counted, np.minimum(prefix_length(size, share), size)), 0)
        row = np.repeat(np.arange(len(size)), taken)
        begin = np.zeros(len(size) + 1, np.int64)
        np.cumsum(taken, out=begin[1:])
        at = ranges[:-1][row] + np.arange(begin[-1]) - begin[:-1][row]
        node = mix(range_sums(mix(values ^ U(0x5851F42D4C957F2D)), ranges) + size.astype(U))
        return {
            **{c: part.column(c) for c in part.schema.names if c != "text"},
            "n": size,
            "node": pa.array(as_long(node), pa.int64(), mask=size == 0),
            "counted": counted.astype(np.int32),
            "tokens": list_of(as_long(values[at]), begin, pa.int64()),
        }

    return make


def _sets(n: int):
    return lambda column: distinct_sets(*shingles(*utf8(column), n))


def _node_texts(n: int):
    def make(part: pa.RecordBatch) -> dict:
        values, ranges = distinct_sets(*shingles(*utf8(part.column("text")), n))
        node = mix(range_sums(mix(values ^ U(0x5851F42D4C957F2D)), ranges) + np.diff(ranges).astype(U))
        return {"id": as_long(node), "text": part.column("text")}

    return make


def ngram_components(docs: DataFrame, n: int = 4, share: int = 85, orders: int = ORDERS, by_text: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``
    (columns ``doc_id, text``): the number of distinct n-word shingles and the
    smallest ``doc_id`` reachable by links, its own included. With ``by_text``
    also ``th``, the hash of the row's text, and ``component``, an id of the texts
    linked with it (null without shingles)."""
    docs = docs.select("doc_id", "text")
    rows, key, own = (docs.withColumn("th", F.xxhash64("text")), ", th long", ["th"]) if by_text else (docs, "", [])
    group = ["component"] if by_text else []
    profile = arrow_map(
        rows, "text", _profile(n, share), f"doc_id long{key}, n long, node long, counted int, tokens array<bigint>"
    ).persist(StorageLevel.MEMORY_AND_DISK)
    first = profile.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("counted").alias("counted"), F.first("tokens").alias("tokens")
    )
    nodes = first.persist(StorageLevel.MEMORY_AND_DISK)
    with scratch(docs.sparkSession), released(profile, nodes):
        entry = nodes.select("node", "counted", F.posexplode("tokens").alias("pos", "token"))
        shared = cut(entry.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"))
        hits = entry.join(shared, "token").select("node", (F.col("pos") < F.col("counted")).alias("low"), "token", "df")
        held = hits.groupBy("node").agg(
            F.collect_list(F.when(F.col("low"), F.struct(F.floor(F.log2("df")).cast("int").alias("c"), "token"))).alias("low"),
            F.collect_list(F.when(~F.col("low"), F.col("token"))).alias("high"),
        )
        held = held.join(nodes.select("node", "n", "counted"), "node")
        p = F.col("n") - F.ceil(F.lit(share) * F.col("n") / 100) + 1
        singles = F.col("counted") - F.size("low")
        room = (F.least(p, F.col("counted").cast("long")) - singles).cast("int")
        prefixes = []
        for k in range(orders):
            ranked = F.array_sort(
                F.transform("low", lambda t, k=k: F.struct(t["c"].alias("c"), F.xxhash64(t["token"], F.lit(k)).alias("h"), t["token"].alias("token")))
            )
            near = F.transform(F.slice(ranked, 1, F.greatest(room, F.lit(0))), lambda t: t["token"])
            far = F.when(p > F.col("counted"), F.col("high")).otherwise(F.array().cast("array<bigint>"))
            prefixes.append(F.concat(near, far).alias(f"p{k}"))
        held = cut(held.select(F.col("node").alias("id"), "n", *prefixes).where(F.size("p0") > 0))
        groups = cut(held.select(F.explode("p0").alias("key"), "id"))

        def texts_of(ids: DataFrame) -> DataFrame:
            ids = cut(ids)
            wanted = cut(nodes.join(ids, nodes["node"] == ids["id"]).select("doc_id").distinct())
            rows = join_checked(docs, wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi", 24)
            found = arrow_map(rows, "text", _node_texts(n), "id long, text string").join(ids, "id", "left_semi")
            return cut(found.groupBy("id").agg(F.first("text").alias("text")))

        joined = link_groups(groups, texts_of, _sets(n), share, held.drop("n", "p0"))
        of_node = nodes.select("node", "doc_id").join(joined, nodes["node"] == joined["id"], "left")
        of_node = of_node.select("node", "doc_id", F.coalesce("component", "node").alias("component"))
        least = of_node.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        of_node = cut(of_node.join(least, "component").select("node", "component_id", *group))
        out = profile.select("doc_id", *own, F.col("n").alias("n_shingles"), "node").join(of_node, "node", "left")
        return final(out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), *own, *group))
