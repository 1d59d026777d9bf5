"""Long runs over large graphs: the loop on blocks of vertices instead of rows.

A step on rows (``plans/layout.py``) spends most of its time in the hash table that adds
up the shares per target, and shuffles an id with every sum. The edges are the same in
every step, so where each share goes can be laid out once. Vertices are numbered by
partition and place (``block_numbers``; vertices with in-edges come first), and

* ``tiles`` hold the edges of a block of sources, sorted by target and cut by the block of
  the target: places of the sources, where each target's run starts, and the targets;
* ``facts`` have one row per block: its out-degrees, and the inflow from pruned sources;
* ``state`` has one row per block: its ranks.

A step (:func:`block_step`) reads the shares along a tile and adds up its runs, which gives
one sum per tile and target as on rows, without its id (targets go as bits); the sums meet
by block of the target. Tiles, facts and state are hash-partitioned by block, one block per
partition (``block_labels``), so what is shuffled are the sums and the ranks. No block is
joined with another and no task holds more than a block, its edges and the sums it receives.

Only for graphs without hubs: all edges of a source lie in its block.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sums import HI_BITS, LO_BITS, total_sql
from ..operators.dictionary import PLACE_BITS
from ..operators.topology import degree_table
from .layout import choose_partitions, spread_partitions
from .lineage import cut_lineage, keep, release

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

# Fewer edges: a step on rows takes no longer. More blocks: sums have few edges each.
MIN_EDGES = 2_000_000
MAX_BLOCKS = 256
# A block holds arrays of its vertices and of its edges, no hash table.
MAX_EDGES_PER_BLOCK = 48_000_000
TILE_EDGES = 1 << 20
BATCH_ROWS = 8  # tiles or sums that go to a Python worker at a time
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

TILE_SCHEMA = "block long, target long, from_source boolean, sources binary, starts binary, first long, as_bits boolean, places binary"
SUM_SCHEMA = "target long, first long, as_bits boolean, places binary, sums binary, sums_lo binary"
FACT_SCHEMA = "block long, part long, n_state long, degrees binary, source_in binary"
STATE_SCHEMA = "block long, part long, ranks binary, n long, delta double, dmass double, delta_hi long, delta_lo long, dmass_hi long, dmass_lo long"


@dataclass
class BlockLayout:
    n_vertices: int
    n_state: int
    n_dangling: int
    tiles: DataFrame
    facts: DataFrame
    state: DataFrame
    factored: DataFrame | None
    num_partitions: int
    cached: list[DataFrame] = field(default_factory=list)

    def close(self) -> None:
        release(self.cached)


def choose_blocks(n_edges: int, num_partitions: int | None, session_partitions: int, slots: int) -> int | None:
    """Number of blocks, or ``None`` where the loop runs on rows."""
    if n_edges < MIN_EDGES:
        return None
    if num_partitions is None:
        n = min(choose_partitions(n_edges, session_partitions, slots), max(1, min(session_partitions, slots)))
    else:
        n = spread_partitions(n_edges, num_partitions, slots)
    n = max(n, math.ceil(n_edges / MAX_EDGES_PER_BLOCK))
    return n if n <= MAX_BLOCKS else None


def block_numbers(edges: DataFrame, n: int) -> DataFrame:
    """``vertex, id, out_degree, in_degree`` with ``id`` = place * n + part, ``part`` one of ``n``
    and places dense in it, vertices with in-edges first. Written once; another run may
    number the vertices differently."""
    degrees = degree_table(edges).select("vertex", "out_degree", "in_degree").repartition(n, "vertex")
    placed = cut_lineage(degrees.sortWithinPartitions(F.col("in_degree") == 0).withColumn("id", F.monotonically_increasing_id()))
    place = F.col("id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    part = F.shiftright("id", PLACE_BITS)
    return placed.select("vertex", (place * F.lit(n).cast("long") + part).alias("id"), "out_degree", "in_degree")


def block_labels(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` partitions a number that Spark's hash partitioning sends there."""
    part = F.pmod(F.hash("id"), F.lit(n)).alias("part")
    rows = spark.range(64 * n + 64).select("id", part).groupBy("part").agg(F.min("id").alias("id")).collect()
    return [label for _, label in sorted((r.part, r.id) for r in rows)]


def build_blocks(
    edges: DataFrame, dictionary: DataFrame, n: int, *, prune_sources: bool, initial_rank: float, order_free: bool
) -> BlockLayout:
    """Lay out ``edges`` (``src, dst`` as ids of :func:`block_numbers`). Run inside a settings
    scope as ``rank`` does; sets the partition count and the Arrow batch size."""
    spark = edges.sparkSession
    conf = spark.conf
    conf.set("spark.sql.shuffle.partitions", str(n))
    conf.set(ARROW_ROWS, str(TILE_EDGES))
    labels = block_labels(spark, n)
    label = F.array(*[F.lit(x).cast("long") for x in labels])
    size = F.lit(n).cast("long")
    part_of = lambda c: F.col(c) % size
    place_of = lambda c: F.expr(f"{c} div {n}L")
    block_of = lambda c: F.get(label, part_of(c).cast("int"))
    cached: list[DataFrame] = []
    build: list[DataFrame] = []

    rows = dictionary.select(block_of("id").alias("block"), part_of("id").alias("part"), place_of("id").alias("place"), "out_degree", "in_degree")
    facts = rows.repartition(n, "block").sortWithinPartitions("place").mapInArrow(_facts_of(prune_sources), FACT_SCHEMA)
    facts = keep(facts.repartition(n, "block").sortWithinPartitions("block"), build if prune_sources else cached)
    counts = {r.part: r.n_state for r in facts.select("part", "n_state").collect()}

    # sorted by block of the target and its place; with pruning the edges of sources apart
    key = part_of("dst") * F.lit(1 << PLACE_BITS) + place_of("dst")
    if prune_sources:
        receivers = F.array(*[F.lit(counts.get(p, 0)).cast("long") for p in range(n)])
        from_source = place_of("src") >= F.get(receivers, part_of("src").cast("int"))
        key = key + F.when(from_source, F.lit(1 << 62)).otherwise(F.lit(0))
    keyed = edges.select(block_of("src").alias("block"), place_of("src").cast("int").alias("source"), key.cast("long").alias("key"))
    tiles = keyed.repartition(n, "block").sortWithinPartitions("key").mapInArrow(_tiles_of(labels), TILE_SCHEMA)
    tiles = keep(tiles.repartition(n, "block").sortWithinPartitions("block"), cached)
    tiles.count()
    conf.set(ARROW_ROWS, str(BATCH_ROWS))

    factored = None
    if prune_sources:
        ones = facts.select("block", "degrees", F.lit(None).cast("binary").alias("ranks"))
        sums = _sums(tiles.where("from_source"), ones, order_free)
        facts = sums.groupBy("target").cogroup(facts.groupBy("block")).applyInArrow(_source_in_of(order_free), FACT_SCHEMA)
        facts = keep(facts.repartition(n, "block").sortWithinPartitions("block"), cached)
        facts.count()
        factored = cut_lineage(dictionary.where(F.col("in_degree") == 0).select("vertex"))
        tiles = tiles.where(~F.col("from_source"))
    state = cut_lineage(facts.mapInArrow(_first_of(initial_rank), STATE_SCHEMA))
    about = dictionary.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("out_degree") == 0).alias("dangling")).first()
    release(build)
    return BlockLayout(
        n_vertices=about.n, n_state=sum(counts.values()), n_dangling=about.dangling, tiles=tiles, facts=facts, state=state,
        factored=factored, num_partitions=n, cached=cached,
    )


def block_step(
    layout: BlockLayout, state: DataFrame, *, self_loop: bool, damping: float, mass: float, source_rank: float | None, order_free: bool
) -> DataFrame:
    """Next state (lazy): the recurrence of ``layout_step``, the same operations per vertex."""
    base = layout.facts.join(_sized_anew(state).select("block", "ranks").hint("merge"), "block")
    sums = _sums(layout.tiles, base, order_free)
    finish = _finish_of(self_loop, damping, mass, source_rank, order_free)
    return sums.groupBy("target").cogroup(base.groupBy("block")).applyInArrow(finish, STATE_SCHEMA)


def block_measures(order_free: bool) -> tuple:
    """Aggregates over a state: L1 change, rank of dangling vertices, vertices."""
    if order_free:
        total = lambda name: F.expr(total_sql(f"sum({name}_hi)", f"sum({name}_lo)"))
    else:
        total = F.sum
    return (
        F.coalesce(total("delta"), F.lit(0.0)).alias("delta"),
        F.coalesce(total("dmass"), F.lit(0.0)).alias("dmass"),
        F.sum("n").alias("rows"),
    )


def block_ranks(layout: BlockLayout, state: DataFrame) -> DataFrame:
    """``vertex`` (the id), ``rank`` of a state."""
    return state.select("part", "ranks").mapInArrow(_ranks_of(layout.num_partitions), "vertex long, rank double")


def _sized_anew(state: DataFrame) -> DataFrame:
    """The checkpointed rows without the size Spark estimated for them: it multiplies the
    sizes of what is joined, and the state is on both sides of a step, so the estimate would
    have twice as many digits after every step."""
    spark = state.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(state._jdf.toJavaRDD(), state._jdf.schema()), spark)


def _sums(tiles: DataFrame, base: DataFrame, order_free: bool) -> DataFrame:
    """One row per tile: the sums of the shares that its targets receive."""
    return tiles.groupBy("block").cogroup(base.groupBy("block")).applyInArrow(_send_of(order_free), SUM_SCHEMA)


# ------------------------------------------------------------------ inside tasks


def _limbs(values):
    """The two integers of ``functions/sums.py``."""
    hi = np.floor(values * float(1 << HI_BITS))
    lo = np.rint((values - hi * 2.0**-HI_BITS) * float(1 << LO_BITS))
    return hi.astype(np.int64), lo.astype(np.int64)


def _total(hi, lo):
    return hi.astype(np.float64) * 2.0**-HI_BITS + lo.astype(np.float64) * 2.0**-LO_BITS


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.table({name: pa.array(c, types[t]) for (name, t), c in zip(fields, columns, strict=True)})


def _array(value, dtype=np.float64):
    return np.frombuffer(value.as_buffer(), dtype) if value.is_valid else None


def _facts_of(prune_sources: bool):
    def facts(batches):
        parts = [b for b in batches if b.num_rows]
        if parts:
            rows = pa.Table.from_batches(parts)
            n_state = int(np.count_nonzero(rows.column("in_degree").to_numpy() > 0)) if prune_sources else rows.num_rows
            degrees = rows.column("out_degree").to_numpy().astype(np.float64)
            row = (rows.column("block")[0].as_py(), rows.column("part")[0].as_py(), n_state, degrees.tobytes(), None)
            yield from _table(FACT_SCHEMA, [row]).to_batches()

    return facts


def _tiles_of(labels: list[int]):
    def tiles(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            key, source = batch.column("key").to_numpy(), batch.column("source").to_numpy()
            block = batch.column("block")[0].as_py()
            group, place = key >> PLACE_BITS, key & ((1 << PLACE_BITS) - 1)
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(key)]
            out = []
            for a, z in zip(cuts, cuts[1:], strict=False):
                to = place[a:z]
                starts = np.flatnonzero(np.diff(to, prepend=-1))
                at = to[starts]
                first, span = int(at[0]), int(at[-1] - at[0]) + 1
                as_bits = span <= 32 * len(at)  # a bit per place, or four bytes per target
                if as_bits:
                    bits = np.zeros(span, np.uint8)
                    bits[at - first] = 1
                    places = np.packbits(bits).tobytes()
                else:
                    places = (at - first).astype(np.uint32).tobytes()
                which = int(group[a])
                from_source = bool(which >> (62 - PLACE_BITS))
                target = labels[which & ((1 << (62 - PLACE_BITS)) - 1)]
                out.append((block, target, from_source, source[a:z].astype(np.int32).tobytes(), starts.astype(np.int32).tobytes(), first, as_bits, places))
            yield from _table(TILE_SCHEMA, out).to_batches()

    return tiles


def _first_of(initial_rank: float):
    def first(batches):
        for batch in batches:
            rows = [
                (block.as_py(), part.as_py(), np.full(n.as_py(), initial_rank, np.float64).tobytes(), n.as_py(), 0.0, 0.0, 0, 0, 0, 0)
                for block, part, n in zip(batch.column("block"), batch.column("part"), batch.column("n_state"), strict=True)
            ]
            yield from _table(STATE_SCHEMA, rows).to_batches()

    return first


def _send_of(order_free: bool):
    def send(tiles: pa.Table, base: pa.Table) -> pa.Table:
        out = []
        if tiles.num_rows:
            degrees, ranks = _array(base.column("degrees")[0]), _array(base.column("ranks")[0])
            with np.errstate(divide="ignore", invalid="ignore"):  # no edge leaves a vertex of degree 0
                share = 1.0 / degrees if ranks is None else ranks / degrees[: len(ranks)]
                share = np.where(degrees[: len(share)] > 0, share, 0.0)
            parts = _limbs(share) if order_free else (share,)
            for target, sources, starts, first, as_bits, places in zip(
                *[tiles.column(c) for c in ("target", "sources", "starts", "first", "as_bits", "places")], strict=True
            ):
                along, runs = _array(sources, np.int32), _array(starts, np.int32)
                sums = [np.add.reduceat(p[along], runs).tobytes() for p in parts]
                out.append((target.as_py(), first.as_py(), as_bits.as_py(), places.as_buffer().to_pybytes(), sums[0], sums[1] if order_free else None))
        return _table(SUM_SCHEMA, out)

    return send


def _received(sums: pa.Table, n: int, order_free: bool):
    """What each of the first ``n`` places of a block receives."""
    hi = np.zeros(n, np.int64 if order_free else np.float64)
    lo = np.zeros(n, np.int64) if order_free else None
    for first, as_bits, places, values, values_lo in zip(*[sums.column(c) for c in ("first", "as_bits", "places", "sums", "sums_lo")], strict=True):
        if as_bits.as_py():
            at = np.flatnonzero(np.unpackbits(_array(places, np.uint8)))
        else:
            at = _array(places, np.uint32).astype(np.int64)
        at = at + first.as_py()
        hi[at] += _array(values, hi.dtype)
        if order_free:
            lo[at] += _array(values_lo, np.int64)
    return _total(hi, lo) if order_free else hi


def _source_in_of(order_free: bool):
    def source_in(sums: pa.Table, facts: pa.Table) -> pa.Table:
        block, part, n, degrees, _ = (facts.column(c)[0] for c in facts.column_names)
        received = _received(sums, n.as_py(), order_free)
        return _table(FACT_SCHEMA, [(block.as_py(), part.as_py(), n.as_py(), degrees.as_buffer().to_pybytes(), received.tobytes())])

    return source_in


def _finish_of(self_loop: bool, damping: float, mass: float, source_rank: float | None, order_free: bool):
    base_rank = (1.0 - damping) + damping * mass

    def finish(sums: pa.Table, base: pa.Table) -> pa.Table:
        block, part = base.column("block")[0].as_py(), base.column("part")[0].as_py()
        ranks = _array(base.column("ranks")[0])
        n = len(ranks)
        dangling = _array(base.column("degrees")[0])[:n] == 0
        total = _received(sums, n, order_free)
        if self_loop:
            total = total + np.where(dangling, ranks, 0.0)
        if source_rank is not None:
            total = total + _array(base.column("source_in")[0]) * source_rank
        new = base_rank + damping * total
        change, held = np.abs(new - ranks), new[dangling]
        limbs = [int(x.sum()) for v in (change, held) for x in _limbs(v)] if order_free else [0, 0, 0, 0]
        return _table(STATE_SCHEMA, [(block, part, new.tobytes(), n, float(change.sum()), float(held.sum()), *limbs)])

    return finish


def _ranks_of(n_blocks: int):
    def ranks(batches):
        for batch in batches:
            for part, values in zip(batch.column("part"), batch.column("ranks"), strict=True):
                rank = _array(values)
                for a in range(0, len(rank), TILE_EDGES):
                    some = rank[a : a + TILE_EDGES]
                    ids = np.arange(a, a + len(some), dtype=np.int64) * n_blocks + part.as_py()
                    yield pa.record_batch({"vertex": pa.array(ids), "rank": pa.array(some)})

    return ranks
