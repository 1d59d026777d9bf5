"""Relational operators: topology, one rank step, the loop, the full rank, order."""

from .topology import (
    adjacency,
    close_dangling,
    compact_adjacency,
    dangling,
    degree_table,
    graph_stats,
    out_degrees,
    source_inflow,
    sources,
    split_sources,
    unpack_neighbours,
    vertices,
    with_in_edges,
    with_out_edges,
)
from .step import contributions, dangling_mass, layout_step, rank_delta, rank_step
from .loop import RankResult, iterate, measure_state
from .order import number_rows, order_ranks, with_positions
from .dictionary import decode_vertices, encode_edges, encode_vertices, vertex_dictionary
from .rank import rank

__all__ = [
    "RankResult",
    "adjacency",
    "close_dangling",
    "compact_adjacency",
    "contributions",
    "dangling",
    "dangling_mass",
    "decode_vertices",
    "degree_table",
    "encode_edges",
    "encode_vertices",
    "graph_stats",
    "iterate",
    "layout_step",
    "measure_state",
    "number_rows",
    "order_ranks",
    "out_degrees",
    "rank",
    "rank_delta",
    "rank_step",
    "source_inflow",
    "sources",
    "split_sources",
    "unpack_neighbours",
    "vertex_dictionary",
    "vertices",
    "with_in_edges",
    "with_out_edges",
    "with_positions",
]
