"""vertexrank: damped random-walk vertex ranking of large directed graphs on Spark.

Build an edge table (``read_edges`` for TAB-separated text, ``edges_from_table``
for key columns of any table), then call ``rank``. Everything is DataFrame
operations; the only driver-side state is a few numbers per iteration.
"""

from .operators import (
    RankResult,
    adjacency,
    close_dangling,
    compact_adjacency,
    contributions,
    dangling,
    dangling_mass,
    decode_vertices,
    degree_table,
    encode_edges,
    graph_stats,
    order_ranks,
    out_degrees,
    rank,
    rank_delta,
    rank_step,
    source_inflow,
    sources,
    split_sources,
    unpack_neighbours,
    vertex_dictionary,
    vertices,
    with_in_edges,
    with_out_edges,
    with_positions,
)
from .plans.saved import SavedGraph, open_graph, save_graph
from .session import build_session, checkpoint_dir
from .sources import (
    edge_line_report,
    edges_from_table,
    normalize_edges,
    parse_edge_lines,
    read_edge_lines,
    read_edges,
    read_rank_history,
    read_ranks,
    sort_edge_lines,
    store_edge_lines,
    write_ranks,
)

__all__ = [
    "RankResult",
    "SavedGraph",
    "adjacency",
    "build_session",
    "checkpoint_dir",
    "close_dangling",
    "compact_adjacency",
    "contributions",
    "dangling",
    "dangling_mass",
    "decode_vertices",
    "degree_table",
    "edge_line_report",
    "edges_from_table",
    "encode_edges",
    "graph_stats",
    "normalize_edges",
    "open_graph",
    "order_ranks",
    "out_degrees",
    "parse_edge_lines",
    "rank",
    "rank_delta",
    "rank_step",
    "read_edge_lines",
    "read_edges",
    "read_rank_history",
    "read_ranks",
    "save_graph",
    "sort_edge_lines",
    "source_inflow",
    "sources",
    "split_sources",
    "store_edge_lines",
    "unpack_neighbours",
    "vertex_dictionary",
    "vertices",
    "with_in_edges",
    "with_out_edges",
    "with_positions",
    "write_ranks",
]
