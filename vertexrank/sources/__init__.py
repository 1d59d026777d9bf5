"""Edge sources (text lines, table columns, benchmark graphs) and rank sinks."""

from .edges import (
    edge_line_report,
    edges_from_table,
    normalize_edges,
    parse_edge_lines,
    read_edge_lines,
    read_edges,
    sort_edge_lines,
    store_edge_lines,
)
from .graphs import customer_supplier, part_chain, returned_part_chain
from .sinks import read_rank_history, read_ranks, write_ranks

__all__ = [
    "customer_supplier",
    "edge_line_report",
    "edges_from_table",
    "normalize_edges",
    "parse_edge_lines",
    "part_chain",
    "read_edge_lines",
    "read_edges",
    "read_rank_history",
    "read_ranks",
    "returned_part_chain",
    "sort_edge_lines",
    "store_edge_lines",
    "write_ranks",
]
