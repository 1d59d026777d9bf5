"""Column-level helpers (built-in Spark functions only)."""

from .columns import (
    FIELD_SEPARATOR,
    QUOTE,
    SENTINEL,
    edge_line,
    field,
    is_well_formed,
    line_fields,
    not_sentinel,
    strip_quotes,
)

__all__ = [
    "FIELD_SEPARATOR",
    "QUOTE",
    "SENTINEL",
    "edge_line",
    "field",
    "is_well_formed",
    "line_fields",
    "not_sentinel",
    "strip_quotes",
]
