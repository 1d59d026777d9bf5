"""Column expressions for edge lines. All built-in functions: they stay inside
whole-stage codegen, no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the edge-line format (must stay as they are to read the same files):
# field separator TAB, quote character '"', sentinel id "0".
FIELD_SEPARATOR = "\t"
QUOTE = '"'
SENTINEL = "0"


def line_fields(value: Column) -> Column:
    """Split a line on TAB the way a Java ``String.split`` does: trailing empty
    fields are dropped, so ``7<TAB>`` has one field and ``7<TAB><TAB>x`` three."""
    return F.split(F.rtrim(value, F.lit(FIELD_SEPARATOR)), FIELD_SEPARATOR)


def strip_quotes(col: Column) -> Column:
    """Remove every leading and trailing double quote; inner quotes and spaces stay."""
    return F.btrim(col, F.lit(QUOTE))


def field(fields: Column, index: int) -> Column:
    """Field ``index`` (0-based) of a split line, null when the line is shorter."""
    return F.get(fields, F.lit(index))


def is_well_formed(fields: Column) -> Column:
    """A line is usable when it has at least a source and a target field."""
    return F.size(fields) >= 2


def not_sentinel(col: Column, sentinel) -> Column:
    """True where ``col`` is not the sentinel id (no-op when sentinel is None)."""
    if sentinel is None:
        return F.lit(True)
    return col != F.lit(sentinel)


def edge_line(src: Column, dst: Column) -> Column:
    """Format one edge as a text line ``src<TAB>dst`` (inverse of parsing)."""
    return F.concat_ws(FIELD_SEPARATOR, src.cast("string"), dst.cast("string"))
