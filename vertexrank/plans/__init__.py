"""Physical layout of the rank loop, lineage cutting, and plan inspection."""

from .layout import GraphLayout, build_layout
from .lineage import cut_lineage, keep, release

__all__ = ["GraphLayout", "build_layout", "cut_lineage", "keep", "release"]
