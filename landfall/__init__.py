"""Land self-describing events on Spark: parse, split, type, evolve, write, measure."""

from landfall.layout import DEFAULT_LAYOUT, Layout
from landfall.options import LoadOptions, Processor

__all__ = ["DEFAULT_LAYOUT", "Layout", "LoadOptions", "Processor"]
