"""Read CloudEvents binary-mode headers off an envelope (native, no map)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def header(name: str, headers: str = "headers") -> Column:
    """UTF-8 value of header ``name``; the last one wins when repeated.

    A plain filter keeps repeated keys legal (``map_from_entries`` would raise
    on them). Higher-order functions run interpreted, but in the JVM.
    """
    expr = (f"try_element_at(transform(filter({headers}, h -> h.key = '{name}'), "
            f"h -> cast(h.value as string)), -1)")
    return F.expr(expr)
