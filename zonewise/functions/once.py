"""Keep an expensive expression from being evaluated more than once per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """``value`` as the output of a generator.

    Catalyst copies a projected expression into every filter and field access above it, so a
    parsed record would be parsed again for each.  It does not look into generators.
    """
    return F.explode(F.array(value))


def let_sql(name: str, value: str, body: str) -> str:
    """SQL text of ``body`` with ``name`` standing for ``value``, evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"
