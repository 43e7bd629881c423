"""Ordered per-key computations that survive a key holding a large share of all rows.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task.  The operators
here cut each key's rows into *segments*, i.e. ranges of the ordering column, so the
shuffle and the sort work on ``(key, segment)`` groups.  What crosses a segment border is
then repaired from a small set of border rows or one summary row per segment.

``segment`` is any Column that never decreases along the ordering; a span of an arrival
number bounds every group by the span itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from zonewise.session import materialize

# Rows (or arrival numbers) per segment: large enough that border rows stay a few percent
# of a fleet's data, small enough that one segment sorts inside an executor.
ARRIVALS_PER_SEGMENT = 1 << 24
MILLIS_PER_SEGMENT = 3_600_000
#: Rows of a key beyond which it is cut into segments, where keys are measured first.
ROWS_PER_SEGMENT = 1 << 22

_SEGMENT = "__segment"
_HEAD = "__head"
_TAIL = "__tail"


def span_segment(column: Column | str, span: int) -> Column:
    """Segment number of an integer ordering column: ``floor(column / span)``."""
    column = F.col(column) if isinstance(column, str) else column
    return F.floor(column.cast("long") / F.lit(int(span)))


def measured_segments(
    df: DataFrame, keys: Sequence[str], order: str, rows: int = ROWS_PER_SEGMENT
) -> tuple[DataFrame, Column]:
    """``df`` with what ``lookback`` needs to cut only keys of more than ``rows`` rows, and its segment column.

    One pre-aggregated count per key finds them.  A key is cut into spans of the integer column ``order`` that hold
    ``rows`` rows on average.  There is at most one such key for each ``rows`` rows, so their list is broadcast.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(order).alias("__low"), F.max(order).alias("__high"))
    pieces = F.ceil(F.col("__n") / rows)
    span = F.greatest(F.lit(1), F.floor((F.col("__high") - F.col("__low")) / pieces) + 1).cast("long")
    hot = materialize(
        counts.where(F.col("__n") > rows).select(*[F.col(k).alias(f"__hot_{k}") for k in keys], "__low", span.alias("__span"))
    )
    if hot.isEmpty():
        return df, F.lit(0).cast("long")
    same = [F.col(k).eqNullSafe(F.col(f"__hot_{k}")) for k in keys]
    found = df.join(F.broadcast(hot), same, "left").drop(*[f"__hot_{k}" for k in keys])
    segment = F.when(F.col("__span").isNull(), 0).otherwise(F.floor((F.col(order) - F.col("__low")) / F.col("__span")))
    return found.withColumn("__cut", segment.cast("long")).drop("__low", "__span"), F.col("__cut")


def largest_group(*groups: tuple[DataFrame, Sequence[str]]) -> list[int]:
    """For each frame and keys the rows of the key that has most; counted before the shuffle, in one job."""
    counts = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n") for i, (df, keys) in enumerate(groups)]
    found = dict(reduce(DataFrame.unionByName, counts).groupBy("i").agg(F.max("n")).collect())
    return [found.get(i, 0) for i in range(len(groups))]


def lookback(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    depth: int = 1,
) -> DataFrame:
    """Add columns that look at no more than ``depth`` preceding rows of the same key.

    ``columns`` maps a name to a function of the window.  Rows that have ``depth``
    predecessors inside their own segment are final after the first window.  The first
    ``depth`` rows of each segment are computed again over the border rows only (the
    first and last ``depth`` rows of every segment), which contain all of their
    predecessors.  Both branches read the same exchange.
    """
    base = df.columns
    inner = Window.partitionBy(*keys, _SEGMENT).orderBy(*order)
    staged = df.withColumn(_SEGMENT, segment).select(
        "*",
        *[make(inner).alias(name) for name, make in columns.items()],
        F.lag(F.lit(True), depth).over(inner).isNull().alias(_HEAD),
        F.lead(F.lit(True), depth).over(inner).isNull().alias(_TAIL),
    )
    settled = staged.where(~F.col(_HEAD)).select(*base, *columns)

    outer = Window.partitionBy(*keys).orderBy(*order)
    border = (
        staged.where(F.col(_HEAD) | F.col(_TAIL))
        .select(*base, _HEAD)
        .select(*base, _HEAD, *[make(outer).alias(name) for name, make in columns.items()])
        .where(_HEAD)
        .select(*base, *columns)
    )
    return settled.unionByName(border)


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column,
    value: str,
    name: str,
) -> DataFrame:
    """Add ``name``: the latest non-null ``value`` at or before each row.

    Inside a segment this is one running ``last``.  Every segment also yields one summary
    row with its final value; a second window over the summaries tells each segment what
    it starts with.  The join back is on ``(key, segment)``, the partitioning the rows
    already have.
    """
    staged = df.withColumn(_SEGMENT, segment)
    running = (
        Window.partitionBy(*keys, _SEGMENT).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = staged.withColumn(name, F.last(value, ignorenulls=True).over(running))
    position = F.when(F.col(value).isNotNull(), F.struct(*order))
    earlier = Window.partitionBy(*keys).orderBy(_SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        staged.groupBy(*keys, _SEGMENT)
        .agg(F.max_by(value, position).alias("__carry_final"))
        .select(*keys, _SEGMENT, F.last("__carry_final", ignorenulls=True).over(earlier).alias("__carry_start"))
        .where(F.col("__carry_start").isNotNull())
    )
    return (
        local.join(starts, [*keys, _SEGMENT], "left")
        .withColumn(name, F.coalesce(F.col(name), F.col("__carry_start")))
        .select(*df.columns, name)
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    name: str,
    tie: str | None = None,
    direction: str = "backward",
    allow_exact: bool = True,
    span: int | None = MILLIS_PER_SEGMENT,
) -> DataFrame:
    """Attach to each left row the nearest right row of the same key as the struct ``name``.

    ``backward`` takes the last right row at or before ``left_time`` (strictly before
    without ``allow_exact``), ``forward`` the first at or after it.  ``tie`` is a right
    column that orders rows of equal time.  Left rows without a match get null.  The two
    sides are merged and carried along in time, so no pair of rows is ever formed.  With ``span`` null each key is
    one group: for keys known to be small (``largest_group``).
    """
    sign = {"backward": 1, "forward": -1}[direction]
    right_rank, left_rank = (0, 1) if allow_exact else (1, 0)
    keys = list(on)
    payload = F.struct(*[F.col(c) for c in right.columns])
    found = right.select(
        *keys,
        (F.col(right_time).cast("long") * sign).alias("__t"),
        F.lit(right_rank).alias("__rank"),
        ((F.col(tie).cast("long") * sign) if tie else F.lit(0).cast("long")).alias("__tie"),
        payload.alias(name),
    )
    asked = left.select(
        *keys,
        (F.col(left_time).cast("long") * sign).alias("__t"),
        F.lit(left_rank).alias("__rank"),
        F.lit(0).cast("long").alias("__tie"),
        F.struct(*[F.col(c) for c in left.columns]).alias("__left"),
    )
    merged = found.unionByName(asked, allowMissingColumns=True)
    order = ["__t", "__rank", "__tie"]
    if span is None:
        running = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        carried = merged.withColumn("__hit", F.last(name, ignorenulls=True).over(running))
    else:
        carried = carry_forward(merged, keys, order, span_segment("__t", span), name, "__hit")
    return carried.where(F.col("__left").isNotNull()).select("__left.*", F.col("__hit").alias(name))
