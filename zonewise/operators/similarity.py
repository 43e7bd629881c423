"""Exact top-k of cosine similarity within owners, by products of blocks of vectors.

Both sides are cut into parts of bounded size, and each part of the questions meets each part of the history once
(a cogroup).  There one matrix product finds the rows that may be among the ``k`` best; only for these the similarity is
summed up element by element, in the order and arithmetic of the SQL expression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

#: Rows of one side that meet in one group, and sides of the square that is multiplied at once.
PART_ROWS, SQUARE = 4096, 1024
#: Similarities that a product finds nearer than this may change places when summed up and rounded to nine digits.
MARGIN = 2e-9


def _comparison(k: int, nothing: pa.Table) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The function of a group.  It carries its helpers with it, so executors need not have this package."""

    def vectors_of(column: pa.ChunkedArray, rows: np.ndarray, size: int) -> np.ndarray:
        taken = column.take(pa.array(rows)).combine_chunks()
        return taken.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), size)

    def groups(owners: pa.ChunkedArray, vectors: pa.ChunkedArray, order: Iterable[int]) -> dict:
        """Row numbers, in ``order``, by owner and length of vector."""
        names, sizes = owners.to_pylist(), pc.list_value_length(vectors).to_pylist()
        found: dict = {}
        for i in order:
            name = names[i] if names[i] == names[i] else None  # NaN; rows without an owner are not here
            found.setdefault(name, {}).setdefault(sizes[i], []).append(i)
        return found

    def best(a: np.ndarray, an: np.ndarray, v: np.ndarray, vn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(question, item, similarity) of all that may be among the ``k`` best of a question; items stand in order."""
        near = (a @ v.T) / (an[:, None] * vn[None, :])
        near[np.isnan(near)] = np.inf  # as Spark sorts it
        if near.shape[1] > k:
            least = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
            rows, cols = np.nonzero(near >= (least - MARGIN)[:, None])
        else:
            rows, cols = np.nonzero(np.ones(near.shape, bool))
        total = np.zeros(len(rows))
        for d in range(a.shape[1]):
            total += a[rows, d] * v[cols, d]
        exact = total / (an[rows] * vn[cols])
        ranked = np.where(np.isnan(exact), np.inf, exact)
        order = np.lexsort((cols, -ranked, rows))
        rows, cols, exact, ranked = rows[order], cols[order], exact[order], ranked[order]
        at = np.arange(len(rows))
        first_of_row = np.maximum.accumulate(np.where(np.r_[True, rows[1:] != rows[:-1]], at, 0))
        fresh = np.r_[True, (rows[1:] != rows[:-1]) | (ranked[1:] != ranked[:-1])]
        first_of_value = np.maximum.accumulate(np.where(fresh, at, 0))
        size = np.bincount(rows, minlength=len(a))[rows]
        kth = ranked[first_of_row + np.minimum(size, k) - 1]
        # Of equal similarities the first k items are enough.
        keep = (at - first_of_value < k) & (ranked >= kth - MARGIN)
        return rows[keep], cols[keep], exact[keep]

    def squares(left: dict, right: dict, asked: pa.Table, held: pa.Table) -> Iterator[tuple]:
        an, vn = asked["__qn"].to_numpy(), held["__tn"].to_numpy()
        for owner, sizes in left.items():
            for size, questions in sizes.items():
                for other, items in right.get(owner, {}).items():
                    for i in range(0, len(questions), SQUARE):
                        q = np.array(questions[i : i + SQUARE])
                        if other != size:  # not comparable: null, ranked last
                            first = np.array(items[:k])
                            yield np.repeat(q, len(first)), np.tile(first, len(q)), pa.nulls(len(q) * len(first), pa.float64())
                            continue
                        a = vectors_of(asked["__qv"], q, size)
                        for j in range(0, len(items), SQUARE):
                            t = np.array(items[j : j + SQUARE])
                            rows, cols, exact = best(a, an[q], vectors_of(held["__tv"], t, size), vn[t])
                            yield q[rows], t[cols], pa.array(exact)

    def compare(questions: pa.Table, items: pa.Table) -> pa.Table:
        if not (len(questions) and len(items)):
            return nothing  # an empty side comes without columns
        order = pc.sort_indices(items["__t"], null_placement="at_start").to_numpy()
        asks, stored = groups(questions["__qo"], questions["__qv"], range(len(questions))), groups(items["__to"], items["__tv"], order)
        out = [nothing]
        for q, t, similarity in squares(asks, stored, questions, items):
            q, t = pa.array(q), pa.array(t)
            out.append(pa.table([questions["__q"].take(q), questions["__qo"].take(q), items["__t"].take(t), similarity], schema=nothing.schema))
        return pa.concat_tables(out)

    return compare


def best_in_parts(asked: DataFrame, held: DataFrame, ask: str, owner: str, item: str, k: int) -> DataFrame:
    """``ask, owner, item, similarity`` (not rounded): of each question all that may be among the ``k`` best of its owner.

    Both sides have ``owner``, vectors ``__v`` of doubles and their lengths ``__n`` above 0.
    """
    asked, held = (rows.where(F.col(owner).isNotNull()) for rows in (asked, held))
    counts = [rows.groupBy(owner).count().select(F.lit(i).alias("side"), "count") for i, rows in enumerate((asked, held))]
    sizes = counts[0].unionByName(counts[1]).groupBy("side").agg(F.max("count").alias("most"), F.sum("count").alias("all")).collect()
    parts = {r["side"]: -(-r["most"] // PART_ROWS) for r in sizes}
    buckets = max([1, *(-(-r["all"] // PART_ROWS) for r in sizes)])
    n_asked, n_held = parts.get(0, 1), parts.get(1, 1)

    def part(key: str, n: int):
        return F.pmod(F.xxhash64(key, "__v"), F.lit(n))

    bucket = F.pmod(F.xxhash64(owner), F.lit(buckets)).alias("__bucket")
    every = [F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))) for n in (n_asked, n_held)]
    # Each side under names of its own: both may come from one table, and a cogroup takes equal columns for the same.
    names = [("__q", ask), ("__qo", owner), ("__qv", "__v"), ("__qn", "__n")], [("__t", item), ("__to", owner), ("__tv", "__v"), ("__tn", "__n")]
    columns = [[F.col(old).alias(new) for new, old in side] for side in names]
    left = asked.select(*columns[0], bucket, part(ask, n_asked).alias("__a"), every[1].alias("__h"))
    right = held.select(*columns[1], bucket, part(item, n_held).alias("__h"), every[0].alias("__a"))
    keys = ["__bucket", "__a", "__h"]
    types = [asked.schema[ask].dataType, asked.schema[owner].dataType, held.schema[item].dataType]
    schema = StructType([StructField(c, t) for c, t in zip((ask, owner, item), types)] + [StructField("similarity", DoubleType())])

    compare = _comparison(k, to_arrow_schema(schema).empty_table())
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, schema)
