"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewise.session import materialize, shared_dir, table_path

__all__ = ["as_text", "ascii_lower", "field", "map_rows", "materialize", "read", "stored", "table_path"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def field(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(f"`{name}`")


def as_text(name: str) -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(field(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again.

    For loops: unlike a checkpoint, the table read again knows its true size.  The size estimate of a
    checkpoint is that of its plan, which multiplies with every join of a loop.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, function, added: dict[str, str], drop: tuple[str, ...] = ()) -> DataFrame:
    """Append columns that ``function`` computes batch by batch.

    ``function`` is called once per task with nothing and returns a callable that takes an
    Arrow batch and returns one list or Arrow array for each added column.  Added columns
    replace input columns of the same name; ``drop`` names input columns to leave out.
    """
    gone = {name.lower() for name in [*added, *drop]}
    kept = [f for f in df.schema.fields if f.name.lower() not in gone]
    extra = T._parse_datatype_string(", ".join(f"`{n}` {t}" for n, t in added.items()))
    schema = T.StructType(kept + extra.fields)
    given, names = df.columns, [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in extra.fields]
        work = None
        for batch in batches:
            work = work or function()
            batch = batch.rename_columns(given)
            values = work(batch)
            arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
            arrays += [v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, t) for v, t in zip(values, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])

    # Columns travel under plain names, as names with dots are not taken.
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])
    return df.toDF(*[f"c{i}" for i in range(len(given))]).mapInArrow(run, plain).toDF(*schema.names)
