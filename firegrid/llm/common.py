"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# ASCII white space as the contracts use it: space and \t \n \v \f \r.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\x09-\\x0D]+"
# Bytes of input that one call of a batch function gets.
PIECE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pieces(batch: pa.RecordBatch, limit: int | None) -> Iterator[pa.RecordBatch]:
    n = 1 if limit is None else max(1, -(-batch.nbytes // limit))
    step = max(1, -(-batch.num_rows // n))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def map_batches(
    df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str, piece_bytes: int | None = PIECE_BYTES, as_lists: bool = True,
) -> DataFrame:
    """Run ``fn`` on every Arrow batch, in pieces of about ``piece_bytes``; columns go in as lists, or Arrow arrays, and come out as either.

    The lists are turned into the Arrow types of ``schema``, which may have fewer or more rows than the
    input.  Pieces bound the Python objects alive at a time; a function that adds up a whole batch
    takes None.
    """
    target = df.sparkSession.createDataFrame([], schema).schema
    fields = [(f.name, f.dataType) for f in target]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = pa.schema([(n, to_arrow_type(t)) for n, t in fields])
        for batch in batches:
            for piece in _pieces(batch, piece_bytes):
                out = fn({n: piece.column(i).to_pylist() if as_lists else piece.column(i) for i, n in enumerate(piece.schema.names)})
                made = [out[n].cast(arrow.field(n).type) if isinstance(out[n], pa.Array) else pa.array(out[n], arrow.field(n).type) for n, _ in fields]
                yield pa.RecordBatch.from_arrays(made, schema=arrow)

    return df.mapInArrow(run, target)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def n_words(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


def keep_rows(df: DataFrame, column: str, keep: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of ``df`` whose ``column`` passes ``keep``, all columns as they are and without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch, PIECE_BYTES):
                yield piece.filter(pa.array(keep(piece.column(piece.schema.get_field_index(column)).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)
