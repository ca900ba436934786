"""Vectors of an embedding table as whole numbers, for the operators on vectors."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common_length(df: DataFrame, vector: str) -> int:
    """The most frequent length of a vector, the longer one of a tie; 0 without any."""
    lengths = df.where(F.size(vector) > 0).groupBy(F.size(vector).alias("length")).count()
    found = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return found["length"] if found else 0


def whole_numbers(df: DataFrame, keep: dict[str, str], vector: str, shift: int) -> DataFrame:
    """Rows with ``x = floor(1024 * entry) + shift`` for every entry of their vector.

    ``keep`` names the other columns of the result and where they come from.
    Rows whose vector is null, is empty, has a null, NaN or infinite entry or is
    not of the most frequent length are left out.
    """
    length = common_length(df, vector)
    columns = [F.col(source).alias(name) for name, source in keep.items()]
    chosen = df.select(*columns, F.col(vector).cast("array<double>").alias("x"))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            right = pc.fill_null(pc.equal(pc.list_value_length(batch.column("x")), length), False)
            batch = batch.filter(right)
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            entries = flat.astype("float64").reshape(-1, length)
            fine = np.isfinite(entries).all(axis=1)
            whole = np.floor(1024 * entries[fine]).astype("int64") + shift
            batch = batch.filter(pa.array(fine))
            offsets = np.arange(0, whole.size + 1, length, dtype="int32")
            x = pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole.ravel()))
            names = list(keep)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), x], names=[*names, "x"]
            )

    kinds = dict(chosen.dtypes)
    schema = ", ".join([*(f"`{name}` {kinds[name]}" for name in keep), "x array<long>"])
    if not length:
        return df.sparkSession.createDataFrame([], schema)
    return chosen.mapInArrow(convert, schema)


def matrix(column: pa.Array, length: int):
    """The lists of a column as rows of one matrix."""
    return column.flatten().to_numpy().reshape(-1, length)
