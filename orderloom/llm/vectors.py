"""Batches of vectors as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def numbered(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Ids and vectors alone, as ``matrices`` reads them."""
    return vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and matrix of the finite vectors of each length in a batch of ``numbered``; null vectors, and those with
    null or non-finite components, are left out."""
    ids, vectors = batch.column(0), batch.column(1)
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[lengths >= 0]).tolist():
        at = np.flatnonzero(lengths == length)
        flat = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)  # null components become NaN
        matrix = flat.astype(np.float64).reshape(len(at), length)
        finite = np.isfinite(matrix).all(1)
        if finite.any():
            yield ids.take(pa.array(at[finite])), matrix[finite]
