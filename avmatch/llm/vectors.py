"""Vectors that can take part in a search. Vectors of different lengths have no distance or product: each length is a
search space of its own."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(table: DataFrame, zero: bool = True, extra: Sequence[str] = ()) -> DataFrame:
    """(vec_id, embedding) without null ids and vectors, null or non-finite components and, unless zero, zero vectors.

    Rows that repeat an id all stay. embedding keeps its type, an array of floats or doubles; extra: columns that stay too.
    """
    rows = table.select("vec_id", "embedding", *extra).where("vec_id is not null and size(embedding) > 0")
    rows = rows.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    return rows if zero else rows.where(F.exists("embedding", lambda x: x != 0))


def kind(table: DataFrame) -> str:
    """The type of the embedding column."""
    return dict(table.dtypes)["embedding"]


def matrix(column) -> np.ndarray:
    """A list column without nulls, of one length, as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """A batch's rows, apart by the length of their vectors."""
    size = pc.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
    for d in np.unique(size).tolist():
        yield d, batch if (size == d).all() else batch.take(pa.array(np.flatnonzero(size == d)))


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """(centres, centre of each row)"""
    centres = x[rng.choice(len(x), k, replace=False)]
    of = np.zeros(len(x), int)
    for _ in range(rounds):
        of = nearest(x, centres)
        for c in range(k):
            if (of == c).any():
                centres[c] = x[of == c].mean(0)
    return centres, of


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
