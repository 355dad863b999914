"""Bounded samples of labelled rows, and columns computed per row in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the doc_id as text modulo folds; null for a null doc_id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def first_by_hash(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows of ids (doc_id, ...) in the order of a hash: a stable sample, whatever the partitions."""
    return ids.where("doc_id is not null").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most)


def append(docs: DataFrame, name: str, kind: T.DataType, arrow: pa.DataType, column: Callable) -> DataFrame:
    """docs with one more column: ``column(texts)`` gives an Arrow array of type ``arrow`` for an Arrow array of texts.

    ``column`` is called per batch on the workers, which get the texts and return the new values only.
    """
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")

    def compute(texts: pa.Array) -> pa.Array:
        return column(texts).cast(arrow)

    # nondeterministic, so that no plan computes it twice
    return docs.withColumn(name, F.arrow_udf(compute, kind).asNondeterministic()(F.col("text")))


def spare_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name
