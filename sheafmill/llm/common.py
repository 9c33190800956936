"""Helpers that the training-data operators share: batches of whole texts, folds, and those of the session."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.session import Scratch, give_back, keep, shared_path, shared_root, spread, text_session, tidy  # noqa: F401


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """The texts of a batch one at a time; null is the empty text."""
    for value in batch.column(batch.schema.get_field_index(name)):
        yield value.as_py() or ""


def fold_remainder(column: str, mod: int):
    """crc32 of the id as text, modulo mod: the remainder that says which rows are held out. A null id has none (-1)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % mod, F.lit(-1)).cast("int")
