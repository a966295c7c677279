"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.session import fresh_path

# Rows of a batch that are turned into Python objects at a time.
SLICE = 256
# Arrow batches of whole texts stay within this size, however long the texts are.
BATCH_BYTES = "16m"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def fold(key: str, modulus: int) -> Column:
    """Remainder of the CRC-32 of a key written as text; -1 for an unknown key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % modulus, F.lit(-1))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back: lineage ends there.

    The files outlive any executor. The folder belongs to the session's
    checkpoint directory and is removed with it.
    """
    path = fresh_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` over batches bounded in bytes.

    The bound is a setting that is read when the job starts, so it stays set for the session.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(work, schema)


def slices(batch: pa.RecordBatch, rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; a null one counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def sample_share(df: DataFrame, rows: int) -> float:
    """The share of the rows to take so that about ``rows`` remain; 1 for fewer rows."""
    total = df.count()
    return 1.0 if total <= rows else rows / total


def hashed_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of their key: the same ones on every run."""
    share = sample_share(df, rows)
    if share >= 1:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) < int(share * (1 << 30)))
