"""Statistics that loads store beside their rows, in pieces that are merged without reading a row.

A piece covers what one load wrote, or one month of it: row count, an order-free
fingerprint of the rows, and for each column its nulls, extremes and an HLL
sketch of its values. The tasks that write the rows gather it. A month that is
loaded again replaces its piece, so the pieces always cover the whole table, and
equal fingerprints tell that a month has not changed.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, Row, StringType, StructField, StructType

from martloom.sources import storage

# Folder inside a table's; readers of the table do not see it.
FOLDER = "_statistics"
# Piece of a table that is loaded as a whole.
WHOLE = "whole"
_SKETCHED = (IntegerType, LongType, StringType)
_LINE = StructType(
    [
        *(StructField(n, StringType()) for n in ("piece", "inputs")),
        *(StructField(n, LongType()) for n in ("row_count", "hash_xor", "hash_sum")),
        StructField("column_name", StringType()),
        StructField("null_count", LongType()),
        *(StructField(n, StringType()) for n in ("min_value", "max_value", "sketch")),
    ]
)


@dataclass(frozen=True)
class ColumnStats:
    """What a load knows of a column it wrote."""

    nulls: int
    least: str | None
    most: str | None
    distinct: int
    sketch: str | None = field(default=None, compare=False, repr=False)


@dataclass(frozen=True)
class Piece:
    """Statistics of the rows of a load or of a month."""

    rows: int = 0
    hash_xor: int = 0
    hash_sum: int = 0
    columns: dict[str, ColumnStats] = field(default_factory=dict)

    @property
    def fingerprint(self) -> tuple[int, int, int]:
        return self.rows, self.hash_xor, self.hash_sum


@dataclass(frozen=True)
class Known:
    """What is stored of a piece: its fingerprint, and a digest of what its rows were derived from."""

    fingerprint: tuple[int, int, int]
    inputs: str


def _fingerprint(columns: list[str], within: Column | None) -> list[Column]:
    """Count, exclusive or and sum of row hashes: they do not depend on the order of rows."""
    named = [F.col(f"`{c}`") for c in columns]
    # A hash passes over nulls, so where they are is hashed too.
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in named])
    row = F.xxhash64(*named, nulls)
    row = row if within is None else F.when(within, row)
    return [
        F.count(row).alias("rows"),
        F.coalesce(F.bit_xor(row), F.lit(0)).alias("hash_xor"),
        # Low bits only: the sum of 64-bit hashes would overflow.
        F.coalesce(F.sum(row.bitwiseAND(F.lit(0xFFFFFF))), F.lit(0)).alias("hash_sum"),
    ]


def measured(schema: StructType, within: Column | None = None) -> Column:
    """A piece as one aggregate, of all rows or of those ``within``."""
    columns = []
    for item in schema.fields:
        value = F.col(f"`{item.name}`")
        null = value.isNull() if within is None else within & value.isNull()
        value = value if within is None else F.when(within, value)
        sketched = value if isinstance(item.dataType, _SKETCHED) else value.cast("string")
        # The sketch is used twice and has to be taken once.
        sketch = F.transform(
            F.array(F.hll_sketch_agg(sketched)),
            lambda s: F.struct(F.base64(s).alias("sketch"), F.hll_sketch_estimate(s).alias("distinct")),
        )[0]
        columns.append(
            F.struct(
                F.count_if(null).alias("nulls"),
                F.min(value).cast("string").alias("least"),
                F.max(value).cast("string").alias("most"),
                sketch.alias("sketch"),
            )
        )
    return F.struct(*_fingerprint(schema.names, within), F.array(*columns).alias("columns"))


def piece_of(row: Row, columns: list[str]) -> Piece:
    """The piece that ``measured`` has found."""
    stats = {
        name: ColumnStats(c["nulls"], c["least"], c["most"], c["sketch"]["distinct"], c["sketch"]["sketch"])
        for name, c in zip(columns, row["columns"])
    }
    return Piece(row["rows"], row["hash_xor"], row["hash_sum"], stats)


def pieces_by(df: DataFrame, by: str) -> dict[str, Piece]:
    """A piece for each value of a column with few values, such as the month."""
    schema = StructType([f for f in df.schema.fields if f.name != by])
    found = df.groupBy(by).agg(measured(schema).alias("piece"))
    return {row[by]: piece_of(row["piece"], schema.names) for row in found.toLocalIterator()}


def fingerprints_by(df: DataFrame, by: str) -> dict[str, tuple[int, int, int]]:
    """Fingerprint of the rows of each value of a column with few values."""
    columns = [c for c in df.columns if c != by]
    found = df.groupBy(by).agg(*_fingerprint(columns, None))
    return {r[by]: (r["rows"], r["hash_xor"], r["hash_sum"]) for r in found.toLocalIterator()}


def store(spark: SparkSession, path: str, name: str, piece: Piece, columns: Iterable[str], inputs: str = "") -> None:
    """Stores the piece of a table; an earlier one of the same name is replaced. No job is run."""
    head = {
        "piece": name, "inputs": inputs,
        "row_count": piece.rows, "hash_xor": piece.hash_xor, "hash_sum": piece.hash_sum,
    }
    lines = []
    for column in columns:
        c = piece.columns.get(column, ColumnStats(0, None, None, 0))
        values = {"null_count": c.nulls, "min_value": c.least, "max_value": c.most, "sketch": c.sketch}
        lines.append(json.dumps(head | {"column_name": column} | values))
    storage.write_text(spark, f"{path}/{FOLDER}/{name}.json", "\n".join(lines) + "\n")


def forget(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    """Removes pieces whose rows are about to change: should the load fail, nothing wrong is known of them."""
    for name in names:
        storage.remove(spark, f"{path}/{FOLDER}/{name}.json")


def _lines(spark: SparkSession, path: str) -> DataFrame | None:
    folder = f"{storage.current(spark, path)}/{FOLDER}"
    return spark.read.schema(_LINE).json(folder) if storage.names(spark, folder) else None


def known(spark: SparkSession, path: str) -> dict[str, Known]:
    """The stored pieces of a table by name; none if it was loaded without."""
    lines = _lines(spark, path)
    if lines is None:
        return {}
    heads = lines.select("piece", "inputs", "row_count", "hash_xor", "hash_sum").distinct()
    return {r["piece"]: Known(tuple(r[2:]), r["inputs"]) for r in heads.toLocalIterator()}


def state(pieces: dict[str, Known], names: Iterable[str] | None = None) -> str:
    """Digest of a table's rows, or of the named pieces; empty if it is not known."""
    chosen = sorted(pieces) if names is None else sorted(set(names) & set(pieces))
    if not chosen:
        return ""
    return hashlib.sha256(repr([(n, pieces[n].fingerprint) for n in chosen]).encode()).hexdigest()


def digest(*states: str) -> str:
    """Digest of several states; empty if one of them is not known."""
    return hashlib.sha256("/".join(states).encode()).hexdigest() if all(states) else ""


def table_stats_merged(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Statistics of a whole stored table from those of its pieces; none of its rows is read.

    One row per column, as ``stats.table_stats`` gives: row count, null count,
    smallest and largest value as text, and an estimate of the distinct values.
    """
    lines = _lines(spark, path)
    if lines is None:
        lines = spark.createDataFrame([], _LINE)
    measures = []
    for item in schema.fields:
        mine = F.col("column_name") == item.name

        def extreme(best, name):
            return best(F.when(mine, F.col(name).cast(item.dataType))).cast("string").alias(name)

        sketch = F.hll_union_agg(F.when(mine & F.col("sketch").isNotNull(), F.unbase64("sketch")))
        measures.append(
            F.struct(
                F.lit(item.name).alias("column_name"),
                *[F.coalesce(F.sum(F.when(mine, F.col(n))), F.lit(0)).alias(n) for n in ("row_count", "null_count")],
                extreme(F.min, "min_value"),
                extreme(F.max, "max_value"),
                F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).alias("distinct_count"),
            )
        )
    return lines.agg(F.array(*measures).alias("measures")).select(F.inline("measures"))
