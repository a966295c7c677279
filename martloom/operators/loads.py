"""Loads that write: full, insert with a predicate, and replacement of months.

All writes are compressed Parquet. Row counts, fingerprints and column statistics
come from metrics observed in the writing tasks themselves, so a task that is run
again does not count twice. They are stored with the table, see ``statistics``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.functions.dates import (
    YEAR_MONTH,
    in_window,
    month_key,
    month_window,
    months_between,
    next_month,
)
from martloom.operators import statistics
from martloom.operators.partitions import route_partitions
from martloom.operators.quality import conform, inside_windows, not_empty_predicate, require
from martloom.operators.statistics import ColumnStats, Piece
from martloom.sources import storage
from martloom.sources.tables import MONTH, read_partitioned, remove_months

COMPRESSION = "zstd"


# Months of a load whose statistics the writing tasks gather; those of more are gathered in one pass afterwards.
OBSERVED_MONTHS = 3


@dataclass(frozen=True)
class LoadResult:
    """What a load wrote.

    ``skipped`` means the source was empty and nothing was touched; the months
    (or the table) named in ``unchanged`` held the same rows already.
    """

    rows: int
    skipped: bool = False
    months: dict[str, int] = field(default_factory=dict)
    pieces: dict[str, Piece] = field(default_factory=dict)
    unchanged: tuple[str, ...] = ()

    @property
    def stats(self) -> dict[str, ColumnStats]:
        """Statistics of the columns of a load that wrote one piece."""
        return next(iter(self.pieces.values())).columns if len(self.pieces) == 1 else {}


def _unkeyed(df: DataFrame) -> StructType:
    return StructType([f for f in df.schema.fields if f.name != MONTH])


def _write(df: DataFrame, path: str, mode: str) -> Piece:
    """Write and return the statistics of the written rows."""
    seen = Observation()
    observed = df.observe(seen, statistics.measured(df.schema).alias("piece"))
    observed.write.mode(mode).option("compression", COMPRESSION).parquet(path)
    return statistics.piece_of(seen.get["piece"], df.columns)


def _write_months(df: DataFrame, path: str, names: list[str] | None) -> dict[str, Piece]:
    """Write months to their folders and return the statistics of each; ``names`` are all that can occur."""
    schema, seen = _unkeyed(df), Observation()
    # Each month gets its own files; a month with most rows is split over tasks.
    rows = df.hint("rebalance", MONTH)
    few = names is not None and len(names) <= OBSERVED_MONTHS
    if few:
        pieces = [statistics.measured(schema, F.col(MONTH) == n).alias(f"m{n}") for n in names]
        rows = rows.observe(seen, *pieces)
    writer = rows.write.mode("overwrite").option("compression", COMPRESSION)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    if few:
        return {n: statistics.piece_of(seen.get[f"m{n}"], schema.names) for n in names}
    stored = read_partitioned(df.sparkSession, path, schema, keep_month=True)
    written = stored if names is None else stored.filter(F.col(MONTH).isin(names))
    empty = {} if names is None else dict.fromkeys(names, Piece())
    return empty | statistics.pieces_by(written, MONTH)


def _replace(rows: DataFrame, path: str, inputs: str = "") -> Piece:
    """The rows take the place of a table once all of them are written."""
    spark = rows.sparkSession
    with storage.replacing(spark, path) as fresh:
        piece = _write(rows, fresh, "overwrite")
        statistics.store(spark, fresh, statistics.WHOLE, piece, rows.columns, inputs)
    return piece


def insert_select(
    source: DataFrame,
    path: str,
    schema: StructType,
    where: Column | None = None,
    truncate: bool = False,
) -> LoadResult:
    """Insert the rows that meet ``where``; with ``truncate`` they replace the table.

    A replaced table keeps its rows until the new ones are all written, so a load
    that fails leaves it as it was, and the source may be the table itself.
    """
    rows = conform(source, schema).filter(F.lit(True) if where is None else where)
    rows = require(rows, schema)
    if truncate:
        name, piece = statistics.WHOLE, _replace(rows, path)
    else:
        storage.settle(source.sparkSession, path)
        name, piece = uuid.uuid4().hex, _write(rows, path, "append")
        statistics.store(source.sparkSession, path, name, piece, rows.columns)
    return LoadResult(piece.rows, pieces={name: piece})


def full_load(
    source: DataFrame, path: str, schema: StructType, truncate: bool = False, only_changed: bool = False
) -> LoadResult:
    """Load the rows whose text columns are all filled.

    An empty source leaves the target alone, while a source whose rows are all
    filtered out still truncates it. With ``only_changed`` a truncating load first
    compares the fingerprint of its rows with that of the table, and writes nothing
    if they are equal.
    """
    if source.isEmpty():
        return LoadResult(0, skipped=True)
    where = not_empty_predicate(schema)
    if truncate and only_changed:
        pieces = statistics.known(source.sparkSession, path)
        if set(pieces) == {statistics.WHOLE}:
            rows = conform(source, schema).filter(where).withColumn(MONTH, F.lit(statistics.WHOLE))
            now = statistics.fingerprints_by(rows, MONTH).get(statistics.WHOLE, Piece().fingerprint)
            if now == pieces[statistics.WHOLE].fingerprint:
                return LoadResult(0, unchanged=(statistics.WHOLE,))
    return insert_select(source, path, schema, where, truncate)


def create_table_as(df: DataFrame, path: str, inputs: str = "") -> LoadResult:
    """Replace a stored table by a query result, which may read that table.

    ``inputs`` is a digest of what the result is derived from. If the table was
    made from the same, it is left alone and nothing is computed.
    """
    if inputs:
        pieces = statistics.known(df.sparkSession, path)
        if set(pieces) == {statistics.WHOLE} and pieces[statistics.WHOLE].inputs == inputs:
            return LoadResult(0, unchanged=(statistics.WHOLE,))
    piece = _replace(df, path, inputs)
    return LoadResult(piece.rows, pieces={statistics.WHOLE: piece})


def save_bucketed(
    df: DataFrame, table: str, path: str, columns: list[str], buckets: int
) -> DataFrame:
    """Store a catalog table bucketed by ``columns`` and read it back.

    Tables with the same buckets are joined and totalled by these columns
    without a shuffle. A bucket is one task's work, so the columns should be
    ones whose keys are small, such as bill numbers.
    """
    (
        df.repartition(buckets, *columns)
        .write.mode("overwrite")
        .option("path", path)
        .option("compression", COMPRESSION)
        .bucketBy(buckets, *columns)
        .sortBy(*columns)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def load_all_months(
    source: DataFrame,
    path: str,
    schema: StructType,
    key: str,
    lo: dt.date | str | None = None,
    hi: dt.date | str | None = None,
) -> LoadResult:
    """Write a whole partitioned table.

    Rows without a date go to the default partition, and if months are declared
    from ``lo`` up to ``hi``, so do rows outside of them.
    """
    rows = conform(source, schema)
    if lo is None or hi is None:
        rows = rows.withColumn(MONTH, month_key(key))
    else:
        rows = route_partitions(rows, key, lo, hi, MONTH)
    pieces = _write_months(rows, path, None)
    for name, piece in pieces.items():
        statistics.store(source.sparkSession, path, name, piece, schema.names)
    return LoadResult(sum(p.rows for p in pieces.values()), pieces=pieces)


def load_months(
    source: DataFrame,
    path: str,
    schema: StructType,
    key: str,
    start: dt.date | str,
    end: dt.date | str,
    guard: DataFrame | None = None,
    only_changed: bool = False,
    inputs: Mapping[str, str] | None = None,
) -> LoadResult:
    """Replace the months from ``start`` through ``end`` by the source's rows.

    One job writes all months of the window; folders outside it are not read
    or written. Every row is checked to lie in the window as it is written, in
    its declared type, and a stray one fails the job before anything is swapped.
    Months without source rows end up empty: dynamic overwrite would leave their
    old rows, so their folders are removed. ``guard`` names the frame whose
    emptiness skips the load, if it is not the source itself.

    ``inputs`` gives for each month a digest of what its rows are derived from;
    months made from the same are neither computed nor written. With
    ``only_changed`` the source is read once more beforehand, and months whose
    fingerprint is that of the stored rows are not written.

    The job swaps its folders when all its tasks are done. Plain files have no
    transaction over several folders, so a load that failed between the swaps
    has to be run again; running it twice gives the same table.
    """
    spark = source.sparkSession
    if (source if guard is None else guard).isEmpty():
        return LoadResult(0, skipped=True)
    window = month_window(start, end)
    names = wanted = [f"{first:%Y%m}" for first in months_between(*window)]
    pieces = statistics.known(spark, path) if only_changed or inputs else {}
    if inputs:
        wanted = [n for n in names if n not in pieces or not inputs[n] or pieces[n].inputs != inputs[n]]
    if only_changed and set(wanted) & set(pieces):
        rows = _of_months(source, schema, key, wanted)
        now = statistics.fingerprints_by(rows, MONTH)
        same = [n for n in wanted if n in pieces and now.get(n, Piece().fingerprint) == pieces[n].fingerprint]
        wanted = [n for n in wanted if n not in same]
    unchanged = tuple(n for n in names if n not in wanted)
    if not wanted:
        return LoadResult(0, unchanged=unchanged)
    rows = _of_months(source, schema, key, wanted)
    statistics.forget(spark, path, wanted)
    written = _write_months(rows, path, wanted)
    months = {name: piece.rows for name, piece in written.items()}
    remove_months(spark, path, [name for name, count in months.items() if not count])
    for name, piece in written.items():
        statistics.store(spark, path, name, piece, schema.names, (inputs or {}).get(name, ""))
    return LoadResult(sum(months.values()), months=months, pieces=written, unchanged=unchanged)


def _of_months(source: DataFrame, schema: StructType, key: str, names: list[str]) -> DataFrame:
    """The rows of the named months, checked, with their month."""
    windows: list[tuple[dt.date, dt.date]] = []
    for first in (dt.datetime.strptime(name, "%Y%m").date() for name in names):
        # Neighbouring months make one range for the scan.
        begun = windows.pop()[0] if windows and windows[-1][1] == first else first
        windows.append((begun, next_month(first)))
    chosen = reduce(or_, [in_window(key, *window) for window in windows])
    rows = inside_windows(require(conform(source.filter(chosen), schema), schema), key, windows)
    return rows.withColumn(MONTH, F.date_format(key, YEAR_MONTH))
