"""Load journal: checked entries, row counts per load, stored one by one as loads run.

Each entry is a small file of its own that is there as soon as it is written. A
driver that dies in the middle of a run leaves everything it has noted, the START
of the load it died in included. ``compact`` joins the files.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom import schemas
from martloom.operators.loads import LoadResult
from martloom.sources import storage

# Kinds of entries, and the texts that stand for a missing value.
INFO, ERROR = "INFO", "ERROR"
NO_MESSAGE, NO_LOCATION = "empty", "null"


_ENTRY = (
    "log_id string, log_timestamp timestamp, log_type string, log_msg string, log_location string, log_user string"
)


def check_type(kind: str) -> str:
    if kind is None or kind.upper() not in (ERROR, INFO):
        raise ValueError(f"log type {kind!r} is not one of {ERROR}, {INFO}")
    return kind.upper()


def entries(df: DataFrame) -> DataFrame:
    """Normalise raw entries (log_type, log_msg, log_location); other columns stay.

    The type is put in upper case and must be known, quotes in the message are
    doubled, the location is put in lower case, and missing texts are filled.
    """
    kind = F.upper("log_type")
    message: Column = F.replace("log_msg", F.lit("'"), F.lit("''"))
    found = F.coalesce("log_type", F.lit("NULL"))
    wrong = F.raise_error(F.concat(F.lit("illegal log type: "), found))
    return df.withColumns(
        {
            "log_type": F.when(kind.isin(ERROR, INFO), kind).otherwise(wrong.cast("string")),
            "log_msg": F.coalesce(message, F.lit(NO_MESSAGE)),
            "log_location": F.coalesce(F.lower("log_location"), F.lit(NO_LOCATION)),
            "is_error": kind == ERROR,
        }
    )


def _stats_note(result: LoadResult) -> str:
    """Statistics of the loaded rows, one clause per column and piece."""
    clauses = (
        f"{piece} {name} nulls={s.nulls} distinct~{s.distinct} min={s.least} max={s.most}"
        for piece, found in result.pieces.items()
        for name, s in found.columns.items()
    )
    return "statistics: " + "; ".join(clauses)


class Journal:
    """Journal of a warehouse, a folder of small files. Loads may run side by side."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def write(self, *raw: tuple[str, str | None, str | None]) -> None:
        """Store entries given as (type, message, location) at once, in one file and without a job."""
        now = dt.datetime.now(dt.timezone.utc)
        user = self.spark.sparkContext.sparkUser()
        lines = [
            {
                "log_id": f"{uuid.uuid4()}",
                "log_timestamp": now.isoformat(timespec="microseconds"),
                "log_type": check_type(kind),
                "log_msg": message,
                "log_location": location,
                "log_user": user,
            }
            for kind, message, location in raw
        ]
        self._store(lines, f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex}")

    def _store(self, lines: list[dict], name: str) -> None:
        text = "".join(json.dumps(line) + "\n" for line in lines)
        storage.write_text(self.spark, f"{self.path}/{name}.json", text)

    @contextmanager
    def load(self, location: str) -> Iterator[list[LoadResult]]:
        """Journal the row count of a load, or its failure, between its start and end."""
        self.write((INFO, f"START {location}", location))
        noted: list[tuple] = []
        results: list[LoadResult] = []
        try:
            yield results
            for result in results:
                if result.skipped:
                    noted.append((INFO, "source table is empty", location))
                elif result.pieces:
                    noted.append((INFO, f"{result.rows} rows inserted", location))
                    noted.append((INFO, _stats_note(result), location))
                elif not result.unchanged:
                    noted.append((INFO, f"{result.rows} rows inserted", location))
                if result.unchanged:
                    noted.append((INFO, f"unchanged: {', '.join(result.unchanged)}", location))
            noted.append((INFO, f"END {location}", location))
        except Exception as failure:
            noted.append((ERROR, f"FAILED {location}: {failure}", location))
            raise
        finally:
            if noted:
                self.write(*noted)

    def read(self) -> DataFrame:
        """All entries, each once: while files are joined an entry can be in two of them."""
        found = self.spark.createDataFrame([], _ENTRY)
        if storage.names(self.spark, self.path):
            found = self.spark.read.schema(_ENTRY).json(self.path)
        return entries(found.dropDuplicates(["log_id"])).select(schemas.AUDIT.names)

    def compact(self) -> int:
        """Joins the files of the journal into one and returns how many there were.

        Entries of a journal are few, some per load, so they pass the driver. Files
        written meanwhile stay as they are. If it fails in between, entries are in
        two files, which ``read`` allows for.
        """
        files = [n for n in storage.names(self.spark, self.path) if not n.startswith((".", "_"))]
        if len(files) > 1:
            paths = [f"{self.path}/{name}" for name in files]
            stored = self.spark.read.text(paths).distinct().orderBy("value")
            lines = [json.loads(row["value"]) for row in stored.toLocalIterator()]
            self._store(lines, f"joined-{uuid.uuid4().hex}")
            for path in paths:
                storage.remove(self.spark, path)
        return len(files)

    def outcomes(self) -> DataFrame:
        """What became of each location's loads, without times and users."""
        inserted = F.regexp_extract("log_msg", r"^(\d+) rows inserted$", 1)
        return (
            self.read()
            .groupBy("log_location")
            .agg(
                F.count(F.lit(1)).alias("entries"),
                F.count_if("is_error").alias("errors"),
                F.count_if(F.col("log_msg") == "source table is empty").alias("skipped"),
                F.sum(F.when(inserted != "", inserted.cast("bigint"))).alias("rows_inserted"),
            )
        )

    def summary(self) -> DataFrame:
        """Entries and errors per location."""
        return (
            self.read()
            .groupBy("log_location")
            .agg(
                F.count(F.lit(1)).alias("entries"),
                F.count_if("is_error").alias("errors"),
                F.min("log_timestamp").alias("first_entry"),
                F.max("log_timestamp").alias("last_entry"),
            )
        )
