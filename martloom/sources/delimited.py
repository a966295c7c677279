"""Delimited files with a declared schema and a limit on rejected rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from martloom.operators.quality import LoadError, conform

REJECT = "_rejected_row"
DAY_FORMAT = "yyyy-MM-dd"

# Stands for a quoted empty field while the file is parsed: the reader would
# otherwise give NULL for it, as for an unquoted one.
_QUOTED_EMPTY = "\u0001"


class RejectLimitReached(LoadError):
    """A file holds as many malformed rows as the load tolerates, or more."""


def _value(field: StructField) -> Column:
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, StringType):
        return F.when(text == _QUOTED_EMPTY, F.lit("")).otherwise(text)
    if isinstance(field.dataType, DateType):
        return F.try_to_date(text, DAY_FORMAT)
    return text.try_cast(field.dataType)


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    header: bool = True,
    delimiter: str = ";",
    multi_line: bool = False,
) -> DataFrame:
    """Rows of the file; a malformed one keeps its text in the reject column.

    An unquoted empty field is NULL, a quoted one is empty text, and a quote
    inside a quoted field is doubled. Fields that span lines need
    ``multi_line``, which costs the splitting of large files.

    A row is malformed if it has too few or too many fields or a field that is
    not of its column's type. The fields are read as text and typed here, so
    that the check covers all columns whichever of them a query goes on to use.
    """
    names = schema.names
    texts = StructType([StructField(n, StringType()) for n in [*names, REJECT]])
    lines = (
        spark.read.schema(texts)
        .option("sep", delimiter)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", _QUOTED_EMPTY)
        .option("encoding", "UTF-8")
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECT)
        .option("columnPruning", False)
        .csv(path)
    )
    values = {f.name: _value(f) for f in schema.fields}
    wrong = reduce(or_, [F.col(f"`{n}`").isNotNull() & values[n].isNull() for n in names])
    row = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]), {"sep": delimiter})
    reject = F.coalesce(F.col(REJECT), F.when(wrong, row))
    return lines.select(*[v.alias(n) for n, v in values.items()], reject.alias(REJECT))


def accepted(scan: DataFrame, schema: StructType) -> DataFrame:
    return conform(scan.filter(F.col(REJECT).isNull()), schema)


def rejected(scan: DataFrame) -> DataFrame:
    return scan.filter(F.col(REJECT).isNotNull())


def check_reject_limit(scan: DataFrame, limit: int) -> None:
    """Fail once ``limit`` malformed rows are found; at most that many are looked at."""
    found = rejected(scan).select(REJECT).limit(limit).count()
    if found >= limit:
        raise RejectLimitReached(f"reject limit of {limit} rows reached")


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    header: bool = True,
    reject_limit: int | None = 5,
    delimiter: str = ";",
    multi_line: bool = False,
    staging: str | None = None,
) -> DataFrame:
    """Well-formed rows of the file, provided the malformed ones stay under the limit.

    Checking the limit parses the file once more. For large files name a
    ``staging`` folder: the file is parsed once into it, the check reads only
    its reject column, and the rejected rows can be looked up there.
    """
    scan = scan_delimited(spark, path, schema, header, delimiter, multi_line)
    if staging:
        scan.write.mode("overwrite").option("compression", "zstd").parquet(staging)
        scan = spark.read.schema(scan.schema).parquet(staging)
    if reject_limit is not None:
        check_reject_limit(scan, reject_limit)
    return accepted(scan, schema)


def write_delimited(df: DataFrame, path: str, header: bool = True, delimiter: str = ";") -> None:
    """Files in the form ``read_delimited`` takes back unchanged."""
    (
        df.write.mode("overwrite")
        .option("sep", delimiter)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
