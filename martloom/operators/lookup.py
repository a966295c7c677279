"""Dictionary lookups: key to attributes, with a typed default for unknown keys."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

from martloom.operators.joins import fact_join


def type_default(kind: DataType) -> object:
    """Value of a missing entry: empty text or zero; other types have none."""
    if isinstance(kind, StringType):
        return ""
    return 0 if isinstance(kind, NumericType) else None


@dataclass(frozen=True)
class Dictionary:
    """Entries of a source by key: ``attributes`` (source column -> output name).

    Where a key repeats, the entry last in order of ``pick`` stays.
    """

    source: DataFrame
    key: str
    attributes: Mapping[str, str]
    pick: tuple[str, ...] = ()

    def entries(self, on: str) -> DataFrame:
        order = F.struct(*(self.pick or self.attributes))
        entry = F.struct(*(F.col(a).alias(out) for a, out in self.attributes.items()))
        known = self.source.filter(F.col(self.key).isNotNull())
        return known.select(F.col(self.key).alias(on), entry.alias("entry"), order.alias("rank"))


def dict_lookups(
    df: DataFrame,
    on: str,
    dictionaries: list[Dictionary],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Add the attributes of several dictionaries that are looked up by the same key.

    The entries are brought together by one aggregate, whose tasks keep one
    entry per key and dictionary, and the rows are joined to them once. A key
    that is unknown gives a typed default. The entries grow with their sources,
    so both sides are shuffled; the entries are never broadcast.
    """
    parts = [d.entries(on) for d in dictionaries]
    kinds = [df.schema["entry"].dataType for df in parts], [df.schema["rank"].dataType for df in parts]
    rows = []
    for i, part in enumerate(parts):
        blanks = [
            (F.col(c) if j == i else F.lit(None)).cast(kind).alias(f"_{c}{j}")
            for c, of_all in zip(("entry", "rank"), kinds)
            for j, kind in enumerate(of_all)
        ]
        rows.append(part.select(on, *blanks))
    every = reduce(DataFrame.unionByName, rows)
    picked = [F.max_by(f"_entry{i}", f"_rank{i}").alias(f"_entry{i}") for i in range(len(parts))]
    found = fact_join(df, every.groupBy(on).agg(*picked), [on], "left")
    columns = []
    for i, dictionary in enumerate(dictionaries):
        for attribute, out in dictionary.attributes.items():
            kind = dictionary.source.schema[attribute].dataType
            default = F.lit((defaults or {}).get(out, type_default(kind))).cast(kind)
            columns.append(F.coalesce(F.col(f"_entry{i}")[out], default).alias(out))
    return found.select(*df.columns, *columns)


def dict_lookup(
    df: DataFrame,
    source: DataFrame,
    key: str,
    attributes: Mapping[str, str],
    on: str | None = None,
    pick: list[str] | None = None,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Add ``attributes`` of the entry of each row's key, as ``dict_lookups`` for one dictionary."""
    return dict_lookups(df, on or key, [Dictionary(source, key, attributes, tuple(pick or ()))], defaults)
