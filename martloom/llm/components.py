"""Connected components of a graph given by its edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """One row (id, label) per node of ``edges`` (a, b); the label is the component's smallest node.

    Each round links the larger neighbours of a node to its smallest one, then
    the node and its smaller ones. Rounds end when nothing changes, after about
    the logarithm of the longest path. Minima are combined before the shuffle,
    so a node with very many neighbours costs no more than they do elsewhere.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links = stored(links, "links")
    state = _state(links)
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        rest = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        links = stored(rest.union(smallest).distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    labels = links.select(F.col("a").alias("id"), F.col("b").alias("label"))
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct()
    return labels.union(roots)


def _state(links: DataFrame) -> tuple:
    """Size and checksums of the edges."""
    mixed = F.xxhash64("a", "b")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mixed % 1_000_003), F.bit_xor(mixed)).first())
