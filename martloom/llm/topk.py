"""Exact top-k search by inner product through distributed histogram selection.

Queries and candidates are cut into blocks, and every pair of blocks is scored
at once by a matrix product. The first passes only count scores: a histogram per
query, summed over all blocks, tells the interval that holds its k-th highest
score, and the next pass splits that interval, until it is one value. The last
pass returns the scores above that value and, of those equal to it, the smallest
ids, so what is moved does not depend on the number of candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import by_batches, stored

# Vectors of a block; a pair of blocks takes 32 MB of scores.
CANDIDATES, QUERIES = 4096, 1024
BINS = 128
# Score of a candidate that is the query itself.
_OWN = np.int64(-(1 << 62))


def quantized(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component; null for a vector with a null or non-finite one, or none."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when((F.size(x) > 0) & ~bad, F.transform(x, lambda v: F.floor(v * scale)))


def _blocks(vectors: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Blocks (dim, block, ids, flat) of vectors (id, q) and how many block numbers there are."""
    many = max(1, -(-vectors.count() // size))
    # The place in the stored table tells repeated rows apart.
    place = F.xxhash64("id", F.monotonically_increasing_id())
    rows = vectors.withColumn("block", F.pmod(place, F.lit(many)).cast("int")).withColumn("dim", F.size("q"))
    packed = rows.groupBy("dim", "block").agg(F.collect_list(F.struct("id", "q")).alias("rows"))
    return packed.select("dim", "block", F.col("rows.id").alias("ids"), F.flatten("rows.q").alias("flat")), many


def _pairs(candidates: tuple[DataFrame, int], queries: tuple[DataFrame, int], state: DataFrame) -> DataFrame:
    """Each pair of blocks with the state of its queries, one row each."""
    asked = queries[0].join(state, ["dim", "block"]).select(
        "dim",
        F.col("block").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(candidates[1] - 1))).alias("cb"),
        F.col("ids").alias("q_ids"),
        F.col("flat").alias("q_flat"),
        "state",
    )
    given = candidates[0].select(
        "dim", F.explode(F.sequence(F.lit(0), F.lit(queries[1] - 1))).alias("qb"), F.col("block").alias("cb"), "ids", "flat"
    )
    return given.join(asked, ["dim", "qb", "cb"])


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]]:
    """Per pair of blocks: ids of queries, ids of candidates, scores, state in the order of the queries."""
    for batch in batches:
        for i in range(batch.num_rows):
            column = {n: batch.column(n)[i] for n in ("dim", "ids", "flat", "q_ids", "q_flat", "state")}
            dim = column["dim"].as_py()
            ids, flat, q_ids, q_flat = (
                column[n].values.to_numpy(zero_copy_only=False) for n in ("ids", "flat", "q_ids", "q_flat")
            )
            c, q = flat.reshape(-1, dim), q_flat.reshape(-1, dim)
            largest = float(np.abs(c).max()) * float(np.abs(q).max()) * dim
            # Sums of whole numbers are exact in doubles up to 2**53.
            scores = (q.astype(float) @ c.T.astype(float)).astype(np.int64) if largest < 2**53 else q @ c.T
            order = np.argsort(ids, kind="stable")
            first = np.searchsorted(ids[order], q_ids, "left")
            last = np.searchsorted(ids[order], q_ids, "right")
            for row in np.flatnonzero(last > first):
                scores[row, order[first[row] : last[row]]] = _OWN
            rows = column["state"].values
            known = {n: rows.field(n).to_numpy(zero_copy_only=False) for n in ("id", "low", "high", "width", "need")}
            at = np.argsort(known["id"])
            at = at[np.searchsorted(known["id"][at], q_ids)]
            yield q_ids, ids, scores, {n: v[at] for n, v in known.items()}


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for q_ids, _, scores, state in _scored(batches):
        bins = (scores - state["low"][:, None]) // state["width"][:, None]
        bins += np.arange(len(q_ids))[:, None] * BINS
        inside = (scores >= state["low"][:, None]) & (scores < state["high"][:, None])
        counts = np.bincount(bins[inside], minlength=len(q_ids) * BINS).reshape(-1, BINS)
        # The k-th value cannot lie below bins that hold k scores in this block alone.
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        row, place = np.nonzero((counts > 0) & (above < state["need"][:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(q_ids[row]), pa.array(place.astype(np.int32)), pa.array(counts[row, place])],
            names=["id", "bin", "n"],
        )


def _selected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores above each query's value; of those equal to it the ``need`` smallest ids."""
    for q_ids, ids, scores, state in _scored(batches):
        row, place = np.nonzero((scores >= state["low"][:, None]) & (scores > _OWN))
        score, vec = scores[row, place], ids[place]
        order = np.lexsort((vec, -score, row))
        row, score, vec = row[order], score[order], vec[order]
        tie = score == state["low"][row]
        # Number of a tie among those of its query.
        number = np.cumsum(tie) - 1
        start = np.searchsorted(row, np.arange(len(q_ids)))
        before = np.concatenate([[0], np.cumsum(tie)])[start]
        keep = ~tie | (number - before[row] < state["need"][row])
        yield pa.RecordBatch.from_arrays(
            [pa.array(q_ids[row[keep]]), pa.array(vec[keep]), pa.array(score[keep])], names=["query_id", "vec_id", "score"]
        )


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 64,
) -> DataFrame:
    """The k candidates of highest inner product for each query: query_id, rank, vec_id, score.

    Both frames hold ids and vectors, which are taken as floor(scale * x). Every
    row of ``vectors`` of the query's dimension is a candidate, but for rows with
    the query's own id; equal scores go to the smaller id; fewer than k
    candidates are all returned. Vectors that are null, empty, or hold a null or
    non-finite component, and rows without an id, take no part. Of query rows
    that repeat an id the smallest vector asks; candidate rows that repeat are
    ranked each. Scores must fit in 61 bits. Empty tables give no rows.
    """

    def clean(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(F.col(id_col).cast("bigint").alias("id"), quantized(F.col(vector_col), scale).alias("q"))
        return stored(rows.filter("id is not null and q is not null"), name)

    given = clean(vectors, "candidates")
    asked = clean(queries, "queries").groupBy("id").agg(F.min("q").alias("q"))
    asked = stored(asked, "queries")
    norm = F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    longest = given.agg(F.max(norm)).first()[0] or 0.0
    candidates, (query_blocks, many) = _blocks(given, CANDIDATES), _blocks(asked, QUERIES)
    candidates = stored(candidates[0], "blocks"), candidates[1]
    query_blocks = stored(query_blocks, "blocks")
    block_of = query_blocks.select("dim", "block", F.explode("ids").alias("id"))
    reach = asked.select("id", (F.ceil(norm * longest * (1 + 1e-9)) + 1).cast("bigint").alias("reach"))
    width = F.ceil((2 * F.col("reach") + 1) / BINS).cast("bigint")
    state = reach.select(
        "id",
        (-F.col("reach")).alias("low"),
        (F.col("reach") + 1).alias("high"),
        width.alias("width"),
        F.lit(k).cast("bigint").alias("need"),
    )
    state = stored(state, "state")

    def pairs() -> DataFrame:
        by_block = block_of.join(state, "id").groupBy("dim", "block")
        grouped = by_block.agg(F.collect_list(F.struct("id", "low", "high", "width", "need")).alias("state"))
        return _pairs(candidates, (query_blocks, many), grouped)

    widest = state.agg(F.max("width")).first()[0] or 1
    while True:
        counts = by_batches(pairs(), _histograms, "id bigint, bin int, n bigint")
        counts = counts.groupBy("id", "bin").agg(F.sum("n").alias("n"))
        higher = counts.selectExpr("id", "bin", "sum(n) over (partition by id order by bin desc) as upto", "n")
        # The highest bin with which the scores reach the number still needed.
        reached = higher.join(state, "id").filter("upto >= need and upto - n < need")
        narrowed = reached.selectExpr(
            "id",
            "low + bin * width as low",
            "least(low + (bin + 1) * width, high) as high",
            f"cast(ceil(width / {BINS}) as bigint) as width",
            "need - (upto - n) as need",
        )
        # A query with fewer scores than asked for keeps its interval, which holds them all.
        short = state.join(narrowed, "id", "left_anti")
        state = stored(narrowed.unionByName(short), "state")
        if widest <= 1:
            break
        widest = -(-widest // BINS)
    found = by_batches(pairs(), _selected, "query_id bigint, vec_id bigint, score bigint")
    rank = "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank"
    return found.selectExpr("query_id", rank, "vec_id", "score").filter(F.col("rank") <= k)
