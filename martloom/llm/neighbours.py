"""Approximate nearest neighbours by stable projections, indexed by a kd-tree.

Vectors are projected to a few dimensions by a matrix of normal variates. The
square of a projected distance, over that of the true distance, then follows a
chi-square distribution, whatever the vectors are. So neighbours are verified in
order of their projected distance until the next one is so far out that a vector
nearer than the k-th found would, with the stated confidence, have come before.

Largest inner products are nearest neighbours: every vector gets one more
component that fills it up to the largest norm, every query is stretched to that
norm, and the square of the distance is then a constant less the product.

A kd-tree over the projected space, fitted on a bounded sample, cuts the vectors
into leaves. A query first visits the leaves next to it; the k-th product found
there bounds the projected distance at which the test must hold, and only leaves
whose boxes come nearer than that are visited next. In each leaf neighbours are
taken in order of projected distance, under the same test.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martloom.llm.common import by_batches, stored

# Vectors of a leaf, queries of a batch, leaves of the first visit, neighbours verified between two tests.
LEAF, QUERIES, PROBES, STEP = 2048, 512, 4, 256


def chi_square_quantile(share: float, dims: int) -> float:
    """The value below which a chi-square variate of an even number of dimensions lies with this probability."""
    if dims < 2 or dims % 2:
        raise ValueError("the number of projected dimensions must be even")

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))

    low, high = 0.0, 1.0
    while below(high) < share:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return high


class _Space:
    """Projection of vectors and queries, the tree over it, and the test; travels with the tasks."""

    def __init__(self, longest: int, scale: float, norm: float, dims: int, confidence: float, k: int):
        draws = np.random.default_rng(20_11).standard_normal((longest + 1, dims))
        # Rows of the length they have on average: where one component rules all distances, as the added
        # one does among vectors of very different norms, a long row would push out every neighbour at once.
        draws *= np.sqrt(dims) / np.linalg.norm(draws, axis=1, keepdims=True)
        self.matrix, self.extra = draws[1:], draws[0]
        self.scale, self.norm, self.k = scale, norm, k
        self.limit = chi_square_quantile(confidence, dims)
        self.axis, self.value = np.empty(0, np.int64), np.empty(0)

    def vectors(self, v: np.ndarray) -> np.ndarray:
        v = v / self.scale
        missing = np.sqrt(np.maximum(self.norm**2 - (v * v).sum(1), 0))
        return v @ self.matrix[: v.shape[1]] + missing[:, None] * self.extra

    def queries(self, q: np.ndarray) -> np.ndarray:
        q = q / self.scale
        return q * (self.norm / np.linalg.norm(q, axis=1))[:, None] @ self.matrix[: q.shape[1]]

    def reach(self, product: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Squared projected distance at which the test holds, given the k-th product and the query's length."""
        near = 2 * self.norm**2 - 2 * self.norm * product / self.scale**2 / lengths
        return self.limit * np.maximum(near, 0)

    def fit(self, points: np.ndarray, leaves: int) -> None:
        """Cuts the sample at medians of the widest axis, as often as the leaves need."""
        depth = max(0, math.ceil(math.log2(max(leaves, 1))))
        self.axis, self.value = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1)
        parts = {0: points}
        for node in range(len(self.axis)):
            part = parts.pop(node)
            if len(part):
                axis = int(np.argmax(part.max(0) - part.min(0)))
                self.axis[node], self.value[node] = axis, np.median(part[:, axis])
            over = part[:, self.axis[node]] > self.value[node]
            parts[2 * node + 1], parts[2 * node + 2] = part[~over], part[over]

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range((len(self.axis) + 1).bit_length() - 1):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] > self.value[node])
        return node - len(self.axis)


def _values(cell: pa.Scalar) -> np.ndarray:
    return cell.values.to_numpy(zero_copy_only=False)


def _matrix(flat: np.ndarray, dim: int) -> np.ndarray:
    return flat.reshape(-1, dim)


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row numbers and vectors of a batch, for each length of vectors."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        yield int(dim), rows, _matrix(batch.column("v").take(pa.array(rows)).flatten().to_numpy(), dim)


def _routed(classes: DataFrame, space: _Space, queries: bool) -> DataFrame:
    """Vectors (id, dim, v) with the leaf they fall in."""
    names = classes.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int64)
            for _, rows, v in _by_dim(batch):
                leaf[rows] = space.leaf(space.queries(v) if queries else space.vectors(v))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*names, "leaf"])

    return by_batches(classes, work, StructType([*classes.schema.fields, StructField("leaf", LongType())]))


def _projected(classes: DataFrame, space: _Space) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, v in _by_dim(batch):
                yield pa.RecordBatch.from_arrays([_lists(list(space.vectors(v)), pa.float64())], names=["point"])

    return by_batches(classes, work, "point array<double>")


def _boxes(blocks: DataFrame, space: _Space) -> DataFrame:
    """Number of vectors and extremes of the projected ones, per block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dim, leaf = (batch.column(c)[row].as_py() for c in ("dim", "leaf"))
                points = space.vectors(_matrix(_values(batch.column("flat")[row]), dim))
                ends = [_lists([list(e)], pa.float64()) for e in (points.min(0), points.max(0))]
                head = [pa.array([n], pa.int64()) for n in (dim, leaf, len(points))]
                yield pa.RecordBatch.from_arrays([*head, *ends], names=["dim", "leaf", "n", "low", "high"])

    return by_batches(blocks, work, "dim bigint, leaf bigint, n bigint, low array<double>, high array<double>")


def _visits(batches_of: DataFrame, boxes: dict[int, tuple], space: _Space, again: bool) -> DataFrame:
    """For each batch of queries and each leaf they visit, these queries.

    The first visit is to the nearest boxes, as many as hold k vectors and at
    least ``PROBES``; the second to all others that the test cannot rule out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dim = batch.column("dim")[row].as_py()
                ids, floors = (_values(batch.column(c)[row]) for c in ("ids", "floors"))
                v = _matrix(_values(batch.column("flat")[row]), dim)
                if dim not in boxes:
                    continue
                leaves, sizes, low, high = boxes[dim]
                points = space.queries(v)
                apart = np.zeros((len(v), len(leaves)))
                for axis in range(points.shape[1]):
                    p = points[:, axis, None]
                    apart += np.maximum(np.maximum(low[:, axis] - p, p - high[:, axis]), 0) ** 2
                order = np.argsort(apart, axis=1, kind="stable")
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                early = (before < space.k) | (np.arange(len(leaves)) < PROBES)
                first = np.zeros_like(early)
                np.put_along_axis(first, order, early, axis=1)
                wanted = first
                if again:
                    lengths = np.linalg.norm(v / space.scale, axis=1)
                    reach = np.where(np.isfinite(floors), space.reach(floors, lengths), np.inf)
                    wanted = ~first & (apart <= reach[:, None])
                for place in np.flatnonzero(wanted.any(0)):
                    mine = np.flatnonzero(wanted[:, place])
                    arrays = [pa.array([dim], pa.int64()), pa.array([int(leaves[place])], pa.int64())]
                    arrays += [_lists([ids[mine]], pa.int64()), _lists([floors[mine]], pa.float64())]
                    arrays.append(_lists([v[mine].ravel()], pa.float64()))
                    yield pa.RecordBatch.from_arrays(arrays, names=["dim", "leaf", "q_ids", "floors", "q_flat"])

    return by_batches(
        batches_of, work, "dim bigint, leaf bigint, q_ids array<bigint>, floors array<double>, q_flat array<double>"
    )


def products(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products summed component by component, so that they do not depend on what is computed beside them."""
    total = np.zeros(len(v))
    for i, x in enumerate(q):
        total += v[:, i] * x
    return total


def _verified(pairs: DataFrame, space: _Space) -> DataFrame:
    """The best of each leaf for each of its visitors: query_id, vec_id, score."""

    def nearest(v: np.ndarray, apart: np.ndarray, q: np.ndarray, floor: float) -> np.ndarray:
        """Places of vectors that may be among the k nearest, verified in order until the test holds."""
        length, order = np.linalg.norm(q / space.scale), np.argsort(apart, kind="stable")
        slack = 1e-9 * space.scale**2 * space.norm * length
        found, places, least = np.empty(0), np.empty(0, np.int64), floor
        for start in range(0, len(order), STEP):
            if np.isfinite(least) and apart[order[start]] > space.reach(least, length):
                break
            some = order[start : start + STEP]
            scores = v[some] @ q
            near = scores >= least - slack
            found, places = np.concatenate([found, scores[near]]), np.concatenate([places, some[near]])
            if len(found) > space.k:
                least = max(least, float(np.partition(found, -space.k)[-space.k]))
                near = found >= least - slack
                found, places = found[near], places[near]
        return places

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dim = batch.column("dim")[row].as_py()
                v = _matrix(_values(batch.column("flat")[row]), dim)
                q = _matrix(_values(batch.column("q_flat")[row]), dim)
                owners = batch.column("ids")[row].values
                starts, members = owners.offsets.to_numpy(), owners.values.to_numpy()
                q_ids, floors = (_values(batch.column(c)[row]) for c in ("q_ids", "floors"))
                points, asked = space.vectors(v), space.queries(q)
                out = []
                for i, query in enumerate(q):
                    apart = ((points - asked[i]) ** 2).sum(1)
                    places = nearest(v, apart, query, floors[i])
                    scores = products(v[places], query)
                    many = starts[places + 1] - starts[places]
                    vec = np.concatenate([members[starts[p] : starts[p + 1]] for p in places] or [np.empty(0, np.int64)])
                    score = np.repeat(scores, many)
                    order = np.lexsort((vec, -score))[: space.k]
                    order = order[score[order] >= floors[i]]
                    out.append((np.full(len(order), q_ids[i]), vec[order], score[order]))
                arrays = [pa.array(np.concatenate(c)) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

    return by_batches(pairs, work, "query_id bigint, vec_id bigint, score double")


def _whole(vector: Column) -> Column:
    """The vector in doubles; null if it is null, empty or zero or has a null or non-finite component."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad & F.exists(x, lambda v: v != 0.0), x)


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 8,
    confidence: float = 0.95,
    sample_rows: int = 50_000,
    leaf_rows: int = LEAF,
) -> DataFrame:
    """The k vectors of largest inner product found for each query: query_id, rank, vec_id, score.

    Every row of ``vectors`` of the query's dimension is a candidate, but for the
    one with the query's own id; equal scores go to the smaller id; if there are
    fewer than k candidates, all are returned. A vector nearer than the k-th
    returned one is missed with a chance of at most ``1 - confidence``. Scores are
    exact, in double precision. The tree is fitted on about ``sample_rows`` vectors
    chosen by hash, all vectors are indexed in its leaves; there are at most
    ``sample_rows / 8`` leaves.

    Vectors that are null, empty or zero, or hold a null or non-finite component,
    and rows without an id, take no part. Of rows that repeat an id the smallest
    vector counts, once. Of equal vectors only the k + 1 smallest ids can be
    returned, so only these are indexed; equal queries are searched once. Empty
    tables give no rows.
    """

    def clean(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("bigint").alias("id"), _whole(F.col(vector_col)).alias("v"))
        return rows.filter("id is not null and v is not null").groupBy("id").agg(F.min("v").alias("v"))

    place = "dense_rank() over (partition by v order by id) as place"
    copies = clean(vectors).selectExpr("id", "v", place).filter(F.col("place") <= k + 1)
    classes = copies.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = stored(classes.selectExpr("cast(size(v) as bigint) as dim", "ids", "v"), "classes")
    asked = stored(clean(queries), "asked")
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    scale, longest, many = classes.agg(F.max(largest), F.max("dim"), F.count(F.lit(1))).first()
    scale, longest = scale or 1.0, max(longest or 1, asked.agg(F.max(F.size("v"))).first()[0] or 1)
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x / scale * (x / scale))
    norm = classes.agg(F.max(F.sqrt(squares))).first()[0] or 1.0
    # A query's own row may be among the found, so one more is looked for.
    space = _Space(longest, scale, norm, dims, confidence, k + 1)
    share = min(1.0, sample_rows / max(many, 1))
    chosen = F.pmod(F.xxhash64(F.lit("tree"), "v"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = _projected(classes.filter(chosen), space).toArrow().column("point").combine_chunks()
    points = sample.flatten().to_numpy().reshape(-1, dims)
    space.fit(points, min(-(-many // leaf_rows), len(points) // 8))

    packed = _routed(classes, space, queries=False).groupBy("dim", "leaf").agg(F.collect_list(F.struct("ids", "v")).alias("rows"))
    blocks = stored(packed.select("dim", "leaf", F.col("rows.ids").alias("ids"), F.flatten("rows.v").alias("flat")), "leaves")
    boxes: dict[int, list] = {}
    for row in _boxes(blocks, space).orderBy("dim", "leaf").toLocalIterator():
        boxes.setdefault(row["dim"], []).append((row["leaf"], row["n"], row["low"], row["high"]))
    boxes = {dim: tuple(map(np.array, zip(*rows))) for dim, rows in boxes.items()}

    same = asked.groupBy("v").agg(F.min("id").alias("id")).select("id", F.size("v").cast("bigint").alias("dim"), "v")
    same = stored(_routed(same, space, queries=True), "queries")
    most = same.groupBy("dim", "leaf").count().agg(F.max("count")).first()[0] or 1
    part = F.pmod(F.xxhash64("id"), F.lit(-(-most // QUERIES)))

    def found(rows: DataFrame, again: bool) -> DataFrame:
        """Visits of queries (id, dim, v, leaf, floor) and what they find."""
        grouped = rows.groupBy("dim", "leaf", part.alias("part")).agg(F.collect_list(F.struct("id", "floor", "v")).alias("rows"))
        gathered = grouped.select(
            "dim", F.col("rows.id").alias("ids"), F.col("rows.floor").alias("floors"), F.flatten("rows.v").alias("flat")
        )
        visits = _visits(gathered, boxes, space, again)
        return _verified(visits.join(blocks, ["dim", "leaf"]), space)

    first = stored(found(same.withColumn("floor", F.lit(float("-inf"))), again=False), "first")
    # The k-th product found so far; at most k come from each of the few leaves visited.
    scores = F.sort_array(F.collect_list("score"), asc=False)
    floors = first.groupBy(F.col("query_id").alias("id")).agg(F.get(scores, F.lit(k)).alias("floor"))
    known = same.join(floors, "id", "left").fillna(float("-inf"), ["floor"])
    every = first.unionByName(found(known, again=True))
    rank = "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank"
    best = every.selectExpr("*", rank).filter(F.col("rank") <= k + 1).drop("rank")
    # Queries with equal vectors take what their common search has found.
    one = same.select(F.col("id").alias("one"), "v")
    members = asked.join(one, "v").select("id", "one")
    own = best.join(members, best["query_id"] == members["one"]).filter("vec_id <> id")
    return own.selectExpr("id as query_id", "vec_id", "score").selectExpr("query_id", rank, "vec_id", "score").filter(F.col("rank") <= k)
