"""Approximate neighbours against all products: recall, exact scores, whole results, odd input."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import neighbours
from martloom.llm.queries import llm_queries

ROWS = "vec_id long, embedding array<float>"


def plain(rows, queries, k):
    """All products, summed in order of the components."""
    result = {}
    for query, q in queries:
        found = []
        for vec, v in rows:
            if vec != query and len(v) == len(q):
                total = 0.0
                for x, y in zip(v, q):
                    total += float(np.float32(x)) * float(np.float32(y))
                found.append((-total, vec))
        result[query] = [(vec, -s) for s, vec in sorted(found)[:k]]
    return result


def grouped(df):
    found = {}
    for row in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert row["rank"] == len(found.setdefault(row["query_id"], [])) + 1
        found[row["query_id"]].append((row["vec_id"], row["score"]))
    return found


def test_quantile_of_the_test():
    for dims, share, value in ((2, 0.95, 5.991), (6, 0.9, 10.645), (8, 0.95, 15.507)):
        assert math.isclose(neighbours.chi_square_quantile(share, dims), value, abs_tol=1e-3)
    with pytest.raises(ValueError):
        neighbours.chi_square_quantile(0.9, 7)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    v = np.array([r["embedding"] for r in table], dtype=np.float64)
    ids = np.array([r["vec_id"] for r in table])
    found, hits, all_of = grouped(llm_queries()["op12_nearest_neighbours"](spark, folder)), 0, 0
    assert set(found) == {int(i) for i in ids if i % 20 == 0}
    for query, answers in found.items():
        scores = neighbours.products(v, v[ids == query][0])
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:20]
        assert len(answers) == 20 and answers == sorted(answers, key=lambda a: (-a[1], a[0]))
        assert all(score == scores[ids == vec][0] for vec, score in answers)
        hits, all_of = hits + len({int(ids[i]) for i in order} & {a for a, _ in answers}), all_of + 20
    assert hits / all_of >= 0.9


def test_leaves_norms_and_recall(spark):
    """Many leaves, clusters, norms from small to large."""
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 24))
    v = (centres[rng.integers(0, 40, 4000)] + 0.3 * rng.standard_normal((4000, 24))) * rng.uniform(0.1, 3, (4000, 1))
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v.astype(np.float32))]
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    asked = df.filter("vec_id % 40 = 0")
    found = grouped(neighbours.nearest_neighbours(df, asked, k=10, leaf_rows=100))
    wanted = plain(rows, [r for r in rows if r[0] % 40 == 0], 10)
    assert sum(len({a for a, _ in found[q]} & {a for a, _ in w}) for q, w in wanted.items()) >= 0.9 * 1000
    sure = grouped(neighbours.nearest_neighbours(df, asked, k=10, leaf_rows=100, confidence=1 - 1e-12))
    assert sure == wanted


def test_odd_rows(spark):
    rows = [(i, [0.5, 0.25]) for i in range(60)] + [(60 + i, [1.0, float(i)]) for i in range(30)]
    odd = [(200, None), (201, []), (202, [0.0, 0.0]), (203, [1.0, None]), (204, [float("nan"), 1.0]), (205, [float("inf"), 1.0]),
           (206, [1.0, 2.0, 3.0]), (207, [2.0, 2.0, 3.0]), (None, [9.0, 9.0]), (61, [9.0, 9.0]), (3, [0.5, 0.25])]
    df = spark.createDataFrame(rows + odd, ROWS).withColumns({"id": F.lit(1), "v": F.lit(2), "score": F.lit("x"), "leaf": F.lit(0)})
    found = grouped(neighbours.nearest_neighbours(df, df, k=5, confidence=1 - 1e-12))
    whole = [*rows, (206, [1.0, 2.0, 3.0]), (207, [2.0, 2.0, 3.0])]
    assert found == plain(whole, whole, 5)
    assert grouped(neighbours.nearest_neighbours(df.limit(0), df)) == {}
    assert grouped(neighbours.nearest_neighbours(df, df.limit(0))) == {}
    large = spark.createDataFrame([(1, [3e38, 1.0]), (2, [3e38, 3e38]), (3, [-3e38, 1e-30])], ROWS)
    assert [v for v, _ in grouped(neighbours.nearest_neighbours(large, large))[1]] == [2, 3]
