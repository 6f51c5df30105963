import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from revcast.llm import ann as A


def brute(rows, is_query, k=10):
    out = {}
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    for i, q in ok:
        if is_query(i):
            near = sorted({(math.sqrt(((q - v) ** 2).sum()), j) for j, v in ok if j != i and len(v) == len(q)})[:k]
            out.setdefault(i, set()).add(tuple(j for _, j in near))
    return out


def test_recall_and_exact_scores(spark):
    for path in ("/root/testdata/sf0.1/embeddings.parquet",):
        df = spark.read.parquet(path)
        rows = [(r[0], r[1]) for r in df.select("vec_id", "embedding").collect()]
        want = brute(rows, lambda i: i % 100 == 0)
        found = {}
        vector = {i: np.array(v, float) for i, v in rows}
        for r in A.search(df, F.col("vec_id") % 100 == 0).collect():
            found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
            assert math.isclose(r["score"], math.sqrt(((vector[r["query_id"]] - vector[r["vec_id"]]) ** 2).sum()), rel_tol=1e-12)
        hits = sum(len({j for _, j in found[q]} & set(next(iter(want[q])))) for q in want)
        assert hits >= 0.9 * 10 * len(want)
        assert all([n for n, _ in sorted(f)] == list(range(1, 11)) for f in found.values())


def test_few_candidates_are_all_returned_and_bad_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [0.0, 0.0, -3.0]), (3, [0.0, 0.0, 0.0]), (4, None), (5, []),
            (6, [1.0, None, 2.0]), (7, [float("nan"), 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]), (9, [1.0, 1.0]),
            (100, [0.0, 1.0, 0.0]), (100, [0.0, 1.0, 0.0]), (None, [1.0, 1.0, 1.0]), (200, [2.0, 2.0])]
    df = spark.createDataFrame([(i, v, "a", 1) for i, v in rows], "vec_id long, embedding array<double>, rank string, query_id int")
    got = {}
    for r in A.search(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert [j for _, j, _ in sorted(got[0])] == [1, 100, 2] and sorted(got[100])[0][1:] == (1, 0.0)
    assert sorted(got[200]) == [(1, 9, math.sqrt(2))]
    assert A.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_a_common_vector_fills_blocks(spark):
    rng = random.Random(1)
    rows = [(i, [0.6, 0.8, 0.0, 0.1]) for i in range(1500)] + [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(1500, 2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in A.search(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert [j for _, j, _ in sorted(got[100])] == list(range(10)) and all(s == 0 for _, _, s in got[100])


@pytest.mark.parametrize("n", [1, 3, 64])
def test_rotation_keeps_lengths(n):
    width = 1 << max(0, (n - 1).bit_length())
    x = np.random.default_rng(n).normal(size=(20, width))
    assert np.allclose(np.linalg.norm(A.rotate(x, 3), axis=1), np.linalg.norm(x, axis=1))
    near = A.axes(x[:, :n], 0, 4)
    assert near.shape[1] == min(4, 2 * width) and (near < 2 * width).all()
