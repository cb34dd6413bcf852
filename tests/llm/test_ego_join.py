import math
import random

import numpy as np

from corpusloom.llm.ego_join import embedding_links, op7_ego_join

from .conftest import DATA
from .test_simhash_covering import plain_components


def brute(rows, cosine=0.95):
    def ok(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def near(i, j):
        a, b = rows[i], rows[j]
        if a[0] is None or b[0] is None or not ok(a[1]) or not ok(b[1]) or len(a[1]) != len(b[1]):
            return False
        x, y = np.array(a[1], float), np.array(b[1], float)
        x, y = x / np.abs(x).max(), y / np.abs(y).max()
        return float(x @ y) / math.sqrt(float(x @ x) * float(y @ y)) >= cosine

    n = len(rows)
    link = [[i != j and near(i, j) for j in range(n)] for i in range(n)]
    comp = plain_components(range(n), lambda i, j: link[i][j])
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[comp[i]] = min(least.get(comp[i], rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], sum(link[i]), None if rows[i][0] is None else least[comp[i]]) for i in range(n)), key=str)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    x = np.array([r[1] for r in rows], float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    comp = plain_components(range(len(rows)), lambda i, j: near[i, j])
    want = {rows[i][0]: (int(near[i].sum()), rows[comp[i]][0]) for i in range(len(rows))}
    got = {r.vec_id: (r.n_links, r.component_id) for r in op7_ego_join(spark, DATA).collect()}
    assert got == want


def test_odd_vectors_and_small_segments(spark):
    rng = random.Random(5)
    rows = []
    for c in range(6):
        base = [rng.gauss(0, 1) for _ in range(6)]
        rows += [(c * 20 + i, [x + rng.gauss(0, 0.12) for x in base]) for i in range(16)]
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (204, [float("nan")] * 6), (205, [float("inf")] + [0.0] * 5), (206, [1.0, 0.0]), (207, [2.0, 0.0]), (208, [1e-30] * 6), (209, [1e30] * 6)]
    rows += [(None, rows[0][1]), (0, rows[0][1]), (300, rows[0][1]), (7, [-0.0, 1.0, 0.0, 0.0, 0.0, 0.0]), (8, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, n string")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in embedding_links(df, segment=16).collect()), key=str)
    assert got == brute(rows)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in embedding_links(df).collect())
    assert embedding_links(df.limit(0)).count() == 0
