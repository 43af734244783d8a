"""The bounded lookup cache, and pruned vector search against the exact one."""

import numpy as np

from tablestream.operators import features as M
from tablestream.streaming import streams as S

from .conftest import rows


def test_cache_asks_only_for_keys_it_lacks(spark):
    table = spark.createDataFrame([(i, f"n{i}") for i in range(0, 100, 2)], "k int, name string")
    cache = S.LookupCache(spark, lambda keys: table.join(keys, "k", "left_semi"), "k", 6, 3600)
    batch = lambda ks: spark.createDataFrame([(k,) for k in ks], "k int")
    assert rows(cache.rows(batch([0, 1, 2, 2, None]))) == [(0, "n0"), (2, "n2")]
    assert rows(cache.rows(batch([0, 1, 4]))) == [(0, "n0"), (4, "n4")]
    assert cache.loads == [3, 1]                             # 1 is not in the table and is not asked for again
    got = rows(cache.rows(batch(range(10, 20))))             # a batch may need more keys than are kept
    assert [r[0] for r in got] == [10, 12, 14, 16, 18] and cache.loads[-1] == 10
    assert spark.read.parquet(cache.path).count() == 6
    cache.rows(batch([0]))
    assert cache.loads[-1] == 1                              # 0 was used less recently and had to go
    cache.ttl_s = -1
    cache.rows(batch([0]))
    assert cache.loads[-1] == 1                              # rows are not fresh any more


def test_pruned_search_finds_most_of_the_exact_neighbours(spark):
    r = np.random.default_rng(0)
    centres = r.standard_normal((20, 16))
    base = [(i, (centres[i % 20] + 0.4 * r.standard_normal(16)).tolist()) for i in range(1500)] + [(5000, None)]
    ask = [(10_000 + i, (centres[i % 20] + 0.4 * r.standard_normal(16)).tolist()) for i in range(40)]
    b, q = spark.createDataFrame(base, "bid int, v array<double>"), spark.createDataFrame(ask, "qid int, v array<double>")
    exact = rows(M.vector_topk(q, b, 5, "qid", "bid", "v", "v", block_rows=400, slice_rows=15).select("qid", "bid"))
    unit = lambda x: np.array(x) / np.linalg.norm(x)
    want = set()
    for i, v in ask:
        order = sorted(((-round(float(unit(v) @ unit(x)), 12), j) for j, x in base if x is not None))[:5]
        want |= {(i, j) for _, j in order}
    assert set(exact) == want
    pruned = rows(M.vector_topk(q, b, 5, "qid", "bid", "v", "v", 100, 15, M.fit_centroids(b, "bid", "v", 16), 4).select("qid", "bid"))
    assert len(pruned) == len(exact) and len(set(pruned) & want) / len(want) >= 0.9
    few = M.vector_topk(q, b.limit(3), 5, "qid", "bid", "v", "v")
    assert few.count() == 3 * len(ask) or few.count() == 2 * len(ask)
