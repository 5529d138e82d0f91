import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import top_k as t


def brute(rows, k):
    x = sorted({(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows
                if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)})
    out = []
    for q, a in x:
        if q % t.QUERY_STEP == 0:
            best = sorted((-sum(p * r for p, r in zip(a, b, strict=False)), i) for i, b in x if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize(("shard", "block", "stop", "items", "wave"),
                         [(4096, 512, 64, 1 << 21, 65_536), (37, 2, 5, 1 << 21, 65_536), (37, 2, 5, 48, 10)])
def test_results_match_all_scores(spark, monkeypatch, shard, block, stop, items, wave):
    for name, value in (("SHARD", shard), ("QUERY_BLOCK", block), ("STOP", stop), ("QUERY_ITEMS", items), ("WAVE", wave)):
        monkeypatch.setattr(t, name, value)
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 0.2) for _ in range(8)]) for k in range(400)]
    rows += [(400 + k, rows[7][1]) for k in range(40)]                       # ties
    rows += [(50, rows[50][1]), (900, None), (950, [0.1, None]), (1000, [float("nan")] * 8), (1050, [float("inf")] * 8),
             (None, rows[1][1]), (1100, [0.0] * 8), (1150, [0.3] * 3), (1200, []), (1251, [5e5] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0))
    x = t.quantised(vectors)
    got = t.top_k(x, x.where(F.col("vec_id") % t.QUERY_STEP == 0))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, t.K)


def test_few_or_no_vectors(spark):
    x = t.quantised(spark.createDataFrame([(0, [0.5]), (1, [1.0]), (2, [-1.0])], "vec_id long, embedding array<float>"))
    assert [tuple(r) for r in t.top_k(x, x.where("vec_id = 0")).orderBy("rank").collect()] == [(0, 1, 1, 32768), (0, 2, 2, -32768)]
    one = x.where("vec_id = 0")
    assert t.top_k(one, one).count() == 0 and t.top_k(x.limit(0), x.limit(0)).count() == 0


def test_search_of_a_shard_matches_all_products():
    rng = np.random.default_rng(5)
    for n, width in ((0, 3), (3, 4), (500, 16)):
        x = np.floor(rng.normal(0, 40, (n, width)) * (rng.random((n, width)) < 0.6)).astype(np.int64)
        x[n // 2:n // 2 + 20] = x[:1]                                        # ties
        q, ids = x[::7].copy(), rng.permutation(n) + 10
        index = t.ImpactIndex(x)
        assert sum(hi - lo for level in index.levels for _, lo, hi in level[0]) == np.count_nonzero(x)
        every = x @ q.T
        for stop, floor in ((0, None), (5, None), (0, np.full(len(q), 900)), (64, np.full(len(q), -(10 ** 15)))):
            of, near, score = t.search(index, ids, q, ids[::7], t.K, stop, floor)
            for k in range(len(q)):
                want = sorted((-int(s), int(i)) for s, i in zip(every[:, k], ids, strict=True) if i != ids[::7][k])[:t.K]
                want = [(i, -s) for s, i in want if floor is None or -s >= floor[k]]
                assert list(zip(near[of == k].tolist(), score[of == k].tolist(), strict=True)) == want


def test_large_components_are_scored_as_integers():
    x = np.array([[2 ** 30, 1], [2 ** 30, 2], [2 ** 30 - 1, 2 ** 30], [1, 2 ** 30]], np.int64)
    of, near, score = t.search(t.ImpactIndex(x), np.arange(4), x[:1], np.array([9]), 3)
    assert list(zip(near.tolist(), score.tolist(), strict=True)) == [
        (1, 2 ** 60 + 2), (0, 2 ** 60 + 1), (2, 2 ** 60)]
