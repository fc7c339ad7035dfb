import math

import numpy as np
from pyspark.sql import functions as F

from accessgrid.llm import topk


def brute(rows, asked, k=10):
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in {(i, tuple(v)) for i, v in good if asked(i)}:
        scored = sorted((-min(2**63 - 1, sum(a * b for a, b in zip(qv, v))), i) for i, v in good if i != q and len(v) == len(qv))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def rows_of(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 100)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert rows_of(topk.top_k(df, F.col("vec_id") % 50 == 0)) == brute(rows, lambda i: i % 50 == 0)


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    same = [float(x) for x in rng.normal(size=7)]
    rows = [(n, same) for n in range(30)]
    rows += [(100, None), (200, []), (300, [None] * 7), (400, [float("nan")] * 7), (500, [float("inf")] * 7), (None, same)]
    rows += [(600, [1.0, 2.0]), (700, [3.0, -4.0]), (800, [1e15] * 7), (0, same), (3, same)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS v", "3 AS floor")
    assert rows_of(topk.top_k(df, F.col("vec_id") % 100 == 0)) == brute(rows, lambda i: i % 100 == 0)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_a_third_of_all_rows_is_one_row(spark, monkeypatch):
    """Blocks keep their size, and the row takes as many ranks as it has copies."""
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 50)
    rng = np.random.default_rng(3)
    rows = [(n, [float(x) for x in rng.normal(size=5)]) for n in range(400)]
    rows += [(7, [4.0, -4.0, 4.0, -4.0, 4.0])] * 200 + [(8, [4.0, -4.0, 4.0, -4.0, 3.0])] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS times", "2 AS copy")
    assert rows_of(topk.top_k(df, F.col("vec_id") % 100 == 0)) == brute(rows, lambda i: i % 100 == 0)
    assert rows_of(topk.top_k(df, F.col("vec_id") == 7)) == brute(rows, lambda i: i == 7)
    sizes = []
    whole = topk._blocks
    monkeypatch.setattr(topk, "_blocks", lambda *a: sizes.append(whole(*a)) or sizes[-1])
    topk.top_k(df, F.col("vec_id") % 100 == 0)
    largest = [b.agg(F.max(F.size("x_id"))).first()[0] for b in sizes if "x_id" in b.columns]
    assert largest and max(largest) < 100


def test_bounds_never_exceed_the_distance():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(40, 19)), rng.normal(size=(50, 19))
    exact = ((a[:, None] - b[None]) ** 2).sum(2)
    last = np.zeros_like(exact)
    for segments in (1, 4, 19):
        w, am, s = topk.segment_statistics(a, segments)
        _, bm, t = topk.segment_statistics(b, segments)
        low = (((am[:, None] - bm[None]) ** 2 + (s[:, None] - t[None]) ** 2) * w).sum(2)
        assert (low <= exact + 1e-9).all()
        last = low
    assert np.allclose(last, exact)
