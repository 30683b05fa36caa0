import math

import numpy as np
from pyspark.sql import functions as F

from wardline.llm import bitslice as B


def brute(rows, k=10):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in ok:
        if q % 100 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ok if i != q and len(b) == len(a))[:k]
            out |= {(q, r, i, max(min(-s, 2**63 - 1), -2**63)) for r, (s, i) in enumerate(best, 1)}
    return out


def test_equal_to_brute_force_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 12).astype("f4").tolist()) for i in range(700)]
    rows += [(1000 + i, rows[5][1]) for i in range(30)]  # ties
    rows += [(5100 + i, [float(np.float32(x)) for x in (3.0e6 * (i - 4), 1e7, *rng.normal(0, 1, 10))]) for i in range(9)]  # beyond 32 bits
    rows += [(5200, [float(np.float32(3e38))] + [0.0] * 11), (5300, [0.0] * 11 + [float(np.float32(-1e20))]), (5301, [0.0] * 12)]
    rows += [(100 * 50, None), (5001, [float("nan")] * 12), (5002, [None] + [0.1] * 11), (5003, [float("inf")] * 12), (None, [0.1] * 12),
             (5004, [float(np.float32(1e30))] * 12), (200_000, [0.5, -0.25]), (5005, [0.5, 1.0]), (5006, [-3.0, 1.0]), (300_000, [])]
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, label int, v string, block long")
    got = B.top_k(df, F.col("vec_id") % 100 == 0, block=256)
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == brute(rows)


def test_fewer_rows_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<float>")
    got = B.top_k(df, F.col("vec_id") % 100 == 0).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1, 2 * 1024**2), (2, 2, -(1024**2))]
    assert B.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_slices_add_up():
    rng = np.random.default_rng(0)
    v = rng.integers(-900, 900, (150, 9))
    q = rng.integers(-700, 700, 9)
    score, offset = B.add(B.build(np.arange(150), v), q)
    total = [offset + sum(int(s[r >> 6] >> np.uint64(r & 63) & np.uint64(1)) << p for p, s in enumerate(score)) for r in range(150)]
    assert total == (v @ q).tolist()
