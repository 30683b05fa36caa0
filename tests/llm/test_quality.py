import zlib

import numpy as np
from pyspark.sql import functions as F
from odd import ODD

from wardline.llm import arrays
from wardline.llm import quality as Q
from wardline.llm.common import fold, table


def test_held_out_accuracy(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    held = fold(F.col("doc_id"), 3) == 1
    model = Q.learn_model(docs, labels, ~held)
    got = Q.score(docs, model).join(labels, "doc_id").toPandas()
    out = got[got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 3 == 1)]
    assert ((out.score >= 0.5) == out.quality).mean() > 0.95 and got.score.between(0, 1).all()


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(3)
    per = np.array([1, 4, 2, 3])
    x, first, y, weight = rng.normal(0, 1, (per.sum(), 5)), np.cumsum(per) - per, np.array([1.0, 0, 1, 0]), rng.uniform(0.1, 1, 4)
    params = Q._start(5, rng)
    for i, grad in enumerate(Q._gradient(params, x, first, y, weight)):
        for at in np.ndindex(params[i].shape):
            up, down = [p.copy() for p in params], [p.copy() for p in params]
            up[i][at] += 1e-5
            down[i][at] -= 1e-5
            slope = (Q._loss(up, x, first, y, weight) - Q._loss(down, x, first, y, weight)) / 2e-5
            assert abs(slope - grad[at]) < 1e-6


def test_attention_of_bags():
    """Attention weights of a bag sum to one, and longer bags don't change a lone passage's score."""
    model = Q.fit([b"good words in here", b"### ### $$$"] * 20, np.array([1, 0] * 20), steps=20)
    p, a, per = Q.predict(model, [b"good words", b"", b"w " * 1000])
    assert per.tolist() == [1, 1, -(-1000 // Q.PASSAGE)] and abs(a[2:].sum() - 1) < 1e-9 and ((p >= 0) & (p <= 1)).all()
    alone = Q.predict(model, [b"good words"])[0]
    assert np.allclose(alone, p[0])


def test_sample_is_bounded_when_an_id_repeats(spark, documents):
    docs = documents([(1, f"text {i}") for i in range(50)] + [(1, "same")] * 30 + [(2, "a"), (3, "b")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    rows = Q.sample(docs, labels, F.lit(True), per_label=4).select("doc_id", "text", "quality").distinct().collect()
    assert sorted(r.quality for r in rows) == [0, 1, 1, 1, 1]
    assert Q.learn_model(docs, labels, F.lit(True), per_label=4) is not None


def test_odd_rows(spark, documents):
    docs = documents(ODD)
    assert Q.score(docs, None).select("score").distinct().collect()[0].score == 0.5
    model = Q.fit(arrays.encode(t for _, t in ODD), np.arange(len(ODD)) % 2, steps=5)
    assert Q.score(docs, model).count() == len(ODD)
    assert Q.score(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert Q.learn_model(docs, labels, F.lit(True)) is None
