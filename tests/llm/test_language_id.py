import zlib

import numpy as np
from pyspark.sql import functions as F
from odd import ODD

from wardline.llm import language_id as L
from wardline.llm.common import fold, table


def test_marginals_equal_plain_forward_backward():
    rng = np.random.default_rng(2)
    emit, moves = rng.normal(size=(400, 3)), rng.normal(size=(3, 3))
    first = np.array([0, 0, 1, 64, 129, 400])
    got = L.marginals(emit, moves, first)
    a = np.exp(moves)
    for s, e in zip(first[:-1], first[1:], strict=True):
        ahead, v = [], np.full(3, 1 / 3)
        for t in range(s, e):
            v = (v @ a) * np.exp(emit[t])
            v /= v.sum()
            ahead.append(v)
        back = np.ones(3)
        for t in range(e - 1, s - 1, -1):
            want = ahead[t - s] * back
            assert np.allclose(got[t], want / want.sum())
            back = a @ (np.exp(emit[t]) * back)
            back /= back.sum()


def test_gradient_equals_a_numeric_one():
    """Of the log likelihood of the labels, by every emission and every move; chains of one word and over segments among them."""
    rng = np.random.default_rng(8)
    k, first = 3, np.array([0, 1, 5, 80])
    emit, moves, gold = rng.normal(size=(80, k)), rng.normal(size=(k, k)), rng.integers(0, k, 80)

    def likelihood(emit, moves):
        total = 0.0
        for s, e in zip(first[:-1], first[1:], strict=True):
            every, path = np.full(k, 1 / k), np.full(k, 1 / k)
            for t in range(s, e):
                every = (every @ np.exp(moves)) * np.exp(emit[t])
                path = (path @ np.exp(moves)) * np.exp(emit[t]) * (np.arange(k) == gold[t])
            total += np.log(path.sum()) - np.log(every.sum())
        return total

    by_emit, by_move = L.gradient(emit, moves, first, gold)
    for x, got in ((emit, by_emit), (moves, by_move)):
        for at in np.ndindex(x.shape):
            old = x[at]
            x[at] = old + 1e-5
            up = likelihood(emit, moves)
            x[at] = old - 1e-5
            down = likelihood(emit, moves)
            x[at] = old
            assert abs(got[at] - (up - down) / 2e-5) < 1e-6


def test_sampled_words_come_from_all_over_a_text(spark):
    rows = spark.createDataFrame([(" ".join(f"w{i}" for i in range(n)),) for n in (0, 5, 192, 193, 5000)], "text string")
    got = [r[0].split() for r in rows.select(L.spread_words(F.col("text"), 192)).collect()]
    assert [len(g) for g in got] == [0, 5, 192, 192, 192]
    assert got[2] == [f"w{i}" for i in range(192)] and got[4][0] == "w0" and got[4][-1] == "w4999" and "w2500" in got[4]


def test_held_out_accuracy_and_code_switching(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    held = fold(F.col("doc_id"), 5) == 0
    model = L.learn_model(docs, ~held)
    got = L.detect(docs, model, runs=False).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    out = got[got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)]
    assert (out.lang_pred == out.lang).mean() > 0.98 and got.score.between(0, 1).all()
    by = {r.lang: r.text for r in docs.where("length(text) > 600").orderBy("doc_id").collect()}
    mixed = spark.createDataFrame([(1, " ".join(by["fr"].split()[:60] + by["de"].split()[:60]))], "doc_id long, text string")
    runs = L.detect(mixed, model).first().runs
    cover = {lang: sum(r.n_words for r in runs if r.lang == lang and (r.first_word < 60) == (lang == "fr")) for lang in ("fr", "de")}
    assert cover["fr"] > 50 and cover["de"] > 50 and sum(r.n_words for r in runs) == 120


def test_odd_rows(spark, documents):
    docs = documents(ODD)
    model = L.learn_model(documents([(1, "the words of it"), (2, "le mot de la"), (3, None), (4, "x")], ["en", "fr", "en", None]), F.lit(True))
    assert model.labels == ["en", "fr"]
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.detect(docs, model).collect()]
    assert len(got) == len(ODD)
    by = {d: p for d, p, _ in got}
    assert all(by[d] == "und" for d in (2, 3, 4, 8)) and by[7] != "und" and by[6] != "und"
    none = L.learn_model(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in L.detect(docs, none).collect()} == {"und"}
    assert L.detect(docs.limit(0), model).count() == 0


def test_sample_is_bounded(spark, documents):
    docs = documents([(i, f"word{i} " * 500) for i in range(50)])
    rows = L.sample(docs, F.lit(True), per_label=7).collect()
    assert len(rows) == 7 and all(len(r.text.split()) <= L.SAMPLE_WORDS for r in rows)
