"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE words. Each passage is encoded from its
shape (word and letter statistics, word hashes) by a small layer; gated
attention weights, learned from the labels of whole documents alone, say how
much each passage counts; the weighted sum of the passages' encodings is scored.
Learning uses a sample of labelled rows of bounded size (``per_label``, a
parameter): at most ``per_label`` rows a label, of which the driver gets passages'
features, never texts: all of them, or PASSAGES_EACH from all over a longer text
(``passages_each``, a parameter). Scoring reads every whole text.

Defined cases: an empty or null text is one passage without words and gets the
score that this has; without any labelled document every score is 0.5. Labels
that are null are not learned from; a document labelled twice counts twice; of rows that
repeat a doc_id and its text one is learned from. A
null doc_id is never held out and has no label. Repeated rows are scored each;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm import arrays
from wardline.llm.common import bounded_sample, broadcast_if_small, map_frames, materialise

FOLDS, HELD_OUT = 3, 1
PER_LABEL = 1000
PASSAGE = 64
PASSAGES_EACH = 64
HASHED = 32
UNITS = 16
STEPS = 200

#: Byte classes of a passage's shape. Fixed values.
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".,;:?", "bang": b"!", "symbol": b"#$%&*|<>{}[]\\/@^~=+_", "line": b"\n"}


class Model(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray
    params: list[np.ndarray]


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(passages, features) and the number of passages of each text."""
    w = arrays.words(texts)
    size = np.diff(w.first)
    per = np.maximum(1, -(-size // PASSAGE))
    text = np.repeat(np.arange(len(size)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    begin = w.first[:-1][text] + nth * PASSAGE
    n = np.minimum(PASSAGE, w.first[1:][text] - begin)  # words of each passage
    full = n > 0
    passage = np.repeat(np.arange(len(n)), n)
    length = (w.ends - w.starts).astype(np.float64)

    def total(x: np.ndarray) -> np.ndarray:
        return np.bincount(passage, x, len(n))

    # bytes from a passage's first word to its last; in an empty one there are none
    a, b = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    if len(w.starts):
        a[full], b[full] = w.starts[begin[full]], w.ends[begin[full] + n[full] - 1]
    some, chars = np.maximum(n, 1), np.maximum(b - a, 1)
    columns = []
    for members in _CLASSES.values():
        table = np.zeros(256, bool)
        table[list(members)] = True
        sums = np.concatenate([[0], np.cumsum(table[w.data])])
        columns.append((sums[b] - sums[a]) / chars)
    sums = np.concatenate([[0], np.cumsum(w.data >= 0x80)])
    columns.append((sums[b] - sums[a]) / chars)
    key = (passage.astype(np.uint64) << np.uint64(40)) ^ (w.hashes >> np.uint64(24))
    distinct = np.bincount((np.unique(key) >> np.uint64(40)).astype(np.int64), minlength=len(n))[: len(n)]
    longest = np.zeros(len(n))
    np.maximum.at(longest, passage, length)
    columns += [np.log1p(n), total(length) / some, distinct / some, total(length <= 3) / some, np.log1p(longest),
                np.log1p(size[text]), np.log1p(per[text])]
    bucket = (w.hashes % np.uint64(HASHED)).astype(np.int64)
    hashed = np.bincount(passage * HASHED + bucket, minlength=len(n) * HASHED).reshape(-1, HASHED) / some[:, None]
    return np.concatenate([np.stack(columns, 1), hashed], 1), per


def _forward(params: list[np.ndarray], x: np.ndarray, first: np.ndarray):
    encode, shift, value, gate, attend, out, bias = params
    h = np.tanh(x @ encode + shift)
    v, g = np.tanh(h @ value), 1 / (1 + np.exp(-(h @ gate)))
    e = (v * g) @ attend
    bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
    e = np.exp(e - np.maximum.reduceat(e, first)[bag])
    a = e / np.add.reduceat(e, first)[bag]
    z = np.add.reduceat(h * a[:, None], first, axis=0)
    return h, v, g, a, bag, z, 1 / (1 + np.exp(-(z @ out + bias[0])))


def _loss(params: list[np.ndarray], x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """What fit() lessens: the weighted log loss, and a little for large weights."""
    p = np.clip(_forward(params, x, first)[-1], 1e-300, 1 - 1e-16)
    return float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() + 0.5e-4 * ((params[0] ** 2).sum() + (params[5] ** 2).sum()))


def _gradient(params: list[np.ndarray], x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    encode, shift, value, gate, attend, out, bias = params
    h, v, g, a, bag, z, p = _forward(params, x, first)
    dlogit = (p - y) * weight
    dz = dlogit[:, None] * out
    da = (h * dz[bag]).sum(1)
    de = a * (da - np.add.reduceat(a * da, first)[bag])
    dvg = de[:, None] * attend
    dv, dg = dvg * g * (1 - v * v), dvg * v * g * (1 - g)
    dh = (dz[bag] * a[:, None] + dv @ value.T + dg @ gate.T) * (1 - h * h)
    return [x.T @ dh + 1e-4 * encode, dh.sum(0), h.T @ dv, h.T @ dg, (v * g).T @ de, z.T @ dlogit + 1e-4 * out, dlogit.sum(keepdims=True)]


def _start(d: int, rng: np.random.Generator) -> list[np.ndarray]:
    return [rng.normal(0, d**-0.5, (d, UNITS)), np.zeros(UNITS), *(rng.normal(0, UNITS**-0.5, (UNITS, UNITS)) for _ in range(2)),
            rng.normal(0, UNITS**-0.5, UNITS), rng.normal(0, UNITS**-0.5, UNITS), np.zeros(1)]


def fit(texts: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = 11) -> Model | None:
    """The model of labelled texts."""
    if not len(texts):
        return None
    parts = [features(texts[a:b]) for a, b in arrays.blocks(texts)]
    return fit_bags(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), labels, steps, seed)


def fit_bags(x: np.ndarray, per: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 11) -> Model:
    """Whole-batch Adam on the log loss of the labels of bags of ``per`` passages, classes weighted alike."""
    mean, spread = x.mean(0), x.std(0) + 1e-6
    x = np.clip((x - mean) / spread, -6, 6)
    first = np.cumsum(per) - per
    y = labels.astype(np.float64)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)
    params = _start(x.shape[1], np.random.default_rng(seed))
    moment, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        for i, grad in enumerate(_gradient(params, x, first, y, weight)):
            moment[i] = 0.9 * moment[i] + 0.1 * grad
            square[i] = 0.999 * square[i] + 0.001 * grad * grad
            params[i] = params[i] - 0.02 * (moment[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, spread, params)


def predict(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score of each text, attention of each passage, passages of each text."""
    x, per = features(texts)
    first = np.cumsum(per) - per
    _, _, _, a, _, _, p = _forward(model.params, np.clip((x - model.mean) / model.spread, -6, 6), first)
    return p, a, per


def sample(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int = PER_LABEL) -> DataFrame:
    """(doc_id, text, quality) of at most per_label rows of each label: ids are drawn first, then rows, told apart by their text's hash."""
    drawn = bounded_sample(labels.select("doc_id", "quality").where(learn & F.col("quality").isin(0, 1)), "quality", per_label, "doc_id")
    drawn = materialise(drawn, "quality-sample")
    near = docs.select("doc_id", "text").join(broadcast_if_small(drawn, 2 * per_label, 24), "doc_id")
    hashed = near.withColumn("_text", F.xxhash64("text"))
    rows = hashed.groupBy("doc_id", "_text", "quality").agg(F.count(F.lit(1)).alias("_rows"))  # rows that repeat are one
    rows = materialise(bounded_sample(rows, "quality", per_label, "doc_id", "_text"), "quality-rows").select("doc_id", "_text", "quality")
    return hashed.join(broadcast_if_small(rows, 2 * per_label, 32), ["doc_id", "_text", "quality"])


def _bags(passages_each: int):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for a, b, texts in arrays.encoded(f["text"]):
                x, per = features(texts)
                first = np.cumsum(per) - per
                # of a long text, passages from all over it
                kept = [x[i + (np.arange(passages_each) * n // passages_each if n > passages_each else np.arange(n))] for i, n in zip(first, per, strict=True)]
                part = f.iloc[a:b]
                yield pd.DataFrame({"doc_id": part["doc_id"].array, "_text": part["_text"].array, "quality": part["quality"].array,
                                    "bag": [k.astype(np.float64).tobytes() for k in kept]})

    return work


def learn_model(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int = PER_LABEL, passages_each: int = PASSAGES_EACH) -> Model | None:
    rows = sample(docs, labels, learn, per_label).select(F.col("doc_id").cast("long").alias("doc_id"), "_text", F.col("quality").cast("int").alias("quality"), "text")
    bags = rows.transform(map_frames, _bags(passages_each), "doc_id long, _text long, quality int, bag binary")
    # repeated rows give one bag; at most 2 * per_label bags of at most passages_each passages come to the driver
    bags = bags.groupBy("doc_id", "_text", "quality").agg(F.first("bag").alias("bag")).toPandas().sort_values(["doc_id", "_text", "quality"])
    if not len(bags):
        return None
    wide = features([b""])[0].shape[1]
    held = [np.frombuffer(x, np.float64).reshape(-1, wide) for x in bags["bag"]]
    return fit_bags(np.concatenate(held), np.array([len(x) for x in held]), bags["quality"].to_numpy())


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, n_passages, top_passage): top_passage (from 0) has the largest attention."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for a, b, texts in arrays.encoded(f["text"]):
                if held.value is None:
                    p, per, best = np.full(b - a, 0.5), np.ones(b - a, int), np.zeros(b - a, int)
                else:
                    p, weight, per = predict(held.value, texts)
                    best = [int(x.argmax()) for x in np.split(weight, np.cumsum(per)[:-1])]
                yield pd.DataFrame({"doc_id": f["doc_id"].iloc[a:b].astype("Int64").array, "score": np.clip(p, 0, 1), "n_passages": per, "top_passage": best})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_frames, 
        work, "doc_id long, score double, n_passages int, top_passage int")
