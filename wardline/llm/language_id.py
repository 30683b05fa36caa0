"""Language identification with a linear-chain conditional random field over words.

Every word of a text gets a label; emissions are sums of weights of its affixes
and inner n-grams (two to four bytes, white space as the word's edge) and of the
word itself if it is in the learned lexicon; transitions between labels are
learned, too. Passages that occur under several labels in the sample tell nothing of
any: they are left out of learning and of a text's vote. Weights come from a sample of labelled documents of bounded size
(``per_label`` documents a label, about ``sample_words`` words of each, in stretches from
all over the text; both are parameters), some of them joined in pairs so that switching occurs. Texts are
labelled whole: forward-backward gives each word's probabilities, a text's
language is the label with the largest share of letters.

Defined cases: ``und`` with score 0 if the text is null or has no letter, or if
no labelled document could be learned from. Ties go to the first label in order.
Words without a letter have no emissions. Rows with a null lang or text are not
learned from; a null doc_id counts as the empty text in the fold. Repeated rows
are scored each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm import arrays
from wardline.llm.common import bounded_sample, map_frames

FOLDS, HELD_OUT = 5, 0
PER_LABEL = 300
SAMPLE_WORDS = 192
LEXICON = 4096
BUCKETS = 1 << 16
STEPS = 40
SEGMENT = 64
STRETCH = 64  # words of a stretch of a sampled text
RUN = 5  # words of a run by which shared passages are told


class Model(NamedTuple):
    labels: list[str]
    grams: np.ndarray  # (BUCKETS, labels)
    lexicon: np.ndarray  # sorted word hashes
    lexical: np.ndarray  # (len(lexicon) + 1, labels); the last row is for words outside
    moves: np.ndarray  # (labels, labels) log weights
    shared: np.ndarray  # sorted hashes of word runs that occur under several labels


class _Grams(NamedTuple):
    index: tuple[np.ndarray, ...]  # bucket of the n-gram that begins at each byte, one array an order
    valid: tuple[np.ndarray, ...]  # whether it lies in one word and its edges
    first: np.ndarray  # of each word: the place of its left edge
    last: np.ndarray  # of each word: its last byte


def _grams(w: arrays.Words) -> _Grams:
    space = arrays.SPACE[w.lower]
    a = np.concatenate([[32], np.where(space, 32, w.lower), [32, 32, 32]]).astype(np.uint32)
    s = a == 32
    n = len(a) - 3
    two = (a[:n] << 8) | a[1 : n + 1]
    three = (two << np.uint32(8)) | a[2 : n + 2]
    four = (three << np.uint32(8)) | a[3 : n + 3]
    spread = np.uint32(0x9E3779B1)
    index = tuple(((g * spread) ^ np.uint32(k * 0x85EBCA6B & 0xFFFFFFFF)) * spread >> np.uint32(16) for k, g in enumerate((two, three, four), 1))
    inner = ~s[1 : n + 1]
    valid = (np.ones(n, bool), inner, inner & ~s[2 : n + 2])
    return _Grams(index, valid, w.starts, w.ends)


def _emissions(model: Model, w: arrays.Words) -> np.ndarray:
    """(words, labels) of log weights."""
    g = _grams(w)
    sums = np.zeros((len(g.index[0]), len(model.labels)), np.float32)
    for index, valid in zip(g.index, g.valid, strict=True):
        sums += model.grams[index] * valid[:, None]
    # an n-gram belongs to the word in or before which it begins: from the left edge to the last byte
    out = _ranges(sums, g.first, g.last + 1)
    at = np.searchsorted(model.lexicon, w.hashes)
    known = (at < len(model.lexicon)) & (model.lexicon[np.minimum(at, len(model.lexicon) - 1)] == w.hashes) if len(model.lexicon) else np.zeros(len(at), bool)
    out += model.lexical[np.where(known, at, len(model.lexicon))]
    return out * has_letter(w)[:, None]


def _ranges(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums over x[a:b] for each range; ranges are in order and don't overlap."""
    if not len(a):
        return np.zeros((0, *x.shape[1:]), x.dtype)
    cuts = np.stack([a, b], 1).ravel()
    if cuts[-1] >= len(x):
        cuts = cuts[:-1]
    return np.add.reduceat(x, cuts, axis=0)[::2]


def letters(w: arrays.Words) -> np.ndarray:
    """Letters of each word: a-z after lower-casing, and characters beyond ASCII."""
    is_letter = ((w.lower >= 97) & (w.lower <= 122)) | (w.lower >= 0xC0)
    total = np.concatenate([[0], np.cumsum(is_letter)])
    return total[w.ends] - total[w.starts]


def has_letter(w: arrays.Words) -> np.ndarray:
    return letters(w) > 0


def marginals(emit: np.ndarray, moves: np.ndarray, first: np.ndarray, forward: np.ndarray | None = None) -> np.ndarray:
    """(words, labels) probabilities by forward-backward over whole texts; ``forward`` takes the forward messages.

    Chains are cut into segments; the products of a segment's transfer matrices
    carry the messages over it, so that long texts are exact and still few steps.
    """
    n, k = emit.shape
    psi = np.exp(emit - emit.max(1, keepdims=True)).astype(np.float64) if n else emit.astype(np.float64)
    step = np.exp(moves - moves.max())
    counts = np.diff(first)
    per = -(-counts // SEGMENT)  # segments of each text
    of_text = np.repeat(np.arange(len(counts)), per)
    nth = np.arange(len(of_text)) - np.repeat(np.cumsum(per) - per, per)
    begin = first[:-1][of_text] + nth * SEGMENT
    size = np.minimum(SEGMENT, first[1:][of_text] - begin)
    order = np.argsort(-size, kind="stable")
    begin_o, size_o = begin[order], size[order]
    active = [int(np.searchsorted(-size_o, -t, side="left")) for t in range(SEGMENT + 1)]  # segments with more than t words

    over = np.repeat(np.eye(k)[None], len(order), 0)
    for t in range(SEGMENT):
        m = active[t]
        if not m:
            break
        x = (over[:m] @ step) * psi[begin_o[:m] + t][:, None, :]
        over[:m] = x / x.sum((1, 2), keepdims=True)
    transfer = np.empty_like(over)
    transfer[order] = over

    ahead, back = np.full((len(order), k), 1 / k), np.ones((len(order), k))
    start = np.cumsum(per) - per
    for t in range(1, int(per.max(initial=0))):
        at = start[per > t] + t
        x = np.einsum("nk,nkl->nl", ahead[at - 1], transfer[at - 1])
        ahead[at] = x / x.sum(1, keepdims=True)
        at = (start + per - 1 - t)[per > t]
        x = np.einsum("nkl,nl->nk", transfer[at + 1], back[at + 1])
        back[at] = x / x.sum(1, keepdims=True)

    out = np.empty((n, k))
    now = ahead[order]
    for t in range(SEGMENT):
        m = active[t]
        if not m:
            break
        x = (now[:m] @ step) * psi[begin_o[:m] + t]
        now[:m] = x = x / x.sum(1, keepdims=True)
        out[begin_o[:m] + t] = x
    if forward is not None:
        forward[:] = out
    now = back[order]
    for t in range(SEGMENT - 1, -1, -1):
        m = active[t]
        if not m:
            continue
        rows = begin_o[:m] + t
        x = out[rows] * now[:m]
        out[rows] = x / x.sum(1, keepdims=True)
        y = (psi[rows] * now[:m]) @ step.T
        now[:m] = y / y.sum(1, keepdims=True)
    return out


def gradient(emit: np.ndarray, moves: np.ndarray, first: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the chains' log likelihood, by emissions and by moves. The word before a chain is any label, each alike.

    The probability of a pair of neighbours is the forward message of the one, the move, and of the other
    its probability over what the move foretold for it, so it needs no second pass.
    """
    n, k = emit.shape
    ahead = np.empty((n, k))
    p = marginals(emit, moves, first, ahead)
    step = np.exp(moves - moves.max())
    starts = first[:-1][np.diff(first) > 0]
    before = np.empty((n, k))
    before[1:] = ahead[:-1]
    before[starts] = 1 / k
    expected = step * (before.T @ (p / np.maximum(before @ step, 1e-300)))
    inner = np.setdiff1d(np.arange(n), starts)
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[inner - 1], gold[inner]), 1)
    seen += step / step.sum(0) * np.bincount(gold[starts], minlength=k)
    return np.eye(k)[gold] - p, seen - expected


def _shared_runs(w: arrays.Words, of_text: np.ndarray, gold: np.ndarray, k: int) -> np.ndarray:
    """Runs of words that occur under several labels: these tell nothing of any."""
    hashes = arrays.run_hashes(w.hashes, RUN)
    inside = np.flatnonzero(of_text[: len(hashes)] == of_text[RUN - 1 :]) if len(hashes) else np.empty(0, np.int64)
    unique, which = np.unique(hashes[inside], return_inverse=True)
    seen = np.zeros((len(unique), k), bool)
    seen[which, gold[inside]] = True
    return unique[seen.sum(1) > 1]


def _covered(w: arrays.Words, shared: np.ndarray) -> np.ndarray:
    """Words that lie in a shared run."""
    out = np.zeros(len(w.hashes) + RUN, bool)
    hashes = arrays.run_hashes(w.hashes, RUN)
    if len(shared) and len(hashes):
        at = np.minimum(np.searchsorted(shared, hashes), len(shared) - 1)
        begin = np.flatnonzero(shared[at] == hashes)
        for i in range(RUN):
            out[begin + i] = True
    return out[: len(w.hashes)]


def fit(texts: list[str], labels: list[str], steps: int = STEPS, seed: int = 7) -> Model:
    """Learn from whole (sampled) texts by gradient ascent on the chains' log likelihood."""
    names = sorted(set(labels))
    k, rng = len(names), np.random.default_rng(seed)
    if not names:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.empty(0, np.uint64), np.zeros((1, 0), np.float32), np.zeros((0, 0)), np.empty(0, np.uint64))
    w = arrays.words([t.encode("utf-8", "surrogatepass") for t in texts])
    of_text = np.repeat(np.arange(len(texts)), np.diff(w.first))
    gold = np.array([names.index(x) for x in labels])[of_text]
    shared = _shared_runs(w, of_text, gold, k)
    keep = ~_covered(w, shared)
    counts = np.bincount(of_text[keep], minlength=len(texts))
    # two texts in three are followed by another one in their chain: these switch
    order = rng.permutation(len(texts))
    rows = np.concatenate([np.arange(w.first[t], w.first[t + 1]) for t in order] or [np.empty(0, int)]).astype(np.int64)
    rows = rows[keep[rows]]
    ends = np.cumsum(counts[order])
    first = np.concatenate([[0], ends[(np.arange(len(ends)) % 3 != 0)], ends[-1:]])
    first = np.unique(first)
    unique, where = np.unique(w.hashes, return_inverse=True)
    some = np.zeros(len(unique), np.int64)
    some[where] = np.arange(len(where))  # a place of each distinct word
    g = _grams(w)
    # the n-grams of each distinct word
    span = [np.arange(g.first[i], g.last[i] + 1) for i in some]
    word = np.repeat(np.arange(len(unique)), [len(s) for s in span])
    place = np.concatenate(span) if span else np.empty(0, np.int64)
    gram = np.concatenate([i[place][v[place]] for i, v in zip(g.index, g.valid, strict=True)]).astype(np.int64)
    of = np.concatenate([word[v[place]] for v in g.valid])
    common = np.argsort(-np.bincount(where, minlength=len(unique)), kind="stable")[:LEXICON]
    lexicon = np.sort(unique[common])
    slot = np.searchsorted(lexicon, unique)
    slot = np.where((slot < len(lexicon)) & (lexicon[np.minimum(slot, len(lexicon) - 1)] == unique), slot, len(lexicon))
    lettered = has_letter(w)[rows][:, None]
    where, gold = where[rows], gold[rows]
    params = [np.zeros((BUCKETS, k)), np.zeros((len(lexicon) + 1, k)), np.zeros((k, k))]
    square = [np.full_like(p, 1e-3) for p in params]
    for _ in range(steps):
        score = np.stack([np.bincount(of, params[0][gram, c], len(unique)) for c in range(k)], 1) + params[1][slot]
        emit = score[where] * lettered
        by_emission, by_move = gradient(emit, params[2], first, gold)
        diff = by_emission * lettered / len(rows)
        by_word = np.stack([np.bincount(where, diff[:, c], len(unique)) for c in range(k)], 1)
        grad = [np.stack([np.bincount(gram, by_word[of, c], BUCKETS) for c in range(k)], 1),
                np.stack([np.bincount(slot, by_word[:, c], len(lexicon) + 1) for c in range(k)], 1)]
        grad.append(by_move / len(rows))
        for x, s, d in zip(params, square, grad, strict=True):
            d = d * len(rows) / 1000 - 1e-4 * x
            s += d * d
            x += 0.5 * d / np.sqrt(s)
    return Model(names, params[0].astype(np.float32), lexicon, params[1].astype(np.float32), params[2], shared)


def spread_words(text: Column, most: int) -> Column:
    """A text's words; of a longer one about ``most``, in stretches from its first to its last word."""
    w = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")
    n = max(most // STRETCH, 2)
    at = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.slice(w, (F.floor(i * (F.size(w) - STRETCH) / (n - 1)) + 1).cast("int"), STRETCH))
    return F.array_join(F.when(F.size(w) <= n * STRETCH, w).otherwise(F.flatten(at)), " ")


def sample(docs: DataFrame, learn: Column, per_label: int = PER_LABEL, sample_words: int = SAMPLE_WORDS) -> DataFrame:
    """At most per_label labelled documents of each label, by a hash of the id and the text; of each text about sample_words words from all over it."""
    cut = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    drawn = bounded_sample(cut, "lang", per_label, "doc_id", "text")
    return drawn.withColumn("text", spread_words(F.col("text"), sample_words))


def learn_model(docs: DataFrame, learn: Column, per_label: int = PER_LABEL, sample_words: int = SAMPLE_WORDS) -> Model:
    rows = sample(docs.select("doc_id", "text", "lang"), learn, per_label, sample_words).orderBy("lang", "doc_id", "text").toPandas()
    return fit(rows["text"].tolist(), rows["lang"].tolist())


def label_texts(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Label (-1: und), score, best label of each word, first word of each text."""
    w = arrays.words(texts)
    k = len(model.labels)
    p = marginals(_emissions(model, w), model.moves, w.first)
    text = np.repeat(np.arange(len(texts)), np.diff(w.first))
    # letters outside of shared passages count, or all where there are no others
    weight = letters(w)
    own = weight * ~_covered(w, model.shared)
    weight = np.where(np.bincount(text, own, len(texts))[text] > 0, own, weight)
    share = np.zeros((len(texts), k))
    for c in range(k):
        share[:, c] = np.bincount(text, p[:, c] * weight, len(texts))
    total = share.sum(1)
    best = share.argmax(1)
    score = np.where(total > 0, share[np.arange(len(texts)), best] / np.maximum(total, 1e-300), 0)
    return np.where(total > 0, best, -1), np.clip(score, 0, 1), p.argmax(1) if k else np.zeros(len(p), int), w.first


RESULT = "doc_id long, lang_pred string, score double, runs array<struct<lang:string,first_word:int,n_words:int>>"


def detect(docs: DataFrame, model: Model, runs: bool = True) -> DataFrame:
    """(doc_id, lang_pred, score, runs) of every whole text; runs are its stretches of one language."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: BUCKETS and LEXICON

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = held.value
        names = [*m.labels, "und"]
        for frame in frames:
            for a, b, texts in arrays.encoded(frame["text"]):
                if m.labels:
                    label, score, word, first = label_texts(m, texts)
                    for i in np.flatnonzero(label >= 0):  # symbols beyond ASCII aren't letters
                        t = texts[i]
                        if not any(65 <= c <= 90 or 97 <= c <= 122 for c in set(t)) and not any(ch.isalpha() for ch in frame["text"].iloc[a + i]):
                            label[i], score[i] = -1, 0.0
                else:
                    label, score = np.full(b - a, -1), np.zeros(b - a)
                stretches: list = [[] for _ in range(b - a)]
                if runs and m.labels:
                    for i in np.flatnonzero(label >= 0):
                        x = word[first[i] : first[i + 1]]
                        cut = np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]])
                        stretches[i] = [(names[x[s]], int(s), int(e - s)) for s, e in zip(cut[:-1], cut[1:], strict=True)]
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[a:b].astype("Int64").array, "lang_pred": [names[x] for x in label],
                                    "score": score, "runs": stretches})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_frames, work, RESULT)
