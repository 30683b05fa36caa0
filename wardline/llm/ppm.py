"""Language-model scores by prediction by partial matching over bytes.

The trie holds, for every byte context of up to ORDER bytes, the counts of the
bytes that follow; all training texts are counted, tasks first. The whole trie is
a table, of any size. A byte is coded in the longest known context; escapes go to
shorter ones, with the symbols seen in the longer one excluded (a discount of each
node's count goes to the escape). Since counts are fixed after training, the code
length of a byte depends on its context alone, so that of every (context, byte) that
any text has is worked out once, level by level in joins on the shorter context. The
commonest ones' are sent to the tasks (``cached`` at most, which changes no result);
the others are counted in each text and meet their lengths in a join. ``build`` and
``learn`` make tries in memory, ``learn`` of the commonest nodes only; ``score`` needs
neither.

A text ends with an end symbol. ``base_score`` is an add-half unigram model of
words. The commonest words' counts are sent to the tasks (``common`` at most);
the other words meet their counts in a join.

Defined cases: a null or empty text is its end alone; with nothing to learn from
symbols are equally likely; a null doc_id is never held out; repeated rows count
and are scored each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm import arrays
from wardline.llm.common import map_frames, materialise

FOLDS, HELD_OUT = 5, 1
ORDER = 5
NODES = 1 << 19
COMMON = 1 << 18
CACHED = 1 << 20
BEGIN, END = 0xFE, 0xFF  # bytes that no text has
SYMBOLS = 255  # all bytes but BEGIN
SLOTS = 1 << 20
DISCOUNT = 0.5  # of each node's count, for escapes
END_WORD = np.uint64(1)  # stands for the end among word hashes


def _codes(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """uint64 (context, byte) codes of each text's bytes and its end; where each text begins."""
    pad = bytes([BEGIN]) * order
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t, b"\xff")), np.uint8)
    n = len(data) - order
    code = data[:n].astype(np.uint64)
    for i in range(1, order + 1):
        code = (code << np.uint64(8)) | data[i : n + i]
    real = data[order:] != BEGIN  # a text's padding is no symbol
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return code[real], np.cumsum(sizes) - sizes


class _Counter:
    """Counts of keys in texts learned from and in all texts, merged now and then; handed over when there are many."""

    most = 1 << 21

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, learned: bool) -> None:
        keys, n = np.unique(keys, return_counts=True)
        self.parts.append((keys, n * learned, n))
        self.held += len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            keys, where = np.unique(np.concatenate([p[0] for p in self.parts]), return_inverse=True)
            n, m = (np.bincount(where, np.concatenate([p[i] for p in self.parts]), len(keys)).astype(np.int64) for i in (1, 2))
            self.parts = [(keys, n, m)]
        self.held = sum(len(p[0]) for p in self.parts)
        return self.parts[0] if self.parts else (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))


def _count(order: int):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds = (_Counter(), _Counter())

        def out(kind: int) -> pd.DataFrame:
            keys, n, m = kinds[kind].merged()
            kinds[kind].parts, kinds[kind].held = [], 0
            return pd.DataFrame({"kind": kind, "key": keys.view(np.int64), "n": n, "m": m})

        for f in frames:
            for learned in (True, False):
                for a, b, texts in arrays.encoded(f["text"][f["learns"] == learned].array):
                    kinds[0].add(_codes(texts, order)[0], learned)
                    if learned:
                        kinds[1].add(np.concatenate([arrays.words(texts).hashes, np.full(b - a, END_WORD)]), learned)
                    for k in (0, 1):
                        if kinds[k].held > _Counter.most:
                            kinds[k].merged()
                        if kinds[k].held > _Counter.most:
                            yield out(k)
        for k in (0, 1):
            yield out(k)

    return work


def counts(docs: DataFrame, order: int = ORDER, learns: Column | None = None) -> DataFrame:
    """(kind, key, n, m): counts of byte codes (kind 0) and of word hashes (kind 1) over whole texts.

    ``n`` counts the texts to learn from; ``m`` all, whose byte codes are listed even where n is 0.
    """
    learns = F.lit(True) if learns is None else F.coalesce(learns, F.lit(False))
    return (docs.select("text", learns.alias("learns")).transform(map_frames, _count(order), "kind int, key long, n long, m long")
            .groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")))


class Level(NamedTuple):
    nodes: np.ndarray  # sorted (context, byte) codes
    n: np.ndarray
    contexts: np.ndarray  # sorted
    total: np.ndarray  # of each context: counts, and distinct bytes
    distinct: np.ndarray
    pruned: np.ndarray  # counts of bytes whose nodes were pruned
    total_next: np.ndarray  # the same of the next shorter context, without this context's bytes
    distinct_next: np.ndarray


class Trie(NamedTuple):
    order: int
    levels: list[Level]  # by length of context
    slot_keys: np.ndarray  # the longest contexts' nodes by hash, the commoner one wins a slot
    slot_score: np.ndarray


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def _slot(code: np.ndarray) -> np.ndarray:
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 20)).astype(np.int64)


def build(order: int, by_level: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
    """The trie from each level's (codes, counts)."""
    levels: list[Level] = []
    for k, (codes, n) in enumerate(by_level):
        sort = np.argsort(codes)
        codes, n = codes[sort], n[sort].astype(np.float64)
        contexts, of = np.unique(codes >> np.uint64(8), return_inverse=True)
        total, distinct = np.bincount(of, n, len(contexts)), np.bincount(of, minlength=len(contexts)).astype(np.float64)
        total_next, distinct_next, pruned = (np.zeros(len(contexts)) for _ in range(3))
        if k:
            below = levels[k - 1]
            same, held = _find(below.nodes, contexts)  # a context is a node of the level below
            pruned = np.where(held, np.maximum((below.n[same] if len(below.n) else 0) - total, 0), 0)
            at, _ = _find(below.nodes, codes & np.uint64((1 << 8 * k) - 1))
            up, _ = _find(below.contexts, contexts & np.uint64((1 << 8 * (k - 1)) - 1))
            if len(contexts):
                total_next = below.total[up] - np.bincount(of, below.n[at], len(contexts))
                distinct_next = below.distinct[up] - distinct
        levels.append(Level(codes, n, contexts, total, distinct, pruned, total_next, distinct_next))
    trie = Trie(order, levels, np.full(SLOTS, np.uint64(0xFFFFFFFFFFFFFFFF)), np.zeros(SLOTS))
    last = levels[-1]
    if len(last.nodes):
        rare_first = np.argsort(last.n, kind="stable")
        slot = _slot(last.nodes[rare_first])
        trie.slot_keys[slot] = last.nodes[rare_first]
        trie.slot_score[slot] = scores(trie, last.nodes[rare_first])
    return trie


def scores(trie: Trie, codes: np.ndarray) -> np.ndarray:
    """log10 probability of each code's byte in its context."""
    out, left = np.zeros(len(codes)), np.arange(len(codes))
    child = np.full(len(codes), -1)  # the longer known context, by its place on its level
    for k in range(trie.order, -1, -1):
        level = trie.levels[k]
        code = codes[left] & np.uint64((1 << 8 * (k + 1)) - 1)
        context, known = _find(level.contexts, code >> np.uint64(8))
        node, found = _find(level.nodes, code)
        up = child[left]
        if known.any():
            above = trie.levels[k + 1] if k < trie.order else None
            total, distinct = level.total[context], level.distinct[context]
            if above is not None and len(above.contexts):  # after an escape: without the longer context's bytes
                total, distinct = np.where(up >= 0, above.total_next[up], total), np.where(up >= 0, above.distinct_next[up], distinct)
            whole = total + level.pruned[context]
            with np.errstate(divide="ignore", invalid="ignore"):
                hit = np.log10((level.n[node] - DISCOUNT) / whole)
                escape = np.log10((DISCOUNT * distinct + level.pruned[context]) / whole)
            out[left] += np.where(found, hit, np.where(known & (whole > 0), escape, 0))
        child[left] = np.where(known, context, -1)
        left = left[~found]
    seen = len(trie.levels[0].nodes)
    out[left] -= np.log10(max(1, SYMBOLS - seen))
    return out


def text_scores(trie: Trie, texts: list[bytes]) -> np.ndarray:
    code, first = _codes(texts, trie.order)
    slot = _slot(code)
    hit = trie.slot_keys[slot] == code
    each = np.where(hit, trie.slot_score[slot], 0)
    rest = np.flatnonzero(~hit)
    if len(rest):
        unique, where = np.unique(code[rest], return_inverse=True)
        each[rest] = scores(trie, unique)[where]
    return np.add.reduceat(each, first)


def _grade(n: Column) -> Column:
    """Counts by size: themselves while small, then by fine steps of their logarithm."""
    return F.when(n < 4096, n).otherwise(4096 + F.floor(F.log2(n / 4096) * 256))


def least_grade(rows: DataFrame, most: int) -> int:
    """The least grade of ``n`` that at most ``most`` rows reach."""
    grades = rows.groupBy(_grade(F.col("n")).alias("g")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("g"))
    least, kept = 1 << 30, 0
    for g, c in grades.collect():  # some thousand grades at most
        if kept + c > most:
            break
        least, kept = int(g), kept + c
    return least


def learn(counted: DataFrame, order: int = ORDER, nodes: int = NODES) -> Trie:
    """The pruned trie; its nodes, a bounded number, are gathered on the driver."""
    longest = counted.where("kind = 0").select(F.col("key").alias("code"), "n")
    levels = longest.select(F.lit(order).alias("k"), "code", "n")
    for k in range(order - 1, -1, -1):
        mask = (1 << 8 * (k + 1)) - 1
        shorter = longest.groupBy(F.col("code").bitwiseAND(F.lit(mask)).alias("code")).agg(F.sum("n").alias("n"))
        levels = levels.unionAll(shorter.select(F.lit(k).alias("k"), "code", "n"))
    levels = materialise(levels, "trie-levels")
    # a shorter context's count is never the smaller one, so what is kept is a trie
    kept = levels.where(_grade(F.col("n")) >= least_grade(levels, nodes)).toArrow()
    k, code, n = (kept.column(c).to_numpy() for c in ("k", "code", "n"))
    del kept
    return build(order, [(code[k == i].astype(np.int64).view(np.uint64), n[k == i]) for i in range(order + 1)])


def _log_ratio(a: Column, b: Column) -> Column:
    """log10 of a / b; null, where one is 0."""
    return F.log10(a) - F.log10(b)


def code_lengths(codes: DataFrame, order: int = ORDER) -> DataFrame:
    """(code, m, length): log10 probability of every code's byte in its context, by the whole trie.

    ``codes`` has (code, n, m); a node is a code with n > 0. From the shortest contexts on,
    each level's codes meet those of the level below that they end with. ``w`` sums the
    escapes that follow the one from a context, down to the shortest; ``b`` is what is left
    of a code's length after them, where an escape from its context is certain.
    """
    levels = [codes]
    for k in range(order - 1, -1, -1):
        shorter = levels[0].groupBy(F.col("code").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("code"))
        levels.insert(0, materialise(shorter.agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "trie-level"))
    met = None
    for k, level in enumerate(levels):
        level = level.select("code", "n", "m", F.shiftrightunsigned("code", 8).alias("context"))
        context = Window.partitionBy("context")  # at most 255 bytes follow a context
        level = level.withColumn("total", F.sum("n").over(context)).withColumn("kinds", F.sum((F.col("n") > 0).cast("long")).over(context))
        node, known = F.col("n") > 0, F.col("total") > 0
        hit = _log_ratio(F.col("n") - DISCOUNT, F.col("total"))
        escape = _log_ratio(DISCOUNT * F.col("kinds"), F.col("total"))
        if met is None:
            never = -F.log10(F.greatest(F.lit(1), SYMBOLS - F.col("kinds")))
            met = level.select("code", "n", "m", "total", "kinds", F.lit(0.0).alias("w"), never.alias("b"),
                               F.when(node, hit).when(known, escape + never).otherwise(never).alias("length"))
            continue
        below = met.select(F.col("code").alias("ends"), *[F.col(c).alias(f"{c}_0") for c in ("n", "total", "kinds", "w", "b", "length")])
        level = level.withColumn("ends", F.col("code").bitwiseAND(F.lit((1 << 8 * k) - 1))).join(below, "ends")
        # what the shorter context has besides this one's bytes
        level = level.withColumn("more", F.col("total_0") - F.sum(F.when(node, F.col("n_0")).otherwise(0)).over(context))
        again = F.when(F.col("more") > 0, _log_ratio(DISCOUNT * (F.col("kinds_0") - F.col("kinds")), F.col("more"))).otherwise(0.0)
        level = level.withColumn("w", F.col("w_0") + again)
        last = _log_ratio(F.col("n_0") - DISCOUNT, F.col("more"))  # coded one level below
        down = F.col("n_0") > 0
        met = level.select("code", "n", "m", "total", "kinds", "w", F.when(down, last - F.col("w")).otherwise(F.col("b_0")).alias("b"),
                           F.when(node, hit).when(known & down, escape + last)
                           .when(known, escape + F.col("w") + F.col("b_0")).otherwise(F.col("length_0")).alias("length"))
    return met.select("code", "m", "length")


class Cache(NamedTuple):
    codes: np.ndarray  # sorted
    lengths: np.ndarray
    slot_codes: np.ndarray  # by hash, the commoner one wins a slot
    slot_lengths: np.ndarray


def cache_of(codes: np.ndarray, lengths: np.ndarray, m: np.ndarray) -> Cache:
    slot_codes, slot_lengths = np.full(SLOTS, np.uint64(0xFFFFFFFFFFFFFFFF)), np.zeros(SLOTS)
    rare_first = np.argsort(m, kind="stable")
    slot = _slot(codes[rare_first])
    slot_codes[slot], slot_lengths[slot] = codes[rare_first], lengths[rare_first]
    sort = np.argsort(codes)
    return Cache(codes[sort], lengths[sort], slot_codes, slot_lengths)


def cached_lengths(cache: Cache, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the codes, 0 where they are not in the cache; whether they are."""
    slot = _slot(codes)
    known = cache.slot_codes[slot] == codes
    each = np.where(known, cache.slot_lengths[slot], 0)
    rest = np.flatnonzero(~known)
    if len(rest) and len(cache.codes):
        unique, where = np.unique(codes[rest], return_inverse=True)
        at, found = _find(cache.codes, unique)
        each[rest], known[rest] = np.where(found, cache.lengths[at], 0)[where], found[where]
    return each, known


def _counted(codes: np.ndarray, of: np.ndarray, size: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Each text's distinct codes and how often it has them; ``of`` is the text of a code."""
    sort = np.lexsort((codes, of))
    codes, of = codes[sort], of[sort]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(codes)))
    bounds = np.searchsorted(of[at], np.arange(size + 1))
    codes = codes[at].view(np.int64)
    return tuple([x[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)] for x in (codes, times))


def score(docs: DataFrame, learns: Column, order: int = ORDER, cached: int = CACHED, common: int = COMMON) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every whole text."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = materialise(counts(docs, order, learns), "lm-counts")
    lengths = materialise(code_lengths(counted.where("kind = 0").select(F.col("key").alias("code"), "n", "m"), order), "code-lengths")
    least_m = least_grade(lengths.select(F.col("m").alias("n")), cached)
    sent = lengths.where(_grade(F.col("m")) >= least_m).toArrow()
    code, length, m = (sent.column(c).to_numpy() for c in ("code", "length", "m"))
    cache = cache_of(code.astype(np.int64).view(np.uint64), length.astype(np.float64), m.astype(np.int64))
    del sent
    words = counted.where("kind = 1").select("key", "n")
    tokens, distinct = (int(x or 0) for x in words.agg(F.sum("n"), F.count(F.lit(1))).first())
    least = least_grade(words, common)
    frequent = words.where(_grade(F.col("n")) >= least).toArrow()
    keys, times = frequent.column("key").to_numpy().astype(np.int64).view(np.uint64), frequent.column("n").to_numpy().astype(np.int64)
    sort = np.argsort(keys)
    ends = words.where(F.col("key") == int(END_WORD)).agg(F.sum("n")).first()[0] or 0
    held = spark.sparkContext.broadcast((cache, keys[sort], times[sort]))
    base = tokens + 0.5 * (distinct + 1)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, keys, n = held.value
        for f in frames:
            for a, b, texts in arrays.encoded(f["text"]):
                w = arrays.words(texts)
                at, known = _find(keys, w.hashes)
                each = np.where(known, np.log10((n[at] if len(n) else 0) + 0.5), 0)
                sums, known_to = (np.concatenate([[0], np.cumsum(x)]) for x in (each, known))
                size = np.diff(w.first)
                out = pd.DataFrame({"doc_id": f["doc_id"].iloc[a:b].astype("Int64").array, "n_tokens": size + 1})
                out["n_known"] = np.diff(known_to[w.first]) + int(ends > 0)
                out["found"] = np.diff(sums[w.first]) + np.log10(ends + 0.5) - (size + 1) * np.log10(base)
                code, first = _codes(texts, order)
                length, near = cached_lengths(cache, code)
                out["score"] = np.add.reduceat(length, first)
                away = np.flatnonzero(~near)
                out["codes"], out["times"] = _counted(code[away], np.searchsorted(first, away, "right") - 1, len(texts))
                signed = w.hashes.view(np.int64)
                out["rest"] = [signed[s:e][~known[s:e]] for s, e in zip(w.first[:-1], w.first[1:], strict=True)]
                yield out

    schema = "doc_id long, n_tokens long, n_known long, found double, score double, codes array<long>, times array<long>, rest array<long>"
    scored = materialise(docs.transform(map_frames, work, schema).withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    rare = words.where(_grade(F.col("n")) < least)
    met = (scored.select("row", F.explode("rest").alias("key")).groupBy("row", "key").agg(F.count(F.lit(1)).alias("times"))
           .join(rare, "key", "left").groupBy("row")
           .agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"),
                F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known")))
    # a code that is not sent is no common one, so no key of this join has a large share of its rows
    far = lengths.where(_grade(F.col("m")) < least_m).select("code", "length")
    coded = (scored.select("row", F.explode(F.arrays_zip("codes", "times")).alias("c")).select("row", F.col("c.codes").alias("code"), F.col("c.times").alias("times"))
             .join(far, "code").groupBy("row").agg(F.sum(F.col("times") * F.col("length")).alias("more_score")))
    return scored.join(met, "row", "left").join(coded, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (F.col("found") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))
