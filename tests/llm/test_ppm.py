import collections
import math
import zlib

import numpy as np
from pyspark.sql import functions as F
from odd import ODD

from wardline.llm import ppm
from wardline.llm.common import fold


def trie_of(texts, order):
    codes, _ = ppm._codes(texts, order)
    return ppm.build(order, [np.unique(codes & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True) for k in range(order + 1)])


def brute(texts, x, order):
    """PPM by dictionaries: longest known context first, exclusion after each escape."""
    counts = collections.defaultdict(collections.Counter)
    pad = bytes([ppm.BEGIN]) * order
    for t in texts:
        d = pad + t + b"\xff"
        for i in range(order, len(d)):
            for k in range(order + 1):
                counts[d[i - k : i]][d[i]] += 1
    d, total = pad + x + b"\xff", 0.0
    for i in range(order, len(d)):
        gone = set()
        for k in range(order, -1, -1):
            here = {s: n for s, n in counts.get(d[i - k : i], {}).items() if s not in gone}
            if not here:
                continue
            if d[i] in here:
                total += math.log10((here[d[i]] - ppm.DISCOUNT) / sum(here.values()))
                break
            total += math.log10(ppm.DISCOUNT * len(here) / sum(here.values()))
            gone |= set(here)
        else:
            total -= math.log10(ppm.SYMBOLS - len(gone))
    return total


def test_code_lengths_equal_brute_force():
    texts = [b"abracadabra", b"banana band", b"", b"abab", "été".encode()]
    trie = trie_of(texts, 3)
    tests = [b"abra", b"xyz", b"banab", b"", "é".encode(), b"abracadabra" * 3]
    assert np.allclose(ppm.text_scores(trie, tests), [brute(texts, x, 3) for x in tests])


def test_probabilities_sum_to_one():
    trie = trie_of([b"abracadabra", b"banana"], 2)
    for context in (b"ab", b"zz", b"an"):
        symbols = [s for s in range(256) if s != ppm.BEGIN]
        codes = np.array([(context[0] << 16) | (context[1] << 8) | s for s in symbols], np.uint64)
        assert abs((10 ** ppm.scores(trie, codes)).sum() - 1) < 1e-9


def test_scores_against_brute_force(spark, documents):
    rows = [*ODD[:7], *((100 + i, f"the model of text number{i % 7} É learns words{i} " * (i % 5)) for i in range(60))]
    held = fold(F.col("doc_id"), 5) == 1
    for common in (1 << 19, 4):  # all words sent to the tasks, or most met in the join
        got = ppm.score(documents(rows), ~held, common=common).toPandas()
        assert len(got) == len(rows)

        def tokens(t):
            low = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())
            return [*low.split(), None]

        train = [t for d, t in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1]
        c = collections.Counter(w for t in train for w in tokens(t))
        n, v = sum(c.values()), len(c)
        for d, t in rows:
            r = got[got.doc_id.isna() if d is None else got.doc_id == d].iloc[0]
            w = tokens(t)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
            assert abs(r.base_score - sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) < 1e-6
            assert r.score < 0
    kept = got.set_index("doc_id").loc[100 + 14]
    assert kept.score > kept.base_score  # seen many times


def test_nothing_to_learn_from(spark, documents):
    got = ppm.score(documents([(1, "ab"), (2, None)]), F.lit(False)).orderBy("doc_id").collect()
    assert [round(r.score, 9) for r in got] == [round(-n * math.log10(255), 9) for n in (3, 1)]
    assert ppm.score(documents([(1, "x")]).limit(0), F.lit(True)).count() == 0


def test_pruning_keeps_a_bounded_trie(spark, documents):
    docs = documents([(i, f"abc abd {i} xyz" * 5) for i in range(50)])
    counted = ppm.counts(docs, 3)
    trie = ppm.learn(counted, 3, nodes=60)
    assert sum(len(level.nodes) for level in trie.levels) <= 60
    codes = np.array([(97 << 24) | (98 << 16) | (99 << 8) | s for s in range(256) if s != ppm.BEGIN], np.uint64)
    assert (10 ** ppm.scores(trie, codes)).sum() <= 1 + 1e-9


def test_scores_are_those_of_the_whole_trie(spark, documents):
    """More nodes than any bound on what is sent to the tasks; each text as the trie in memory scores it."""
    letters = np.random.default_rng(7).integers(97, 123, (60, 4000), np.uint8)
    rows = [*ODD[:7], *((100 + i, row.tobytes().decode()) for i, row in enumerate(letters))]
    held = fold(F.col("doc_id"), 5) == 1
    encoded = {d: (t or "").encode() for d, t in rows}
    train = [(t or "").encode() for d, t in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1]
    trie = trie_of(train, ppm.ORDER)
    assert sum(len(level.nodes) for level in trie.levels) > ppm.NODES
    want = dict(zip(encoded, ppm.text_scores(trie, list(encoded.values())), strict=True))
    for cached in (1 << 20, 1000, 0):
        got = ppm.score(documents(rows), ~held, cached=cached).collect()
        assert len(got) == len(rows)
        assert all(abs(r.score - want[r.doc_id]) < 1e-6 * abs(want[r.doc_id]) + 1e-9 for r in got)
