import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from odd import ODD
from wardline.llm import resample as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "item_id long, text string, n_words string, bucket string"


def grams(text, longest):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, longest, buckets, percent, least):
    def count(texts):
        return Counter(zlib.crc32(g.encode()) % buckets for t in texts for g in grams(t, longest)[1])

    s, t = count(x for _, x in docs), count(target)
    ns, nt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets)))) for b in range(buckets)]
    out = []
    for d, text in docs:
        n_words, found = grams(text, longest)
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] for g in found)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = Counter(r[:1] + r[2:] + (i,) for i, r in enumerate(fit[:percent * len(fit) // 100], 1))
    return out, drawn


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10_000, 10), (3, 97, 50), (2, 7, 100)])
def test_equals_brute_force(spark, documents, longest, buckets, percent):
    docs = ODD + [(20 + i, " ".join(f"w{(i * j) % 11}-the É{j % 3}" for j in range(i))) for i in range(40)] + [(5, "same id, another text " * 9)]
    target = ["w1 the é0 w3", None, "", "THE w5; the w5"]
    frame = spark.createDataFrame([(i, t, "x", "x") for i, t in enumerate(target)], SCHEMA)
    got = R.resample(documents(docs), frame, percent=percent, longest=longest, buckets=buckets).collect()
    want, drawn = brute(docs, target, longest, buckets, percent, R.LEAST_WORDS)
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == Counter(want)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got if r["rank"]) == drawn


def test_spans_overlap_and_hold_to_whole_words():
    flat = b"a bb a bb a"
    spans = [m.span() for m in R.patterns(3)[2].finditer(flat, overlapped=True)]
    assert [flat[a:b] for a, b in spans] == [b"a bb a", b"bb a bb", b"a bb a"]


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], SCHEMA)
    assert R.resample(documents([]), none).collect() == []
    assert R.resample(documents([(1, "one two")]), none, least_words=0, percent=100).first()["rank"] == 1
