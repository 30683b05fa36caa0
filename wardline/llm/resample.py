"""Importance resampling towards a target distribution, over hashed word n-grams.

Features are found by overlapped regex scanning: a text's separators are collapsed to
single spaces, then ``finditer`` with ``overlapped=True`` runs over the result, once for
each n. The pattern's look-arounds hold it to whole words, so each match is the span of n
consecutive words and is counted by the CRC of its bytes, modulo ``buckets``, as it stands.

Counts of the source and of the target are summed in the tasks (an array of ``buckets``
for each) before they are added up; the driver holds the ``buckets`` gains. A document's
weight is the sum of its features' gains; with a Gumbel number drawn from a hash of its
id it is its score, and the highest scores of the long enough documents are drawn. Ranks
come from a sort over all partitions, not from one task.

Defined results: null and empty texts have no features, weight 0 and are never drawn when
``least_words`` is positive; a null id hashes as the empty text and is last among ties;
rows that share an id are judged each by its own text, and of equal scores any goes first;
an empty source or target gives gains from the smoothing alone; other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import LOWER, UPPER, Batches, map_batches, materialise, ranked

#: Words of an n-gram, hash buckets, percent drawn, words that a drawn document has at least.
LONGEST, BUCKETS, PERCENT, LEAST_WORDS, SEED = 1, 10_000, 10, 20, "2024"

_SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
_WORD = rb"[^ ]+"
FEATURES = "n_words long, n_features long, buckets array<int>, counts array<int>"


def patterns(longest: int) -> list[regex.Pattern]:
    """For each n up to ``longest``: n words between boundaries, to be scanned overlapped."""
    return [regex.compile(rb"(?<![^ ])" + rb" ".join([_WORD] * n) + rb"(?![^ ])") for n in range(1, longest + 1)]


def scan(text: str | None, scans: list[regex.Pattern], buckets: int) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every feature."""
    flat = _SEPARATORS.sub(b" ", (text or "").encode("utf-8", "replace").translate(_LOWERED)).strip(b" ")
    crc = zlib.crc32
    found = [np.fromiter((crc(m[0]) for m in p.finditer(flat, overlapped=True)), np.uint32) for p in scans]
    return len(found[0]), np.concatenate(found) % buckets


def features(docs: DataFrame, ids: list[str], longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """Each row's ``ids``, its number of words and of features, and how often each bucket occurs."""

    def work(batches: Batches) -> Batches:
        scans = patterns(longest)
        for batch in batches:
            words, sums, held = [], [], []
            for text in batch.column(len(ids)).to_pylist():
                n, of = scan(text, scans, buckets)
                words.append(n)
                sums.append(len(of))
                held.append(np.unique(of, return_counts=True))
            ends = np.cumsum([0, *(len(b) for b, _ in held)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, np.concatenate([x[i] for x in held]).astype(np.int32) if held else np.zeros(0, np.int32))
                     for i in (0, 1)]
            yield pa.record_batch([*(batch.column(i) for i in range(len(ids))), pa.array(words, pa.int64()), pa.array(sums, pa.int64()), *lists],
                                  [*ids, "n_words", "n_features", "buckets", "counts"])

    kept = docs.select(*ids, "text")
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields[:-1])
    return map_batches(kept, work, types + FEATURES)


def totals(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all rows."""

    def work(batches: Batches) -> Batches:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            b, n = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
            held += np.bincount(b, weights=n, minlength=buckets).astype(np.int64)
        some = np.flatnonzero(held)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(held[some])], ["bucket", "n"])

    part = map_batches(found.select("buckets", "counts"), work, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in part.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio of target to source, for each bucket."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """Each row's weight; the buckets are no longer needed."""
    ids = [c for c in found.columns if c not in ("buckets", "counts")]

    def work(batches: Batches) -> Batches:
        for batch in batches:
            b, n = (batch.column(len(ids) + i) for i in (0, 1))
            upto = np.concatenate([[0], np.cumsum(gain[b.flatten().to_numpy(zero_copy_only=False)] * n.flatten().to_numpy(zero_copy_only=False))])
            ends = np.cumsum([0, *b.value_lengths().to_pylist()])
            yield pa.record_batch([*(batch.column(i) for i in range(len(ids))), pa.array(upto[ends[1:]] - upto[ends[:-1]])], [*ids, "weight"])

    types = ", ".join(f"`{c}` {found.schema[c].dataType.simpleString()}" for c in ids)
    return map_batches(found.select(*ids, "buckets", "counts"), work, types + ", weight long")


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """Thousandths of a Gumbel number that the id and the seed determine."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = LONGEST,
             buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """Every document with its weight and score; ``rank`` from 1 for the drawn ones, null for the others."""
    found = materialise(features(docs, ["doc_id"], longest, buckets), "ngrams")
    gain = gains(totals(found, buckets), totals(features(target, [], longest, buckets), buckets))
    scored = materialise(weighted(found, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scored")
    fit = F.col("n_words") >= least_words
    drawn = scored.where(fit).count() * percent // 100
    order = ranked(scored.where(fit), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), name="ranked")
    out = order.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return out.unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))


ORACLE = r"""
WITH RECURSIVE words(src, id, w) AS (
  SELECT 0, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM documents
  UNION ALL
  SELECT 1, NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
bits(b, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
distinct_words AS (SELECT DISTINCT w, hex(encode(w)) AS h FROM words),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(h) // 2),
      lambda i: CAST(16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1 AS BIGINT))),
      lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS BIGINT) + 1])), CAST(4294967295 AS BIGINT)) % 10000 AS bucket
  FROM distinct_words, crc_table),
featured AS (SELECT src, id, bucket FROM words JOIN hashed USING (w)),
counts AS (SELECT bucket, count(*) FILTER (WHERE src = 0) AS s, count(*) FILTER (WHERE src = 1) AS t FROM featured GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM counts) + 10000.0::DOUBLE)
      / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM counts) + 10000.0::DOUBLE)))) AS BIGINT) AS g FROM counts),
weights AS (SELECT id, count(*) AS n, sum(g) AS weight FROM featured JOIN gain USING (bucket) WHERE src = 0 GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST(coalesce(weight, 0)
      + floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights ON id = doc_id),
ordered AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.*, CASE WHEN place <= (10 * n) // 100 THEN place END AS rank FROM scored LEFT JOIN ordered USING (doc_id)"""
