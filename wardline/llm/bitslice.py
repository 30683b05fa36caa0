"""Exact top-k inner-product search on a bit-sliced index.

Vectors become integers floor(scale * x). Rows are dealt into blocks; a block's
index holds, for each component and each bit of its value above the block's
least, one bitmap over the rows (a slice). A query adds the slices (or their
complements, for negative weights) with carry-save bitmap arithmetic, which
gives the slices of all rows' scores; the top rows are then selected from the
most significant slice downward, and ties on the boundary go to smaller ids.
Every block answers every query exactly; the answers meet in a top-k per query.

Queries and index blocks are paired by block number: the queries, in sets of
bounded size, are sent to every block, and a task holds one block at a time.

A slice holds values of 32 bits. Vectors with a larger one, if there are any, are no part of
the index: they meet the queries, and as queries all vectors, in blocks of whole numbers of
any size, and all answers meet in the same top-k.

Defined cases: vectors that are null or hold null or non-finite components, or without an
id, take no part. A query meets vectors of its own length only, and no row of its own id.
Equal query rows give one result; repeated candidates count each. A score beyond 64 bits
is ranked as it is and given as the nearest long. A component
beyond a double once scaled counts as non-finite. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import map_frames, materialise

SCALE = 1024
TOP = 10
BLOCK = 16384
QUERIES = 64


def usable(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, w, wide): the vectors that take part, scaled, as whole doubles; ``wide`` ones have a value beyond 32 bits."""
    def whole(e: Column) -> Column:  # doubles beyond 2^53 are whole already
        return F.when(F.abs(e) < float(1 << 53), F.floor(e).cast("double")).otherwise(e)

    scaled = F.transform("embedding", lambda e: e.cast("double") * scale)
    held = rows.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    finite = F.forall("x", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    return held.where(finite).select("vec_id", F.transform("x", whole).alias("w"), F.exists("x", lambda e: F.abs(e) >= float(1 << 31)).alias("wide"))


def quantised(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): integer vectors of the rows whose values fit in 32 bits."""
    return usable(rows, scale).where(~F.col("wide")).select("vec_id", F.col("w").cast("array<long>").alias("v"))


class Slices(NamedTuple):
    ids: np.ndarray  # ascending
    least: np.ndarray  # of each component
    bits: np.ndarray  # of each component's range
    maps: np.ndarray  # (2, components, most bits, words): slices and their complements
    rows: np.ndarray  # bitmap of the rows there are


def build(ids: np.ndarray, v: np.ndarray) -> Slices:
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], v[order]
    n, d = v.shape
    words = -(-n // 64)
    least = v.min(0) if n else np.zeros(d, np.int64)
    above = (v - least).astype(np.uint64)
    bits = np.array([int(x).bit_length() for x in above.max(0)], int) if n else np.zeros(d, int)
    most = max(int(bits.max(initial=0)), 1)

    def bitmap(flags: np.ndarray) -> np.ndarray:
        padded = np.zeros((flags.shape[0], words * 64), np.uint8)
        padded[:, :n] = flags
        return np.packbits(padded, axis=1, bitorder="little").view("<u8").astype(np.uint64)

    maps = np.stack([bitmap(((above >> np.uint64(b)) & np.uint64(1)).T) for b in range(most)], 1)
    rows = bitmap(np.ones((1, n), np.uint8))[0]
    return Slices(ids, least, bits, np.stack([maps, ~maps & rows]), rows)


def stored(index: Slices) -> dict[str, bytes]:
    """An index block as columns; complements and the bitmap of rows are worked out again."""
    return {"ids": index.ids.astype("<i8").tobytes(), "least": index.least.astype("<i8").tobytes(),
            "bits": index.bits.astype("<i4").tobytes(), "slices": index.maps[0].astype("<u8").tobytes()}


def loaded(ids: bytes, least: bytes, bits: bytes, slices: bytes) -> Slices:
    i, lo, b = np.frombuffer(ids, "<i8"), np.frombuffer(least, "<i8"), np.frombuffer(bits, "<i4")
    words = -(-len(i) // 64)
    rows = np.packbits(np.arange(words * 64) < len(i), bitorder="little").view("<u8").astype(np.uint64)
    maps = np.frombuffer(slices, "<u8").astype(np.uint64).reshape(len(lo), -1 if len(lo) else 1, words)
    return Slices(i, lo, b, np.stack([maps, ~maps & rows]), rows)


def add(index: Slices, q: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices of the scores above a constant, least significant first, and that constant."""
    weight, sign = np.abs(q), (q < 0).astype(int)
    offset = int((q * index.least).sum()) - int((weight * sign * ((1 << index.bits) - 1)).sum())
    columns: list[list[np.ndarray]] = []
    for a in range(int(weight.max(initial=0)).bit_length()):
        on = np.flatnonzero((weight >> a) & 1)
        for b in range(int(index.bits[on].max(initial=0))):
            d = on[index.bits[on] > b]
            while len(columns) <= a + b:
                columns.append([])
            columns[a + b].append(index.maps[sign[d], d, b])
    out, p = [], 0
    while p < len(columns):
        x = np.concatenate(columns[p]) if columns[p] else np.zeros((1, len(index.rows)), np.uint64)
        carries = []
        while len(x) > 1:
            k = len(x) // 3
            if k:  # full adders: three bitmaps of a place become one, and one of the next
                u, v, w = x[:k], x[k : 2 * k], x[2 * k : 3 * k]
                half = u ^ v
                carries.append((u & v) | (half & w))
                x = np.concatenate([half ^ w, x[3 * k :]])
            else:
                carries.append(x[:1] & x[1:])
                x = x[:1] ^ x[1:]
        out.append(x[0])
        if carries:
            if len(columns) == p + 1:
                columns.append([])
            columns[p + 1] += carries
        p += 1
    return out, offset


def top(index: Slices, score: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k highest scores among the allowed rows; boundary ties by id."""
    sure, tied = np.zeros_like(allowed), allowed.copy()
    if int(np.bitwise_count(allowed).sum()) <= k:
        sure, tied = allowed, np.zeros_like(allowed)
    else:
        for s in reversed(score):
            x = sure | (tied & s)
            n = int(np.bitwise_count(x).sum())
            if n > k:
                tied &= s
            elif n < k:
                sure, tied = x, tied & ~s
            else:
                sure, tied = x, np.zeros_like(tied)
                break

    def rows(m: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(m.astype("<u8").view(np.uint8), bitorder="little"))

    a = rows(sure)
    return np.concatenate([a, rows(tied)[: k - len(a)]])


def search(index: Slices, query_id: int, q: np.ndarray, k: int) -> Iterator[tuple[int, int]]:
    """(vec_id, score) of the block's best rows."""
    score, offset = add(index, q)
    allowed = index.rows.copy()
    a, b = np.searchsorted(index.ids, [query_id, query_id + 1])
    for r in range(a, b):
        allowed[r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
    chosen = top(index, score, allowed, k)
    total = np.full(len(chosen), offset, np.int64)
    for p, s in enumerate(score):
        total += ((s[chosen >> 6] >> (chosen & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << p
    return zip(index.ids[chosen].tolist(), total.tolist(), strict=True)


def _parts(frames: Iterator[pd.DataFrame], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(components, ids, vectors) of at most ``most`` rows of one number of components."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def cut(dim: int, down_to: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        ids, v = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
        a = 0
        while len(ids) - a > down_to:
            yield dim, ids[a : a + most], v[a : a + most]
            a += most
        if a < len(ids):
            held[dim] = [(ids[a:], v[a:])]

    for f in frames:
        for dim, g in f.groupby(f["v"].map(len)):
            dim = int(dim)
            held.setdefault(dim, []).append((g["vec_id"].to_numpy(np.int64), np.array(g["v"].tolist(), np.int64).reshape(len(g), dim)))
            if sum(len(i) for i, _ in held[dim]) >= most:
                yield from cut(dim, most - 1)
    for dim in list(held):
        yield from cut(dim, 0)


def _index(block: int):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for dim, ids, v in _parts(frames, block):
            yield pd.DataFrame([{"dim": dim, **stored(build(ids, v))}])

    return work


def _queries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for dim, ids, v in _parts(frames, QUERIES):
        yield pd.DataFrame({"dim": [dim], "ids": [ids.astype("<i8").tobytes()], "vectors": [v.astype("<i4").tobytes()]})


def _search(k: int):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                if r.vectors is None:
                    held = (r.block, loaded(r.ids, r.least, r.bits, r.slices))
                elif held and held[0] == r.block:
                    ids = np.frombuffer(r.ids, "<i8")
                    vectors = np.frombuffer(r.vectors, "<i4").reshape(len(ids), r.dim).astype(np.int64)
                    for q, v in zip(ids.tolist(), vectors, strict=True):
                        out += [(q, v.tobytes(), i, s) for i, s in search(held[1], q, v, k)]
            yield pd.DataFrame(out, columns=["query_id", "vector", "vec_id", "score"])

    return work


#: Vectors of a block of the path for large values; shares in which its queries meet the blocks.
EXACT, SALTS = 256, 64


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        for dim, g in f.groupby(f["w"].map(len)):
            for i in range(0, len(g), EXACT):
                part = g.iloc[i : i + EXACT]
                yield pd.DataFrame({"dim": [int(dim)], "ids": [part["vec_id"].to_numpy("<i8").tobytes()],
                                    "vectors": [np.concatenate([np.zeros(0), *part["w"]]).astype("<f8").tobytes()]})


def _numbers(ids: bytes, vectors: bytes, dim: int) -> tuple[list[int], np.ndarray]:
    """Ids, and vectors as whole numbers of any size."""
    i = np.frombuffer(ids, "<i8").tolist()
    return i, np.array([int(x) for x in np.frombuffer(vectors, "<f8")], object).reshape(len(i), dim)


def _name(vector: np.ndarray) -> bytes:
    """What stands for a query's vector: as the index has it, if it could be there."""
    small = all(abs(x) < 1 << 31 for x in vector)
    return np.array(vector, np.int64).tobytes() if small else ",".join(map(str, vector)).encode()


def _order(score: int) -> tuple[int, str]:
    """Sorts as the score does: beyond 64 bits or not, and then by digits of a fixed number (of two largest doubles' product)."""
    if -1 << 63 <= score < 1 << 63:
        return 0, ""
    digits = f"{abs(score):0640d}"
    return (1, digits) if score > 0 else (-1, digits.translate(str.maketrans("0123456789", "9876543210")))


def exact(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, vector, vec_id, score, size, digits): of each block of candidates each query's k best, in whole numbers of any size."""
    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                (qi, q), (ci, c) = _numbers(r.q_ids, r.q_vectors, r.dim), _numbers(r.ids, r.vectors, r.dim)
                scores = q @ c.T if r.dim else np.zeros((len(qi), len(ci)), int)
                for query, vector, row in zip(qi, q, scores, strict=True):
                    for low, i in sorted((-int(x), i) for x, i in zip(row, ci, strict=True) if i != query)[:k]:
                        out.append((query, _name(vector), i, max(min(-low, (1 << 63) - 1), -1 << 63), *_order(-low)))
            yield pd.DataFrame(out, columns=["query_id", "vector", "vec_id", "score", "size", "digits"])

    schema = "dim int, ids binary, vectors binary"
    asked = queries.select("vec_id", "w").distinct().transform(map_frames, _blocks, schema).select("dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    held = candidates.select("vec_id", "w").transform(map_frames, _blocks, schema).withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(SALTS)).cast("int"))
    spread = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return held.join(spread, ["dim", "salt"]).select("dim", "ids", "vectors", "q_ids", "q_vectors") \
        .transform(map_frames, meet, "query_id long, vector binary, vec_id long, score long, size int, digits string")


def top_k(rows: DataFrame, is_query: Column, k: int = TOP, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores, ties to the smaller vec_id."""
    found = indexed(rows, is_query, k, scale, block).withColumns({"size": F.lit(0), "digits": F.lit("")})
    if usable(rows, scale).where("wide").limit(1).count():
        every = materialise(usable(rows, scale), "all-vectors")
        asked = every.where(is_query)
        found = found.unionByName(exact(asked, every.where("wide"), k)).unionByName(exact(asked.where("wide"), every.where("NOT wide"), k))
    best = Window.partitionBy("query_id", "vector").orderBy(F.desc("size"), F.desc("digits"), F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def indexed(rows: DataFrame, is_query: Column, k: int, scale: int, block: int) -> DataFrame:
    """(query_id, vector, vec_id, score): of each block of the index each query's k best rows."""
    v = materialise(quantised(rows, scale), "vectors")
    n = v.count()
    n_blocks = max(1, -(-n // block))
    index = v.repartition(n_blocks).transform(map_frames, _index(block), "dim int, ids binary, least binary, bits binary, slices binary")
    index = materialise(index.withColumn("block", F.monotonically_increasing_id()), "bit-slices")
    asked = v.where(is_query).distinct()
    sets = asked.repartition(max(1, -(-asked.count() // QUERIES))).transform(map_frames, _queries, "dim int, ids binary, vectors binary")
    # every set of queries goes to every block of its number of components; salted, so that no task pairs all
    salts = -(-n_blocks // 64)
    spread = sets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    to = index.select("block", "dim", F.pmod("block", F.lit(salts)).cast("int").alias("salt"))
    sent = to.join(spread, ["dim", "salt"]).select("block", "dim", "ids", "vectors")
    both = index.unionByName(sent, allowMissingColumns=True)
    return (both.repartition("block").sortWithinPartitions("block", F.col("vectors").isNotNull())
            .transform(map_frames, _search(k), "query_id long, vector binary, vec_id long, score long"))


ORACLE = """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
u AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
      FROM u AS q JOIN u AS c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
