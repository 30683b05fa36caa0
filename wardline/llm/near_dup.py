"""MinHash near-duplicates by an LSH forest.

A document's set holds its distinct five-word shingles (64-bit hashes). Documents
with equal sets form a class; classes go on by their smallest doc_id. Signatures
of 128 minima are sorted in 16 orders (trees), each by eight components of its own.
A region holds the classes that share the first two of a tree's components. Within it,
sorted by that tree's order, the neighbours, which have the longest common prefixes, are
compared first, then whatever is not yet connected, by signatures alone; only the edges
that connect are emitted, never all pairs. A pair of similarity 0.75 misses all 16 regions
with a probability of 2e-6.

Depth adapts to each region: one of more than ``region`` classes is told apart by its
tree's next component, and so on up to the eighth; a leaf that is still too large is dealt
into chunks that have some classes in common. As a pair may part at a deeper component,
every class of a deepened region that is not in the region's largest connected part then
meets all of the region, chunk by chunk, so no link is lost; the large part, which holds a
large group of near copies, is not compared with itself.

The connected parts of those candidate edges hold every link that the forest
finds. In them links are confirmed on full sets: in a part of more than ``chunk``
documents in chunks with some documents in common, after which those outside of the largest
confirmed part meet all of it. The components of the confirmed links are the result.

Defined cases: without words the set is empty and links with nothing; a null
doc_id links with nothing (component null, kept). Rows with the same doc_id
stand for one document: what links with any of its texts is in its component, and
each row gets its own text's n_shingles; equal rows are ties that the smallest doc_id
wins. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm import arrays
from wardline.llm.common import broadcast_if_small, map_frames, materialise, whole_groups

SHINGLE = 5
PERCENT = 75
TREES, OWN = 16, 8
MINIMA = TREES * OWN
#: Signatures are kept as one byte a component; pairs with fewer equal ones are no candidates
#: (six standard deviations below what a similarity of 0.75 gives).
AGREE = 68
REGION = 2048
CHUNK = 256
#: Components of a tree that make a region, and rows (about) that the chunks of a large group have in common.
DEPTH = 2
HUBS = 16

_rng = np.random.default_rng(20240501)
_MULTIPLY = (_rng.integers(0, 1 << 31, MINIMA, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
_PLACE = arrays.mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = arrays.words(texts)
    run = arrays.run_hashes(w.hashes, SHINGLE)
    out = []
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(run[a : b - SHINGLE + 1]))
        elif b > a:  # fewer words: the whole sequence, told apart by its length
            out.append(arrays.mix((w.hashes[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """uint32 minima, one row for each set that isn't empty."""
    sets = [s for s in sets if len(s)]
    if not sets:
        return np.empty((0, MINIMA), np.uint32)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    h = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    return np.stack([np.minimum.reduceat(h * m + a, at) for m, a in zip(_MULTIPLY, _ADD, strict=True)], 1)


def _tree_keys(sig: np.ndarray) -> np.ndarray:
    """int64 (rows, trees): the first two components of each order."""
    two = sig.reshape(-1, TREES, OWN)[:, :, :DEPTH].astype(np.uint64)
    tree = np.arange(TREES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return arrays.mix(((two[:, :, 0] << np.uint64(32)) | two[:, :, 1]) ^ tree).view(np.int64)


def _sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for a, b, texts in arrays.encoded(frame["text"]):
            sets = shingle_sets(texts)
            sig = signatures(sets)
            row = np.cumsum([len(s) > 0 for s in sets]) - 1
            keys, low = _tree_keys(sig), (sig & 0xFF).astype(np.uint8)
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].iloc[a:b].astype("Int64").array,
                "n_shingles": [len(s) for s in sets],
                "cls": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                "keys": [keys[r] if len(s) else None for r, s in zip(row, sets, strict=True)],
                "sig": [low[r].tobytes() if len(s) else None for r, s in zip(row, sets, strict=True)],
            })


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, cls, keys, sig) of every whole text."""
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return cut.transform(map_frames, _sketch, "doc_id long, n_shingles long, cls binary, keys array<long>, sig binary")


class _Sets:
    """Union-find over the rows of one group; the root is the smallest row."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _connect(ids: np.ndarray, sig: np.ndarray, tree: int, asks: np.ndarray, sets: _Sets) -> Iterator[tuple[int, int]]:
    """Edges (rows) that connect what agrees: neighbours in the tree's order first, then asking rows and the unconnected."""
    own = np.roll(sig, -tree * OWN, 1)  # the tree's components first
    order = np.lexsort(own.T[::-1])  # longest common prefixes lie side by side
    near = (sig[order[1:]] == sig[order[:-1]]).sum(1) >= AGREE
    for i in np.flatnonzero(near):
        if sets.join(int(order[i]), int(order[i + 1])):
            yield int(order[i]), int(order[i + 1])
    place = np.arange(len(ids))
    for n, i in enumerate(np.flatnonzero(asks)):
        if n % 64 == 0:
            root = np.array([sets.find(j) for j in range(len(ids))])
            if (root == root[0]).all():
                return
        other = np.flatnonzero((root != root[i]) & (~asks | (place > i)))
        for j in other[(sig[other] == sig[i]).sum(1) >= AGREE]:
            if sets.join(int(i), int(j)):
                yield int(i), int(j)


def _link_regions(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidate edges (a, b), a < b, of the regions of one partition, sorted by key."""
    for frame in whole_groups(frames, ["key"]):
        key, ids = frame["key"].to_numpy(), frame["doc_id"].to_numpy(np.int64)
        tree, asks = frame["tree"].to_numpy(), frame["asks"].to_numpy(bool)
        sig = np.frombuffer(b"".join(frame["sig"]), np.uint8).reshape(-1, MINIMA)
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([begin, [len(key)]]))
        two = begin[size == 2]
        two = two[(sig[two] == sig[two + 1]).sum(1) >= AGREE]
        edges = [np.stack([ids[two], ids[two + 1]], 1)]
        for b, n in zip(begin[size > 2], size[size > 2], strict=True):
            found = [(ids[b + i], ids[b + j]) for i, j in _connect(ids[b : b + n], sig[b : b + n], tree[b], asks[b : b + n], _Sets(n))]
            if found:
                edges.append(np.array(found, np.int64))
        e = np.sort(np.concatenate(edges), 1)
        yield pd.DataFrame({"a": e[:, 0], "b": e[:, 1]})


def _by_key(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "doc_id")


def _chunk(salt: int, chunks: str) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.col(chunks)).cast("int")


def _in_chunks(rows: DataFrame, group: str, chunk: int) -> DataFrame:
    """``rows`` (with ``n``, the size of their group) under the key of their chunk; some rows of a large group are in all of its chunks."""
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    hub = (F.col("_chunks") > 1) & (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("n")) < HUBS)
    own = F.when(hub, F.sequence(F.lit(0), F.col("_chunks") - 1)).otherwise(F.array(_chunk(7, "_chunks")))
    return (rows.withColumn("_chunks", chunks).withColumn("_c", F.explode(own)).withColumn("asks", F.lit(True))
            .withColumn("key", F.xxhash64(group, "_c")).drop("_c", "_chunks"))


def _outsiders(members: DataFrame, parts: DataFrame, group: str, chunk: int, name: str) -> DataFrame | None:
    """(group, doc_id, outside, among, around) of the groups whose members (group, doc_id) are not all in one part; None: there are none.

    outside: not in the largest part of the group; among and around: chunks of those outside and of all.
    """
    placed = members.join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    placed = materialise(placed.select(group, "doc_id", F.coalesce("root", "doc_id").alias("root")), name)
    counts = placed.groupBy(group, "root").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy(group).agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"))
    outside = F.col("n") - F.col("most.n")
    largest = materialise(largest.where(outside > 0).select(
        group, F.col("most.root").alias("main"), F.ceil(outside / chunk).cast("int").alias("among"), F.ceil(F.col("n") / chunk).cast("int").alias("around")), f"{name}-groups")
    n = largest.count()
    if not n:
        return None
    return placed.join(broadcast_if_small(largest, n, 32), group).select(
        group, "doc_id", (F.col("root") != F.col("main")).alias("outside"), "among", "around")


def _meeting(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` (with the columns of _outsiders) dealt out so that each row outside meets all of its group."""
    all_rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("among") - 1))).withColumn("asks", F.lit(False)) \
        .withColumn("key", F.xxhash64(group, "_o", _chunk(7, "around")))
    asking = rows.where("outside").withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("around") - 1))).withColumn("asks", F.lit(True)) \
        .withColumn("key", F.xxhash64(group, _chunk(13, "among"), "_o"))
    return all_rows.unionAll(asking)


def candidate_edges(reps: DataFrame, region: int = REGION) -> DataFrame:
    """Distinct candidate edges (a, b) between class representatives (doc_id, keys, sig)."""

    def linked(rows: DataFrame) -> DataFrame:
        return _by_key(rows.select("doc_id", "sig", "tree", "asks", "key")).transform(map_frames, _link_regions, "a long, b long")

    rows = reps.select("doc_id", "sig", F.posexplode("keys").alias("tree", "key"))
    deepened, found, depth = None, [], DEPTH
    while True:  # until no region is too large, or its order ends
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        hot = materialise(sizes.where(F.col("n") > region), "hot-regions")
        n_hot = hot.count()
        if not n_hot:
            found.append(linked(rows.withColumn("asks", F.lit(True))))
            break
        marked = rows.join(broadcast_if_small(hot, n_hot, 24), "key", "left")
        found.append(linked(marked.where("n IS NULL").withColumn("asks", F.lit(True))))
        rows = materialise(marked.where("n IS NOT NULL").withColumnRenamed("key", "at"), "deepened")
        if deepened is None:
            deepened = rows
        if depth == OWN:  # a leaf
            found.append(linked(_in_chunks(rows, "at", region)))
            break
        own = F.expr(f"substring(sig, tree * {OWN} + {depth + 1}, 1)")
        rows = rows.select("doc_id", "sig", "tree", F.xxhash64("at", own).alias("key"))
        depth += 1
    edges = reduce(DataFrame.unionAll, found).distinct()
    if deepened is None:
        return edges
    edges = materialise(edges, "forest-edges")
    outside = _outsiders(deepened.select("at", "doc_id"), components(edges, "forest-parts"), "at", region // 2, "deepened-parts")
    if outside is None:
        return edges
    return edges.unionAll(linked(_meeting(deepened.drop("n").join(outside, ["at", "doc_id"]), "at"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs onto one smaller node, which itself hangs onto none."""
    twice = edges.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    inner = edges.join(edges.select(F.col("v").alias("of")), F.col("u") == F.col("of"), "left_semi")
    return not twice.limit(1).count() and not inner.limit(1).count()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): every node of the edges with the smallest node reachable.

    Large and small stars alternate: each node's larger, then its smaller neighbours
    are hung onto the smallest one, until only stars are left. Each round is written.
    """
    now = materialise(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct(), name)
    while not _are_stars(now):
        both = now.unionAll(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.where("u < v").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        hung = small.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        now = materialise(hung.unionAll(least.select("v", F.col("m").alias("u"))).where("u < v").distinct(), name)
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).unionAll(roots)


def _full_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for a, b, texts in arrays.encoded(frame["text"]):
            sets = shingle_sets(texts)
            some = np.array([len(s) > 0 for s in sets], bool)
            sig = (signatures(sets) & 0xFF).astype(np.uint8)
            kept = frame.drop(columns="text").iloc[a:b][some]
            yield kept.assign(sig=[r.tobytes() for r in sig], full=[s.tobytes() for s in sets if len(s)])


def _confirm(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges that connect the documents of a group, each confirmed on the full sets; one of the two asks."""
    for frame in whole_groups(frames, ["key"]):
        key, ids, asks = frame["key"].to_numpy(), frame["doc_id"].to_numpy(np.int64), frame["asks"].to_numpy(bool)
        sig = np.frombuffer(b"".join(frame["sig"]), np.uint8).reshape(-1, MINIMA)
        full = [np.frombuffer(x, np.uint64) for x in frame["full"]]
        size = np.array([len(x) for x in full])
        place = np.arange(len(ids))
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        edges = []
        for b, e in zip(begin, [*begin[1:], len(key)], strict=True):
            sets = _Sets(e - b)
            here = slice(b, e)
            for i in np.flatnonzero(asks[here]) + b:
                small, large = np.minimum(size[i], size[here]), np.maximum(size[i], size[here])
                can = (~asks[here] | (place[here] > i)) & (ids[here] != ids[i]) & (100 * small >= PERCENT * large)
                can &= (sig[here] == sig[i]).sum(1) >= AGREE
                for j in np.flatnonzero(can) + b:
                    if sets.find(i - b) == sets.find(j - b):
                        continue
                    both = len(np.intersect1d(full[i], full[j], assume_unique=True))
                    if 100 * both >= PERCENT * (size[i] + size[j] - both):
                        sets.join(int(i - b), int(j - b))
                        edges.append((ids[i], ids[j]))
        e = np.sort(np.array(edges, np.int64).reshape(-1, 2), 1)
        yield pd.DataFrame({"a": e[:, 0], "b": e[:, 1]})


def confirmed_edges(docs: DataFrame, parts: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The links (a, b) that connect the candidate parts (node, root), confirmed on full sets."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def full(members: DataFrame, extra: str) -> DataFrame:
        held = text.join(broadcast_if_small(members, members.count(), 48), "doc_id").select(*members.columns, "text")
        return held.transform(map_frames, _full_sets, f"doc_id long, {extra}, sig binary, full binary")

    def linked(rows: DataFrame) -> DataFrame:
        return _by_key(rows.select("doc_id", "sig", "full", "asks", "key")).transform(map_frames, _confirm, "a long, b long")

    sizes = parts.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    members = materialise(parts.join(sizes, "root").select(F.col("node").alias("doc_id"), F.col("root").alias("part"), "n"), "members")
    links = materialise(linked(_in_chunks(full(members, "part long, n long"), "part", chunk)).distinct(), "links")
    large = members.where(F.col("n") > chunk).select("part", "doc_id")
    if not large.limit(1).count():
        return links
    inside = links.join(large.select(F.col("doc_id").alias("a")), "a", "left_semi")  # a link lies in one part
    outside = _outsiders(large, components(inside, "confirmed-parts"), "part", chunk, "large-parts")
    if outside is None:
        return links
    outside = materialise(outside.select("doc_id", "part", "outside", "among", "around"), "outsiders")
    rest = full(outside, "part long, outside boolean, among int, around int")
    return links.unionAll(linked(_meeting(rest, "part"))).distinct()


def _same_ids(drawn: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) between the representatives of texts that share a doc_id."""
    several = drawn.where("cls IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).where("x <> y")
    twice = drawn.select("doc_id", "cls").join(several.select("doc_id"), "doc_id", "left_semi").where("cls IS NOT NULL").distinct()
    reps = twice.join(classes.select("cls", "rep"), "cls").select("doc_id", "rep")
    least = reps.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return reps.join(least, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b"))


def near_duplicates(docs: DataFrame, region: int = REGION, chunk: int = CHUNK) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    docs = docs.select("doc_id", "text")
    drawn = materialise(sketch(docs), "sketches")
    classes = (drawn.where("cls IS NOT NULL AND doc_id IS NOT NULL").groupBy("cls")
               .agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"), F.first("sig").alias("sig")))
    classes = materialise(classes, "classes")
    edges = candidate_edges(classes.select(F.col("rep").alias("doc_id"), "keys", "sig"), region)
    links = confirmed_edges(docs, components(edges, "candidate-parts"), chunk)
    roots = components(links.unionAll(_same_ids(drawn, classes)), "components")
    rooted = classes.select("cls", "rep").join(roots, F.col("rep") == F.col("node"), "left").select(
        "cls", F.coalesce("root", "rep").alias("of"))
    joined = drawn.select("doc_id", "n_shingles", "cls").join(rooted, "cls", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("of", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         component.eqNullSafe(F.col("doc_id")).alias("kept"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
      FROM w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (WITH RECURSIVE reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b)
      SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(r.b, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(r.b, w.doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = w.doc_id
"""
