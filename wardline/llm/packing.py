"""Best-fit packing of documents into token sequences, improved by swap-based local search.

A document's ids end with an end id. Longer ones are cut into full pieces, the
first of which takes the rest; full pieces are sequences of their own. The other
pieces are dealt into groups of bounded size at random, packed best-fit
decreasing, and the groups improve by local search: the emptiest bin moves a
document, or exchanges one or two documents for one, so that the sum of squared
fills grows, until it is empty. What lies in bins that stay underfull goes on to
the next round with fewer groups of the same size, until one group is left. Pieces
too long to share a bin with the shortest one left are sequences of their own. When a
round takes few pieces away, what is left is matched by its counts of lengths: best-fit
decreasing over the counts, which are few, says for each length's first, second, ...
piece its bin; that is taken if it needs fewer bins than the round did.

Defined cases: a null or empty text is the end id alone; repeated rows are packed
each; a null doc_id is kept; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import map_frames, materialise, whole_groups

SIZE = 1024
END = 2
GROUP = 4096
#: A round that leaves more than this share of its pieces is the last of its kind.
SHRINKS = 0.75
#: Bins with at least this many free places go on to the next round.
SLACK = 8

#: How the vocabulary splits text before merging, and its one special token. Fixed values.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = {"<|endoftext|>": 50256}

_encodings: dict[str, tiktoken.Encoding] = {}


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a rank file; once for each worker."""
    if path not in _encodings:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _encodings[path]


def _cut(text: str | None, enc: tiktoken.Encoding, size: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document; special tokens in a text count as themselves."""
    ids = np.array([*enc.encode(text or "", allowed_special="all"), end], "<u4")
    bounds = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        yield k, a, b - a, zlib.crc32(ids[a:b].tobytes())


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary_path: str | None = None, size: int = SIZE, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every whole text."""
    path = vocabulary_path or vocabulary()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(path)
        for f in frames:
            rows = [(d, *p) for d, t in zip(f["doc_id"].astype("Int64"), f["text"], strict=True) for p in _cut(t, enc, size, end)]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_frames, cut, PIECES)


def best_fit(lengths: np.ndarray, size: int = SIZE) -> list[list[int]]:
    """Best-fit decreasing: bins of item numbers."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(size + 1)]  # bins by free places
    some = 0  # bit f: there is a bin with f free places
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = some >> n
        if fits:
            f = n + (fits & -fits).bit_length() - 1
            b = free[f].pop()
            if not free[f]:
                some &= ~(1 << f)
            bins[b].append(i)
        else:
            f, b = size, len(bins)
            bins.append([i])
        free[f - n].append(b)
        some |= 1 << (f - n)
    return bins


def best_fit_counts(counts: dict[int, int], size: int = SIZE) -> tuple[np.ndarray, int]:
    """Best-fit decreasing of counted lengths, and the number of bins.

    Rows (length, first, bin, each, offset): from its ``first`` piece on, a length's pieces
    go ``each`` to a bin, from ``bin`` on, behind ``offset``.
    """
    free: dict[int, list[tuple[int, int]]] = {}  # ranges of bins by free places
    out, n_bins = [], 0
    for n in sorted(counts, reverse=True):
        first, left = 0, counts[n]
        while left:
            f = min((f for f in free if f >= n), default=None)
            if f is None:
                f, b, k = size, n_bins, -(-left // (size // n))
                n_bins += k
            else:
                b, k = free[f].pop()
                if not free[f]:
                    del free[f]
            each = f // n
            put = min(left, k * each)
            out.append((n, first, b, each, size - f))
            whole, more = divmod(put, each)
            for at, number, held in ((b, whole, each), (b + whole, int(more > 0), more), (b + whole + (more > 0), k - whole - (more > 0), 0)):
                if number:
                    free.setdefault(f - held * n, []).append((at, number))
            first, left = first + put, left - put
    return np.array(sorted(out), np.int64).reshape(-1, 5), n_bins


def places(ranges: np.ndarray, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length's numbered pieces."""
    _, first, b, each, offset = ranges[np.searchsorted((ranges[:, 0] << 40) + ranges[:, 1], (length << 40) + number, "right") - 1].T
    return b + (number - first) // each, offset + (number - first) % each * length


def improve(bins: list[list[int]], lengths: np.ndarray, size: int = SIZE) -> list[list[int]]:
    """Local search: every step raises the sum of squared fills; ends when no pass empties a bin."""
    least = -(-int(lengths.sum()) // size)
    fill = np.array([sum(int(lengths[i]) for i in b) for b in bins])
    n_bins = len(bins)
    while n_bins > least:
        emptied = 0
        for d in np.argsort(fill, kind="stable"):
            if not 0 < fill[d] < size:
                continue
            while fill[d]:
                others = np.flatnonzero((fill > 0) & (fill < size))
                others = others[others != d]
                # what a bin gives back: nothing (a move) or one of its documents (an exchange)
                back = [(0, -1, b) for b in others] + [(int(lengths[i]), i, b) for b in others for i in bins[b]]
                if not back:
                    break
                length, item, at = (np.array(x) for x in zip(*back, strict=True))
                mine = bins[d]
                give = [(i,) for i in mine] + [(i, j) for k, i in enumerate(mine) for j in mine[k + 1 :]]
                sums = np.array([sum(int(lengths[i]) for i in g) for g in give])
                one = np.unique(sums, return_index=True)[1]
                gain = sums[one][:, None] - length[None, :]
                better = 2 * gain * (fill[at] - fill[d] + gain)  # growth of the sum of squares
                better[(gain <= 0) | (gain > size - fill[at])] = 0
                k, t = np.unravel_index(int(better.argmax()), better.shape)
                if better[k, t] <= 0:
                    break
                b, moved = int(at[t]), give[one[k]]
                bins[d] = [i for i in mine if i not in moved] + ([int(item[t])] if item[t] >= 0 else [])
                bins[b] = [i for i in bins[b] if i != item[t]] + list(moved)
                fill[b] += gain[k, t]
                fill[d] -= gain[k, t]
            if not fill[d]:
                emptied, n_bins = emptied + 1, n_bins - 1
                if n_bins == least:
                    break
        if not emptied:
            break
    return [b for b in bins if b]


def _pack(size: int, turn: int):
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, ["grp"]):
            for grp, f in frame.groupby("grp"):
                lengths = f["length"].to_numpy(np.int64)
                seq, off, free = (np.empty(len(f), np.int64) for _ in range(3))
                alone = lengths > size - lengths.min()  # too long to share a bin with any
                some = np.flatnonzero(~alone)
                bins = improve(best_fit(lengths[some], size), lengths[some], size)
                for k, b in enumerate([[i] for i in np.flatnonzero(alone)] + [some[b] for b in bins]):
                    b = sorted(b)
                    ends = np.cumsum(lengths[b])
                    seq[b], off[b], free[b] = (turn << 56) + (int(grp) << 24) + k, ends - lengths[b], size - ends[-1]
                yield f.drop(columns="grp").assign(sequence_id=seq, offset=off, free=free)

    return pack


def _numbered(rest: DataFrame, buckets: int) -> DataFrame:
    """The pieces, those of each length numbered from 0 on."""
    rest = rest.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    n = rest.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    n = n.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    return rest.withColumn("nth", nth).join(n, ["length", "bucket"]).withColumn("number", F.col("before") + F.col("nth")).drop("nth", "before", "bucket")


def _match(held, turn: int):
    def match(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            seq, off = places(held.value, f["length"].to_numpy(np.int64), f["number"].to_numpy(np.int64))
            yield f.drop(columns="number").assign(sequence_id=(turn << 56) + seq, offset=off)

    return match


def pack(cut: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """The pieces with sequence_id and offset."""
    cut = materialise(cut, "pieces")  # numbered below: must not change
    row = F.monotonically_increasing_id()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    done = [cut.withColumn("row", row).where(F.col("length") == size).select(*columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    rest = cut.withColumn("row", row).where(F.col("length") < size)
    schema = PIECES + ", row long, sequence_id long, offset long, free long"
    turn = 1
    while True:
        left, shortest = rest.agg(F.count(F.lit(1)), F.min("length")).first()
        if not left:
            break
        alone = F.col("length") > size - shortest
        done.append(rest.where(alone).select(*columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
        rest = rest.where(~alone)
        groups = -(-left // group)
        dealt = rest.withColumn("grp", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)))
        packed = materialise(dealt.repartition("grp").sortWithinPartitions("grp", "row").transform(map_frames, _pack(size, turn), schema), "packed")
        if groups == 1:
            done.append(packed.select(*columns, "sequence_id", "offset"))
            break
        full = F.col("free") < SLACK
        done.append(packed.where(full).select(*columns, "sequence_id", "offset"))
        under = packed.where(~full)
        rest = under.select(*columns, "row")
        n = {r.length: r.n for r in rest.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``size`` rows
        turn += 1
        if sum(n.values()) <= SHRINKS * left:
            continue
        ranges, bins = best_fit_counts(n, size)
        if bins < under.where("offset = 0").count():
            held = cut.sparkSession.sparkContext.broadcast(ranges)
            under = _numbered(rest, 16 * groups).select(*columns, "number").transform(map_frames, _match(held, turn), PIECES + ", sequence_id long, offset long")
        done.append(under.select(*columns, "sequence_id", "offset"))
        break
    out = done[0]
    for d in done[1:]:
        out = out.unionAll(d)
    return out
