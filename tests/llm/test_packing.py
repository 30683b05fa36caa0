import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import ODD
from tokenizers import Tokenizer

from wardline.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_pieces_equal_the_tokenizer_and_places_are_gapless(spark, documents, tokenizer):
    rows = [*ODD, (20, "a<|endoftext|>b  \n\n c"), (21, "x" * 5000), *((100 + i, "tokens of text " * (i * 7 % 900)) for i in range(200))]
    got = P.pack(P.pieces(documents(rows)), group=64).toPandas()
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, P.END], "<u4")
        mine = got[got.doc_id.isna() if d is None else got.doc_id == d].drop_duplicates("piece").sort_values("piece")
        assert mine.length.sum() == len(ids) and (mine.length.to_numpy()[1:] == P.SIZE).all()
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(mine.start, mine.length, strict=True)] == mine.ids_crc32.tolist()
    q = got.sort_values(["sequence_id", "offset"])
    assert (q.groupby("sequence_id").length.cumsum() - q.length == q.offset).all()
    fill = got.groupby("sequence_id").length.sum()
    assert fill.max() <= P.SIZE and len(fill) <= 1.03 * np.ceil(got.length.sum() / P.SIZE) + 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_local_search_keeps_items_and_never_adds_bins(lengths):
    x = np.array(lengths, np.int64)
    first = P.best_fit(x, 64)
    bins = P.improve([list(b) for b in first], x, 64)
    assert sorted(i for b in bins for i in b) == list(range(len(x))) and len(bins) <= len(first)
    assert all(x[b].sum() <= 64 for b in bins)


def test_search_empties_bins():
    x = np.array([6, 6, 4, 4, 5, 5, 5, 5])
    bad = [[0, 2], [1, 4 - 1], [4, 5], [6], [7]]
    assert len(P.improve(bad, x, 10)) == 4


def test_empty(spark, documents):
    assert P.pack(P.pieces(documents([(1, "x")]).limit(0))).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_counted_lengths_pack_as_best_fit_decreasing(lengths):
    x = np.array(sorted(lengths), np.int64)
    size, n = np.unique(x, return_counts=True)
    ranges, bins = P.best_fit_counts(dict(zip(size.tolist(), n.tolist(), strict=True)), 64)
    assert bins == len(P.best_fit(x, 64))
    if bins:
        number = np.concatenate([np.arange(k) for k in n])
        b, off = P.places(ranges, x, number)
        taken = sorted((i, o, o + k) for i, o, k in zip(b.tolist(), off.tolist(), x.tolist(), strict=True))
        assert {i for i, _, _ in taken} == set(range(bins))
        for (i, begin, _), (j, _, end) in zip(taken, [(-1, 0, 0), *taken], strict=False):
            assert begin == (end if i == j else 0)  # no gap, no overlap
        assert max(end for _, _, end in taken) <= 64


@pytest.mark.parametrize("short", [[], [3], [60] * 300, [30] * 40])
def test_pieces_that_do_not_fit_together_stay_in_bounded_groups(spark, short):
    """Lengths of over half a sequence: no round can shrink them, and no group may hold them all."""
    lengths = [*(520 + i * 37 % 497 for i in range(2000)), *short]
    cut = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], P.PIECES)
    got = P.pack(cut, group=64).toPandas()
    assert sorted(got.doc_id) == list(range(len(lengths)))
    q = got.sort_values(["sequence_id", "offset"])
    assert (q.groupby("sequence_id").length.cumsum() - q.length == q.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= P.SIZE
    grouped = got[got.sequence_id >= 0]
    assert not len(grouped) or grouped.groupby(grouped.sequence_id // (1 << 24)).size().max() <= 2 * 64
    assert got.sequence_id.nunique() <= len(P.best_fit(np.array(lengths))) + len(short) // 20


def test_leftovers_matched_by_their_counts(spark):
    rows = [(i, 0, 0, n, i, i * 7 % 1009, 0) for i, n in enumerate([400, 300, 300, 500] * 100)]
    rest = spark.createDataFrame(rows, P.PIECES + ", row long, x int").drop("x")
    got = P._numbered(rest, 7).toPandas()
    for _, f in got.groupby("length"):
        assert sorted(f.number) == list(range(len(f)))
