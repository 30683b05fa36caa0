import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from odd import ODD
from wardline.llm import token_file as T
from wardline.session import scratch_path

PATH = public_tokenizers.path(T.VOCABULARY)
HARD = ["", " ", "a b  c", "<|endoftext|> it's I'M 'll", "x<|endoftext|>", "İstanbul ǅ Σας\x1cq\x0bz\x85w\xa0k é ́x", "日本語 123 ###" * 50,
        "x" * 5000, "a*** b.*** It's c-d e_ f\\g ß÷ ×x ÿ! Ä?! [z] z] À+é", "tabs\tand\r\nlines\n", "don't. 'tis we'll're x'", None]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def whole(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, T.END]


def test_ids_equal_the_librarys_on_whole_texts(spark, library):
    texts = HARD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = np.random.default_rng(5)
    signs = [chr(c) for c in [*range(0, 0x250), 0x300, 0x301, 0x2028, 0x3A3, 0x4E00, 0x1F600]]
    texts += ["".join(rng.choice(signs, 30)) for _ in range(3000)]
    encoder = T.Encoder(PATH)
    for part in (texts, texts[:40], []):  # the second time words are known
        ids, counts = encoder.encode(pa.array(part, pa.string()))
        ends = np.cumsum(counts)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, counts, strict=True)] == [whole(library, t) for t in part]


@pytest.mark.parametrize("total", [0, 1, 7, 8, 9, 8 * T.BATCH, 8 * T.BATCH + 1, 3 * 8 * T.BATCH + 20])
def test_sequences_are_read_in_place(tmp_path, total):
    ids = np.arange(total).astype("<u2")
    file = T.Writer(str(tmp_path / "a.arrow"), 8, ids.dtype)
    for part in np.array_split(ids, 3):  # documents end anywhere
        file.write(pa.array([1], pa.int64()), part, np.array([len(part)]))
    assert file.close()["n_tokens"] == total
    held = T.Sequences(str(tmp_path / "a.arrow"))
    assert len(held) == -(-total // 8)
    for i in range(len(held)):
        got, mask = held[i]
        n = min(8, total - 8 * i)
        assert got[:n].tolist() == ids[8 * i:8 * i + n].tolist() and not got[n:].any() and not got.flags.owndata
        assert mask.to_pylist() == [j < n for j in range(8)]
    assert np.concatenate([ids[:0], *held.tokens(total // 3, total - total // 3)]).tolist() == ids[total // 3:].tolist()
    with pa.OSFile(str(tmp_path / "a.arrow")) as source:  # and by any reader of the format
        rows = pa.ipc.open_stream(source).read_all()
    assert rows.num_rows == len(held) and rows.column("mask").combine_chunks().flatten().true_count == total


def test_round_trip_of_odd_documents(spark, documents, library):
    rows = ODD + [(7, "another text of one id"), (-3, "an id below null's neighbours"), (None, None)]
    folder = scratch_path(spark, "token-test")
    files = T.write(documents(rows), PATH, folder, width=16, file_tokens=1000)
    assert files.count() > 3
    got = [tuple(r) for r in T.read(files).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    want = {}
    for d, t in rows:
        ids = whole(library, t)
        want.setdefault(d, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))  # null ids first
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    for d in want:
        assert sorted(r[2:] for r in got if r[0] == d) == sorted(want[d])


def test_no_documents(documents):
    assert T.round_trip(documents([])).collect() == []
