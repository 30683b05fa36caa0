"""Token ids as Arrow stream files of equal-length sequences, read in place.

A file is an Arrow IPC stream whose record batches all hold ``BATCH`` sequences (the last
may hold fewer). A sequence is a row of two fixed-size lists: ``ids`` and ``mask``, each
``width`` long; the last sequence of a file is padded with id 0, and its mask is false
there. Lists of a fixed size have no offsets and no nulls, so every full batch takes the
same number of bytes: batch k starts at ``head + k * size``, and a sequence is found by
arithmetic, without a footer or a scan, as a slice of the mapped file (:class:`Sequences`).
Beside it lies a stream of the documents: id, first token in the file, number of tokens.

Writing: documents sorted by id over all partitions (:func:`wardline.llm.common.in_order`),
one or more files a partition, a new one after ``FILE_TOKENS`` tokens. A file has a name of
its own for each attempt of a task, and only those that the written manifest names count,
so a lost or repeated task leaves nothing wrong behind. A document's place among all ids is
its place in its file plus the ids of the files before, of which the driver holds one
number a file.

Encoding: white space parts tokens and never joins them, so a text's ids are those of its
pieces between blanks. Each distinct piece of a batch is encoded once by the tokenizers
library: a plain word, maybe with marks behind it, by the library's model (a worker keeps
about ``KEPT`` words), any other piece by the whole tokenizer. Strings of special tokens in
a text are ordinary text.

Defined results: null text counts as empty and gives the end id alone; rows with a null id
come first; rows that share an id are each written, ordered by a hash of their text; an
empty table gives no files and no rows; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardline.llm.common import Batches, in_order, map_batches, materialise
from wardline.session import scratch_path

VOCABULARY = "word_bpe_49k.json"
END = 1
#: Tokens of a sequence, sequences of a record batch, tokens after which a new file begins.
WIDTH, BATCH, FILE_TOKENS = 2048, 64, 1 << 26
#: Words whose ids a worker keeps; bytes of text that it encodes at a time.
KEPT, TEXT_BYTES = 1 << 20, 16 << 20
MANIFEST = "part long, file long, path string, n_docs long, n_tokens long"
DOCUMENT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


# ---------------------------------------------------------------- encoding

#: Latin letters whose lower case and normal form are single letters again, and marks without the apostrophe:
#: the vocabulary's own rules part letters with marks behind them into two units.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
PLAIN = f"^[{LETTERS}]+[!-&(-/:-@\\[-`{{-~]*$"
LOWER_LETTERS = "".join(chr(c) for c in (*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)))


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, if it is printable, else the next from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + others.index(b)) for b in range(256)}


class Encoder:
    """Texts to ids, equal to encoding each whole text with the tokenizers library."""

    def __init__(self, path: str, end: int = END):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_padding()
        self.library.no_truncation()
        wide = max(self.library.get_vocab_size(), end + 1) > 1 << 16
        self.dtype = np.dtype("<u4") if wide else np.dtype("<u2")
        self.end = end
        self.letters = _byte_letters()
        self.model = self.library.model
        self._forget()

    def _forget(self) -> None:
        """The words known: their ids, one after another, where each begins and how many it has."""
        self.words, self.sizes = pa.array([], pa.large_string()), np.zeros(0, np.int32)
        self.flat = np.zeros(0, self.dtype)

    def _learn(self, words: pa.Array) -> None:
        """The ids of lower-case words (or marks), each one unit of the vocabulary's model."""
        spelt = [w.encode().decode("latin-1").translate(self.letters) for w in words.to_pylist()]
        found = [[t.id for t in self.model.tokenize(w)] for w in spelt]
        self.words = pa.concat_arrays([self.words, words])
        self.sizes = np.concatenate([self.sizes, np.array([len(x) for x in found], np.int32)])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), self.dtype)])

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all distinct pieces, one after another, and how many each has."""
        if len(self.words) > KEPT:
            self._forget()
        plain = pc.match_substring_regex(pieces, PLAIN)
        is_plain = plain.to_numpy(zero_copy_only=False)
        low = pc.utf8_lower(pieces.filter(plain))
        words = pc.utf8_rtrim(low, MARKS)
        units = pa.concat_arrays([words, pc.utf8_ltrim(low, LOWER_LETTERS)]).dictionary_encode()
        known = pc.index_in(units.dictionary, self.words)
        if known.null_count:
            self._learn(units.dictionary.filter(pc.is_null(known)))
            known = pc.index_in(units.dictionary, self.words)
        # each piece is two units, of which the second may be empty: a word and its mark, or a piece apart and nothing
        others = [x.ids for x in self.library.encode_batch_fast(pieces.filter(pc.invert(plain)).to_pylist(), add_special_tokens=False)]
        sizes = np.concatenate([self.sizes, np.array([len(x) for x in others], np.int32), np.zeros(1, np.int32)])
        flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(others), self.dtype)])
        of = known.to_numpy(zero_copy_only=False).astype(np.int32)[units.indices.to_numpy(zero_copy_only=False)]
        pair = np.empty((len(pieces), 2), np.int32)
        pair[is_plain] = of.reshape(2, -1).T
        pair[~is_plain, 0] = len(self.sizes) + np.arange(len(others))
        pair[~is_plain, 1] = len(sizes) - 1
        return gathered(flat, sizes, pair.ravel()), sizes[pair].sum(axis=1, dtype=np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id, one after another; how many each has."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        for blank in "\t\n\r":
            texts = pc.replace_substring(texts, blank, " ")
        lists = pc.split_pattern(texts, " ")
        words = pc.list_flatten(lists).dictionary_encode()
        flat, sizes = self._pieces(words.dictionary)
        flat, sizes = np.append(flat, self.dtype.type(self.end)), np.append(sizes, np.int32(1))
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
        of = np.insert(words.indices.to_numpy(zero_copy_only=False), ends, len(sizes) - 1)
        upto = np.cumsum(sizes[of], dtype=np.int64)
        return gathered(flat, sizes, of), np.diff(upto[ends + np.arange(len(ends))], prepend=0)


def gathered(flat: np.ndarray, sizes: np.ndarray, of: np.ndarray, at_once: int = 1 << 18) -> np.ndarray:
    """The runs ``of``, one after another; run i has sizes[i] values, and all runs lie in a row in ``flat``."""
    firsts = np.cumsum(sizes, dtype=np.int64) - sizes
    out = [flat[:0]]
    for i in range(0, len(of), at_once):
        part = of[i:i + at_once]
        n = sizes[part]
        upto = np.cumsum(n, dtype=np.int64)
        place = np.repeat(firsts[part] - (upto - n), n)
        place += np.arange(len(place))
        out.append(flat[place])
    return np.concatenate(out)


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end: int = END) -> Encoder:
    """A worker's encoder."""
    if (path, end) not in _encoders:
        _encoders[path, end] = Encoder(path, end)
    return _encoders[path, end]


# ---------------------------------------------------------------- files


def _store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store that holds a path, and the path in it."""
    if not re.match(r"[a-z][a-z0-9+.-]*:", path):
        return pyarrow.fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


def sequence_schema(width: int, dtype: np.dtype) -> pa.Schema:
    values = pa.field("item", pa.from_numpy_dtype(dtype), nullable=False)
    return pa.schema([pa.field("ids", pa.list_(values, width), nullable=False),
                      pa.field("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), width), nullable=False)],
                     {"width": str(width), "batch": str(BATCH)})


class Writer:
    """A file of sequences and its documents."""

    def __init__(self, path: str, width: int, dtype: np.dtype):
        store, inner = _store(path)
        store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.path, self.width = path, width
        self.schema = sequence_schema(width, dtype)
        self.sinks = [store.open_output_stream(inner), store.open_output_stream(inner + ".docs")]
        self.ids = pa.ipc.new_stream(self.sinks[0], self.schema)
        self.docs = pa.ipc.new_stream(self.sinks[1], DOCUMENT)
        self.held = np.zeros(BATCH * width, dtype)
        self.filled = self.n_tokens = self.n_docs = 0

    def write(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        ends = np.cumsum(counts)
        self.docs.write_batch(pa.record_batch([doc_ids, pa.array(self.n_tokens + ends - counts), pa.array(counts)], schema=DOCUMENT))
        self.n_docs += len(counts)
        self.n_tokens += len(ids)
        while len(ids):
            n = min(len(ids), len(self.held) - self.filled)
            self.held[self.filled:self.filled + n] = ids[:n]
            self.filled, ids = self.filled + n, ids[n:]
            if self.filled == len(self.held):
                self._flush()

    def _flush(self) -> None:
        rows = -(-self.filled // self.width)
        if not rows:
            return
        self.held[self.filled:] = 0
        n = rows * self.width
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x[:n]), type=f.type)
                   for x, f in zip((self.held, np.arange(n) < self.filled), self.schema, strict=True)]
        self.ids.write_batch(pa.record_batch(columns, schema=self.schema))
        self.filled = 0

    def close(self) -> dict:
        self._flush()
        for x in (self.ids, self.docs, *self.sinks):
            x.close()
        return {"path": self.path, "n_docs": self.n_docs, "n_tokens": self.n_tokens}


class Sequences:
    """Random access to a file's sequences; of a local file all arrays are slices of the mapped file."""

    def __init__(self, path: str):
        store, inner = _store(path)
        local = isinstance(store, pyarrow.fs.LocalFileSystem)
        self.file = pa.memory_map(inner) if local else store.open_input_file(inner)
        self.bytes = self.file.size()
        self.schema = pa.ipc.read_schema(self.file)
        self.head = self.file.tell()
        self.width, self.batch = (int(self.schema.metadata[k]) for k in (b"width", b"batch"))
        self.size = 0
        if self.bytes > self.head + 8:  # more than the end mark
            pa.ipc.read_message(self.file)
            self.size = self.file.tell() - self.head

    def _batch(self, k: int) -> pa.RecordBatch:
        self.file.seek(self.head + k * self.size)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema)

    def __len__(self) -> int:
        if not self.size:
            return 0
        batches, rest = divmod(self.bytes - self.head - 8, self.size)  # without the end mark
        return (batches - 1) * self.batch + self._batch(batches - 1).num_rows + (self._batch(batches).num_rows if rest else 0)

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """The ids and the mask of sequence i."""
        rows = self._batch(i // self.batch)
        at = (i % self.batch) * self.width
        return (rows.column(0).values.slice(at, self.width).to_numpy(zero_copy_only=True),
                rows.column(1).values.slice(at, self.width))

    def tokens(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, n in all, as slices of the batches that hold them."""
        each = self.batch * self.width
        while n > 0:
            k, at = divmod(start, each)
            m = min(n, each - at)
            yield self._batch(k).column(0).values.slice(at, m).to_numpy(zero_copy_only=True)
            start, n = start + m, n - m


# ---------------------------------------------------------------- Spark


def gathered_batches(batches: Batches, least: int = TEXT_BYTES) -> Batches:
    """The rows in batches of at least ``least`` bytes, so that a piece is looked up in few of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= least:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def write(docs: DataFrame, tokenizer: str, folder: str, end: int = END, width: int = WIDTH,
          file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes the documents' ids in ascending order of doc_id below ``folder``; the manifest, with each file's first id."""

    def work(batches: Batches) -> Batches:
        part, out = TaskContext.get().partitionId(), []
        model, file = encoder(tokenizer, end), None
        for batch in gathered_batches(batches):
            ids, counts = model.encode(batch.column(1))
            file = file or Writer(f"{folder}/{part:06d}-{len(out):04d}-{uuid.uuid4().hex[:8]}.arrow", width, model.dtype)
            file.write(batch.column(0).cast(pa.int64()), ids, counts)
            if file.n_tokens >= file_tokens:
                out.append(file.close())
                file = None
        if file:
            out.append(file.close())
        yield pa.RecordBatch.from_pylist([{"part": part, "file": i, **x} for i, x in enumerate(out)], pa.schema(
            [("part", pa.int64()), ("file", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    rows = in_order(docs.select("doc_id", "text"), "doc_id", F.xxhash64("text"))
    manifest = materialise(map_batches(rows, work, MANIFEST), "manifest")
    files, before = [], 0
    for r in sorted(manifest.collect(), key=lambda r: (r["part"], r["file"])):
        files.append((r["path"], before, r["n_docs"], r["n_tokens"]))
        before += r["n_tokens"]
    return docs.sparkSession.createDataFrame(files, "path string, start long, n_docs long, n_tokens long")


def read(manifest: DataFrame) -> DataFrame:
    """The documents of the files: doc_id, start among all ids, n_tokens, crc32 of the ids as little-endian 32-bit integers."""

    def work(batches: Batches) -> Batches:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = Sequences(path)
                store, inner = _store(path + ".docs")
                with store.open_input_stream(inner) as source:
                    for docs in pa.ipc.open_stream(source):
                        sums = []
                        for at, n in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist(), strict=True):
                            crc = 0
                            for ids in held.tokens(at, n):
                                crc = zlib.crc32(ids.astype("<u4"), crc)
                            sums.append(crc)
                        yield pa.record_batch([docs.column(0), pc.add(docs.column(1), start), docs.column(2), pa.array(sums, pa.int64())],
                                              ["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_batches(manifest.select("path", "start").repartition(parts), work,
                       "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The documents written to files in the shared folder and read back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    return read(write(docs, public_tokenizers.path(vocabulary), folder))
