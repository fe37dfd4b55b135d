"""Token ids in Arrow's random-access stream files, as equal-length sequences with masks.

The documents are dealt by range of their ids and sorted within each range; a
task encodes its range with the tokenizers library, appends the end id to
every document, and writes two files:

* ``<part>-<uuid>.arrow``: record batches of ``batch`` rows (the last is
  shorter) of ``ids: fixed_size_list[length]`` and ``mask:
  fixed_size_list<bool>[length]``. The ids of the part's documents follow each
  other without a gap; only the last sequence is padded, with mask false.
* ``<part>-<uuid>.docs.arrow``: doc_id, start (within the part) and n_tokens.

As all sequences are of one length and all batches but the last of one number
of rows, a position gives its batch, row and column by division, and a reader
maps the file and touches the pages it needs without copying or decoding.
Ids are stored as uint16 where the vocabulary allows, else as uint32.

A file's name holds a fresh uuid, so the attempts of a task never write the
same file; the manifest, written as a table once all tasks are done, names the
files of those that succeeded. Lost executors cost their tasks only. The files
go to a folder that all machines share.

The library encodes each distinct chunk (white space and the text up to the
next white space) and the ids are put together from these: pre-tokenization by
the byte-level pattern never joins text across such a boundary. Texts are cut
into chunks by their bytes, a slice of some MB at a time, and each slice's
distinct chunks are looked up once. A worker keeps the ids of all chunks in
flat arrays, and begins anew after a slice with which it has over KEEP chunks,
or 16 times as many ids: a slice's bytes bound what is kept beyond. Texts that hold an added token's string, or any text
under another kind of vocabulary, are encoded whole.

The folder may be on a local or shared disk (a path or file:), hdfs:, s3: or
s3a:, gs:, abfs: or abfss:, by pyarrow's own clients; another scheme raises
before any row is read.

Edge cases: a null or empty text has the end id alone; null ids come first;
repeated ids are ordered by a hash of the text, equal rows are interchangeable;
an empty table writes no file and gives an empty result; other columns are not
read; a text of any length flows through in batches.
"""

from __future__ import annotations

import functools
import json
import os
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import BLANK
from .common import settle, slices, whole

#: One space and no other white space.
SPACED = re.compile(r" \S+")
#: By byte: ASCII white space, and the middle byte of white space that has three.
ASCII_BLANK, MIDDLE = (np.isin(np.arange(256), x) for x in ([*range(9, 14), 32], [0x9A, 0x80, 0x81]))
LENGTH, BATCH, END = 1024, 256, 0
#: Chunks that a worker keeps; rows and bytes that are encoded at once.
KEEP, ROWS, BYTES = 1 << 20, 10_000, 8 << 20
MANIFEST = "part int, file string, docs_file string, docs long, tokens long"


def place(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder or file, and its path there. Hadoop's s3a: is pyarrow's s3:."""
    if ":/" not in uri:
        return pa.fs.LocalFileSystem(), uri
    try:
        return pa.fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))
    except pa.ArrowInvalid as e:
        raise ValueError(f"{uri}: files go to a path, file:, hdfs:, s3:, s3a:, gs:, abfs: or abfss:") from e


class Library:
    """The tokenizers library behind a store of chunks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        pre = j.get("pre_tokenizer") or {}
        self.by_chunk = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not j.get("normalizer")
        self.added = [x["content"] for x in j["added_tokens"]]
        self.code = "H" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        self._empty()

    def _empty(self) -> None:
        """The store: a number for each chunk it has, and by number where its ids begin in ``flat`` and how many they are."""
        self.seen: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.dtype(self.code))
        self.starts, self.sizes, self.filled = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(chunks in some order, their ids in a row, how many each has).

        Those of one space and no other white space are encoded many at a time, a line break between them: the pattern
        makes each break a word of its own, and its id parts their ids.
        """
        spaced = list(filter(SPACED.fullmatch, chunks)) if self.line is not None else []
        rest = list(set(chunks).difference(spaced)) if len(spaced) < len(chunks) else []
        kind = np.dtype(self.code)
        flat, sizes = [], []
        for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False):
            flat.append(np.array(e.ids, kind))
            sizes.append(np.array([len(flat[-1])]))
        groups = [spaced[i : i + 1000] for i in range(0, len(spaced), 1000)]
        for e in self.tokenizer.encode_batch_fast(["\n".join(g) for g in groups], add_special_tokens=False):
            ids = np.array(e.ids, kind)
            part = ids == self.line
            sizes.append(np.diff(np.concatenate([[-1], np.flatnonzero(part), [ids.size]])) - 1)
            flat.append(ids[~part])
        none = [np.zeros(0, kind)], [np.zeros(0, np.int64)]
        return rest + spaced, np.concatenate(flat or none[0]), np.concatenate(sizes or none[1])

    def _numbers(self, chunks: list[str]) -> np.ndarray:
        """The number of each of these distinct chunks; unknown ones are learned. Room is made if the store is full."""
        if len(self.seen) > KEEP or self.filled > 16 * KEEP:
            self._empty()
        found = np.fromiter(map(self.seen.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(found < 0).tolist()
        if new:
            names, ids, sizes = self._learn([chunks[i] for i in new])
            base, top = len(self.seen), len(self.seen) + len(names)
            self.seen.update(zip(names, range(base, top), strict=True))
            self.flat, self.starts, self.sizes = grown(self.flat, self.filled + ids.size), grown(self.starts, top), grown(self.sizes, top)
            self.flat[self.filled : self.filled + ids.size] = ids
            self.sizes[base:top], self.starts[base:top] = sizes, self.filled + np.cumsum(sizes) - sizes
            self.filled += ids.size
            found[new] = [self.seen[chunks[i]] for i in new]
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, as its array's bytes."""
        if not self.by_chunk:
            return self._library(texts.to_pylist())
        marked = functools.reduce(pc.or_, [pc.match_substring(texts, a) for a in self.added], pa.array([False] * len(texts), pa.bool_()))
        aside = np.flatnonzero(marked.to_numpy(zero_copy_only=False)).tolist()
        out = self._by_chunk(pc.if_else(marked, "", texts) if aside else texts)
        for i, ids in zip(aside, self._library([texts[i].as_py() for i in aside]), strict=True):
            out[i] = ids
        return out

    def _by_chunk(self, texts: pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        texts = texts.cast(pa.large_string())
        _, places, body = texts.buffers()
        bounds = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if bounds[0] == bounds[-1]:
            return [b""] * len(texts)
        cuts = chunk_starts(np.frombuffer(body, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]) + bounds[0]
        chunks = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(np.append(cuts, bounds[-1])), body).dictionary_encode()
        distinct, codes = chunks.dictionary.to_pylist(), chunks.indices.to_numpy()
        number = self._numbers(distinct)[codes]
        runs = self.sizes[number]
        ends = np.cumsum(runs)
        at = np.arange(ends[-1]) + np.repeat(self.starts[number] - (ends - runs), runs)
        flat = self.flat
        made = flat[at].tobytes()
        edges = (np.append(0, ends)[np.searchsorted(cuts, bounds)] * flat.itemsize).tolist()
        return [made[x:y] for x, y in zip(edges, edges[1:])]


def grown(x: np.ndarray, size: int) -> np.ndarray:
    """The array with room for ``size`` values at least, and for twice as many where it had too little."""
    return x if size <= len(x) else np.concatenate([x, np.zeros(2 * size - len(x), x.dtype)])


def chunk_starts(body: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes where a text begins (``bounds``), or a run of white space that an ASCII one leads.

    A place that follows what may be a longer code of white space is left out: two chunks then count as one.
    """
    blank = ASCII_BLANK[body]
    cut = blank.copy()
    cut[1:] &= ~blank[:-1]
    cut[2:] &= body[:-2] != 0xC2
    cut[3:] &= ~(((body[:-3] >= 0xE1) & (body[:-3] <= 0xE3)) & MIDDLE[body[1:-2]])
    starts = bounds[:-1]
    cut[starts[starts < bounds[1:]]] = True
    return np.flatnonzero(cut)


@functools.cache
def library(path: str) -> Library:
    return Library(path)


def write(docs: DataFrame, vocabulary: str, folder: str, length: int = LENGTH, batch: int = BATCH, end: int = END, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files to ``folder`` and return their manifest."""
    place(folder)
    rows = docs.select(F.col(key).cast("long").alias("key"), whole(text).alias("text"))
    rows = rows.repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions("key", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib, part = library(vocabulary), TaskContext.get().partitionId()
        kind = pa.uint16() if lib.code == "H" else pa.uint32()
        schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        index = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        name = f"{folder}/{part:06d}-{uuid.uuid4().hex}"
        fs, path = place(name)
        fs.create_dir(os.path.dirname(path), recursive=True)
        files = [fs.open_output_stream(f"{path}{x}") for x in (".arrow", ".docs.arrow")]
        out, by_doc = pa.ipc.new_file(files[0], schema), pa.ipc.new_file(files[1], index)
        docs_, at, kept = 0, 0, bytearray()
        width = array(lib.code).itemsize
        full, last = length * batch * width, array(lib.code, [end]).tobytes()

        def flush(ids: bytes) -> None:
            n = len(ids) // width
            rows_ = -(-n // length)
            padded = np.zeros(rows_ * length, kind.to_pandas_dtype())
            padded[:n] = np.frombuffer(ids, padded.dtype)
            mask = np.arange(rows_ * length) < n
            out.write_batch(pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (padded, mask)], schema=schema))

        for big in batches:
            for b in slices(big, 1, ROWS, BYTES):
                starts, sizes = [], []
                for ids in lib.encode(b.column(1)):
                    starts.append(at)
                    sizes.append(len(ids) // width + 1)
                    at += sizes[-1]
                    kept += ids + last
                    while len(kept) >= full:
                        flush(bytes(kept[:full]))
                        del kept[:full]
                by_doc.write_batch(pa.RecordBatch.from_arrays([b.column(0), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=index))
                docs_ += b.num_rows
        if kept:
            flush(bytes(kept))
        for x in (out, by_doc, *files):
            x.close()
        if docs_:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [f"{name}.arrow"], "docs_file": [f"{name}.docs.arrow"], "docs": [docs_], "tokens": [at]})
        else:
            for x in (".arrow", ".docs.arrow"):
                fs.delete_file(f"{path}{x}")

    return settle(rows.mapInArrow(run, MANIFEST), "arrow-manifest")


def opened(uri: str) -> pa.ipc.RecordBatchFileReader:
    """Mapped into memory where the file system is local, else read by range."""
    fs, path = place(uri)
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(path))


class Sequences:
    """Random access to the ids of one file."""

    def __init__(self, uri: str):
        self.file = opened(uri)
        first = self.file.get_batch(0)
        self.length, self.span = first.schema.field("ids").type.list_size, first.num_rows * first.schema.field("ids").type.list_size

    def views(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, as views of the mapped batches."""
        while n:
            k, at = divmod(start, self.span)
            b = self.file.get_batch(k)
            take = min(n, b.num_rows * self.length - at)
            yield b.column(0).values[at : at + take].to_numpy(zero_copy_only=True)
            start, n = start + take, n - take

    def valid(self) -> int:
        """Ids that the masks mark."""
        return sum(self.file.get_batch(k).column(1).values.true_count for k in range(self.file.num_record_batches))


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    # one row per file; a given number of partitions is not merged into one, however short the rows
    base = manifest.withColumn("base", F.sum("tokens").over(W.orderBy("part")) - F.col("tokens"))
    rows = base.select("file", "docs_file", "tokens", "base").repartition(max(1, manifest.count()), "file")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                ids, index = Sequences(x["file"]), opened(x["docs_file"])
                if ids.valid() != x["tokens"]:
                    raise ValueError(f"{x['file']}: masks mark {ids.valid()} ids of {x['tokens']}")
                for k in range(index.num_record_batches):
                    d = index.get_batch(k)
                    sums = []
                    for start, n in zip(d.column(1).to_pylist(), d.column(2).to_pylist(), strict=True):
                        crc = 0
                        for v in ids.views(start, n):
                            crc = zlib.crc32(v.astype("<u4"), crc)
                        sums.append(crc)
                    starts = pa.array(d.column(1).to_numpy() + x["base"])
                    yield pa.RecordBatch.from_arrays([d.column(0), starts, d.column(2), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    assert sys.byteorder == "little"
    return rows.mapInArrow(run, schema)
