"""Token counts by heap-and-linked-list byte-pair merging, without identifiers.

A pre-split word begins as one symbol per byte, in a doubly linked list. A heap
holds every adjacent pair that the vocabulary merges, keyed by rank and place.
The lowest is popped again and again: unless one of its symbols has changed
since, the two become one, and the pairs with both neighbours enter the heap.
A word of b bytes takes O(b log b), however long. Its count is its symbols at
the start minus its merges; no ids are put together or emitted.

Texts are cut into chunks (white space and what follows up to the next white
space) by their bytes, as no pre-split word crosses such a boundary. Each
distinct chunk of a slice of rows is counted once, and each worker keeps the
counts of the short chunks it used last in a store bounded by their number and
length. Rows travel in slices of bounded bytes, and a text longer than a slice
in pieces that end where a chunk ends.

Edge cases: a null or empty text has no bytes and no tokens; an added token's
string inside a text is one token, as the library has it by default; a null key
is kept; repeated rows give repeated results; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .arrowtokens import chunk_starts
from .bpe import BLANK, PATTERN, Store, alphabet
from .common import slices, whole

#: Chunks that a worker keeps, and the longest that it keeps (characters).
KEEP, KEPT_LENGTH = 1 << 20, 48
#: Rows and bytes that are counted at once.
ROWS, BYTES = 10_000, 8 << 20
#: A place that a text can be cut before its second character.
EDGE = re.compile(f"[^{BLANK}][{BLANK}]")
PLACE = 40


class Merger:
    """Merges of one byte-level BPE vocabulary in the tokenizers library's JSON form."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        model, pre = j["model"], j.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or j.get("normalizer") or model.get("ignore_merges"):
            raise ValueError(f"{path}: not a byte-level BPE vocabulary without prefix space, normaliser or ignored merges")
        if any(a.get(k) for a in j["added_tokens"] for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError(f"{path}: added tokens that take in white space or whole words only")
        vocab = model["vocab"]
        #: byte: symbol; and pair of symbols: rank and merged symbol
        self.symbol = [0] * 256
        for c, b in alphabet().items():
            self.symbol[b] = vocab[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merged = [vocab[a + b] for a, b in pairs]
        self.rank = {vocab[a] << 32 | vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.words = regex.compile(PATTERN)
        self.added = [a["content"] for a in j["added_tokens"]]
        self.marks = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.store = Store(KEEP)

    def word(self, w: bytes) -> int:
        """Tokens of a pre-split word."""
        n, rank, merged = len(w), self.rank, self.merged
        if n < 2:
            return n
        at = list(map(self.symbol.__getitem__, w))
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [r << PLACE | i for i in range(n - 1) if (r := rank.get(at[i] << 32 | at[i + 1])) is not None]
        heapify(heap)
        merges = 0
        while heap:
            top = heappop(heap)
            r, i = top >> PLACE, top & (1 << PLACE) - 1
            k = after[i]
            if at[i] < 0 or k < 0 or rank.get(at[i] << 32 | at[k]) != r:
                continue  # one of the two has merged meanwhile
            at[i], at[k] = merged[r], -1
            merges += 1
            k = after[i] = after[k]
            if k >= 0:
                before[k] = i
                if (r := rank.get(at[i] << 32 | at[k])) is not None:
                    heappush(heap, r << PLACE | i)
            if (k := before[i]) >= 0 and (r := rank.get(at[k] << 32 | at[i])) is not None:
                heappush(heap, r << PLACE | k)
        return n - merges

    def chunk(self, chunk: str) -> int:
        got = self.store.get(chunk)
        if got is None:
            parts = self.words.findall(chunk)
            got = self.word(chunk.encode()) if len(parts) == 1 else sum(map(self._part, parts))
            if len(chunk) <= KEPT_LENGTH:
                self.store.put(chunk, got)
        return got

    def _part(self, w: str) -> int:
        got = self.store.get(w)
        return self.word(w.encode()) if got is None else got

    def plain(self, texts: pa.LargeStringArray) -> np.ndarray:
        """Tokens of each text; added tokens' strings count as plain text."""
        if not len(texts):
            return np.zeros(0, np.int64)
        _, places, body = texts.buffers()
        bounds = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if bounds[0] == bounds[-1]:
            return np.zeros(len(texts), np.int64)
        cuts = chunk_starts(np.frombuffer(body, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]) + bounds[0]
        chunks = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(np.append(cuts, bounds[-1])), body).dictionary_encode()
        distinct = chunks.dictionary.to_pylist()
        counts = np.fromiter(map(self.chunk, distinct), np.int64, len(distinct))
        running = np.append(0, np.cumsum(counts[chunks.indices.to_numpy()]))
        return np.diff(running[np.searchsorted(cuts, bounds)])

    def counts(self, texts: pa.LargeStringArray) -> np.ndarray:
        """Tokens of each text, as the library counts them."""
        apart = pc.greater(pc.binary_length(texts), BYTES)
        for a in self.added:
            apart = pc.or_(apart, pc.match_substring(texts, a))
        out = self.plain(pc.if_else(apart, pa.scalar("", pa.large_string()), texts))
        for i in np.flatnonzero(apart.to_numpy(zero_copy_only=False)).tolist():
            out[i] = sum(self._apart(texts[i].as_py()))
        return out

    def _apart(self, text: str) -> Iterator[int]:
        at = 0
        for m in self.marks.finditer(text) if self.marks else ():
            yield from map(self._piece, pieces(text, at, m.start()))
            yield 1
            at = m.end()
        yield from map(self._piece, pieces(text, at, len(text)))

    def _piece(self, piece: str) -> int:
        return int(self.plain(pa.array([piece], pa.large_string()))[0])


def pieces(text: str, at: int, end: int) -> Iterator[str]:
    """The text from ``at`` to ``end`` in pieces of about BYTES / 4 characters, cut where chunks end."""
    while end - at > BYTES // 4:
        m = EDGE.search(text, at + BYTES // 4 - 2, end)
        if m is None:
            break
        yield text[at : m.start() + 1]
        at = m.start() + 1
    yield text[at:end]


@functools.cache
def merger(path: str) -> Merger:
    return Merger(path)


def count(docs: DataFrame, vocabulary: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes of the text's UTF-8, n_tokens, over_limit: more tokens than ``limit``) per row."""
    docs = docs.select(F.col(key).alias("key"), whole(text).alias("text"))
    schema = T.StructType([docs.schema["key"], *T.StructType.fromDDL("n_bytes long, n_tokens long, over_limit boolean")])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(vocabulary)
        for big in batches:
            for b in slices(big, 1, ROWS, BYTES):
                texts = b.column(1).cast(pa.large_string())
                n = m.counts(texts)
                yield pa.RecordBatch.from_arrays([b.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n), pa.array(n > limit)], schema=arrow)

    return docs.mapInArrow(run, schema).withColumnRenamed("key", key)
