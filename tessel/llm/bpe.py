"""BPE encoding and decoding by a deterministic tokenization automaton.

The automaton reads tokens and accepts exactly the token sequences that BPE
yields. It is compiled by one gadget per merge, in merge order (Berglund,
Martens and van der Merwe, "Constructing a BPE tokenization DFA", 2024). It
starts with one state in which every byte leads back to itself. The gadget of
the merge ``u v -> uv`` takes the states that have an arc ``u`` to a state p
with an arc ``v``: their arc ``u`` is led to a copy of p without ``v``, and
they get an arc ``uv`` to where ``v`` led.

All arcs of one label lead to one state, so the table holds that target per
label, and per state its origin: the state it copies, the label it lacks, and
the number of the gadget that made it. Whether a state has an arc follows from
these: an arc older than the state is there unless the state, or one that it
copies, lacks it; a newer arc ``uv`` is there if the arc ``u`` was when the
gadget added it.

Encoding: a text is split into words by the vocabulary's pattern; within a
word, the table leads from state to state, by the longest label that has an arc, and
back where there is no way on (each prefix of a word has one token sequence, so a place
that led nowhere is never entered again).
Decoding emits the labels of the arcs: the bytes of each token.

Texts are encoded by chunks (white space and what follows up to the next white
space), as no word crosses such a boundary; each worker keeps the ids of the
chunks it used last, in a store of bounded size.
"""

from __future__ import annotations

import functools
import json
import re
import sys
from array import array
from collections.abc import Iterator

import regex
from pyspark.sql import DataFrame

#: The byte-level alphabet maps printable Latin-1 bytes to themselves and the others to 256 and up, in order.
PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: The vocabulary's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as the pattern's engine has it (Unicode White_Space).
BLANK = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space and what follows up to the next white space; the pattern's words cross no such boundary.
CHUNKS = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
#: Chunks that a worker keeps, half of them in each generation.
KEEP = 1 << 19


def alphabet() -> dict[str, int]:
    rest = [b for b in range(256) if b not in set(PLAIN)]
    return {chr(b): b for b in PLAIN} | {chr(256 + k): b for k, b in enumerate(rest)}


class Automaton:
    """``labels[t]``: the bytes of token t. ``target[t]``: the state that arcs labelled t lead to."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.labels = labels
        #: every prefix of a label: the label's token, or -1 if it is a prefix only
        self.steps = {b[:k]: -1 for b in labels.values() for k in range(1, len(b))}
        self.steps |= {b: t for t, b in labels.items()}
        #: token: number of the gadget that adds its arcs, and the label those arcs grow from
        self.born, self.left = dict.fromkeys(labels, 0), {}
        self.target = dict.fromkeys(labels, 0)
        #: state: the state it copies, the label it lacks, the number of its gadget; state 0 copies none
        self.copied, self.lacks, self.made = [-1], [-1], [0]
        #: label: {state made without it: its gadget}
        self.without: dict[int, dict[int, int]] = {}
        for n, (u, v, uv) in enumerate(merges, 1):
            self._gadget(n, u, v, uv)
        #: state: its own chain back to state 0, filled on first use
        self._chains: dict[int, dict[int, int]] = {0: {}}
        self._arcs: dict[int, bool] = {}

    def _gadget(self, n: int, u: int, v: int, uv: int) -> None:
        p = self.target[u]
        after = self.target[v]
        self.copied.append(p)
        self.lacks.append(v)
        self.made.append(n)
        self.target[u] = len(self.copied) - 1
        self.target[uv], self.born[uv], self.left[uv] = after, n, u

    def _lack(self, state: int) -> dict[int, int]:
        """The labels that the state has lost, each with the gadget that took it."""
        got = self._chains.get(state)
        if got is None:
            path, s = [], state
            while s > 0:
                path.append(s)
                s = self.copied[s]
            got = self._chains[state] = {self.lacks[s]: self.made[s] for s in path}
        return got

    def has(self, state: int, token: int) -> bool:
        """Is there an arc from the state?"""
        key = state << 32 | token
        got = self._arcs.get(key)
        if got is None:
            lack, t, until = self._lack(state), token, sys.maxsize - 1
            got = True
            while True:
                if lack.get(t, sys.maxsize) <= until:
                    got = False
                    break
                until = self.born[t]
                if t not in self.left:
                    break
                t = self.left[t]
            if len(self._arcs) > 4 * KEEP:
                self._arcs.clear()
            self._arcs[key] = got
        return got

    def word(self, w: bytes) -> list[int]:
        """The tokens of a pre-split word: the only way through the automaton that spells it.

        Longest labels first; a place once reached is not entered again, as a
        prefix has one token sequence and so leads to one state.
        """
        steps, target, has, arcs, n = self.steps, self.target, self.has, self._arcs, len(w)
        out: list[int] = []
        open_: list[tuple[int, int, list[tuple[int, int]]]] = []
        at, state, dead = 0, 0, set()
        while at < n:
            labels = []
            for end in range(at + 1, n + 1):
                t = steps.get(w[at:end])
                if t is None:
                    break
                if t >= 0:
                    labels.append((end, t))
            while True:
                while labels:
                    end, t = labels.pop()
                    if end in dead:
                        continue
                    arc = arcs.get(state << 32 | t)
                    if has(state, t) if arc is None else arc:
                        break
                else:  # no way on from here
                    at, state, labels = open_.pop()
                    out.pop()
                    continue
                break
            open_.append((at, state, labels))
            out.append(t)
            at, state = end, target[t]
            dead.add(end)
        return out


class Store:
    """Ids by text, in two generations: when the younger is full, the older goes. What is used again moves to the younger."""

    def __init__(self, size: int):
        self.half, self.young, self.old = size // 2, {}, {}

    def get(self, key: str) -> bytes | None:
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self.put(key, got)
        return got

    def put(self, key: str, ids: bytes) -> None:
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[key] = ids


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        model, byte = j["model"], alphabet()
        special = {x["content"]: x["id"] for x in j["added_tokens"]}
        labels = {t: bytes(byte[c] for c in s) for s, t in model["vocab"].items() if s not in special}
        ids = {s: t for s, t in model["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.automaton = Automaton(labels, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        self.labels = labels | {t: s.encode() for s, t in special.items()}
        self.special = special
        self.words = regex.compile(PATTERN)
        self.marks = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.seen, self.of_words = Store(KEEP), Store(KEEP // 4)

    def _word(self, w: str) -> bytes:
        return array("I", self.automaton.word(w.encode())).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """The ids of a chunk that the younger generation may lack."""
        out = self.seen.get(chunk)
        if out is not None:
            return out
        words = self.words.findall(chunk)
        if len(words) == 1:
            out = self._word(chunk)
        else:
            parts = []
            for w in words:
                got = self.of_words.get(w)
                if got is None:
                    got = self.seen.get(w) or self._word(w)
                    if len(w) < 64:
                        self.of_words.put(w, got)
                parts.append(got)
            out = b"".join(parts)
        if len(chunk) < 64:
            self.seen.put(chunk, out)
        return out

    def _plain(self, text: str, out: list[bytes]) -> None:
        get, chunk = self.seen.young.get, self._chunk
        out += [get(c) or chunk(c) for c in CHUNKS.findall(text)]

    def encode(self, text: str) -> array:
        """The ids. The added tokens' strings in a text become their ids."""
        out: list[bytes] = []
        at = 0
        if self.marks and any(s in text for s in self.special):
            for m in self.marks.finditer(text):
                self._plain(text[at : m.start()], out)
                out.append(array("I", [self.special[m[0]]]).tobytes())
                at = m.end()
            text = text[at:]
        self._plain(text, out)
        return array("I", b"".join(out))

    def decode(self, ids: array) -> str:
        """The labels of the arcs, as text."""
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", errors="replace")


@functools.cache
def codec(path: str) -> Codec:
    """One compiled automaton for each worker process."""
    return Codec(path)


def little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def encoded(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids: little-endian unsigned 32-bit integers, decoded) per row; a null text counts as empty."""
    return _mapped(docs, vocabulary, key, text, "ids binary, decoded string", lambda ids, c: (little_endian(ids), c.decode(ids)))


def digests(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) per row.

    Edge cases: a null or empty text has no tokens and the digests of nothing;
    repeated rows give repeated results; a null key is kept; other columns are
    not read; a text of any length is encoded chunk by chunk.
    """
    from hashlib import sha256

    def row(ids: array, c: Codec) -> tuple:
        return len(ids), sha256(little_endian(ids)).hexdigest(), sha256(c.decode(ids).encode()).hexdigest()

    return _mapped(docs, vocabulary, key, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", row)


def _mapped(docs: DataFrame, vocabulary: str, key: str, text: str, fields: str, row) -> DataFrame:
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    from pyspark.sql import functions as F

    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([docs.schema["key"], *T.StructType.fromDDL(fields)])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for big in batches:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                out = [row(c.encode(t or ""), c) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, f.type) for x, f in zip(zip(*out), list(arrow)[1:], strict=True)]], schema=arrow)

    return docs.mapInArrow(run, schema).withColumnRenamed("key", key)
