"""Toxicity by Levenshtein automata on a lexicon trie, with scores of the context window.

Learning (labelled rows outside the held-out fold; a bounded sample of at most
``sample`` documents, least hash of the id first, equal texts once):

1. Words are counted by the label of their documents, and with them their
   prefixes; the terms of the lexicon are the prefixes that are far more frequent in toxic
   documents, each in its longest form that keeps nearly all of its count. A
   term is closed (a whole word) or open (any ending follows, as in inflected
   languages). A term has any length: prefixes are counted up to ``most``
   letters, longer words whole. As each term is in ``share`` of the sampled
   toxic documents, the sample bounds their number.
2. Hits on the same documents give the features below; a logistic
   regression on them gives the score.

Matching: the terms make a trie; its product with the Levenshtein automaton
(substitution, insertion, deletion; one edit from 5 letters on, two from 9) is
determinised as words are read, and each step is remembered, so a word costs a
table look-up per letter and most words die after a few.

Context: a hit's window are the ``window`` words on either side. Quotation
marks that open or close a word and words of reporting speak for quotation,
words of address for abuse; the window's score is the logistic function of
their difference, and a hit counts as abuse by that score and as quotation by
the rest.

Edge cases: a null or empty text has no hit and gets the score of such texts;
labels that are null are left out, and of several labels of one document the
greatest counts; without labels of both kinds the lexicon is empty and each
score is the share of toxic labels (0 if none); repeated rows are scored one by
one; rows without an id are scored, never learned from; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, whole, words

#: Marks of quotation, words of reporting and of address.
MARKS = "\"'`“”„‘’«»‹›"
REPORT = frozenset("said says say called quoted quote wrote writes reported dit disait écrit cité appelé sagte sagt schrieb zitierte nannte dijo dice escribió citó llamó".split())
ADDRESS = frozenset("you your you're youre u tu vous toi votre du ihr dich dein sie usted ustedes eres te".split())
#: Texts scored at once.
ROWS = 500
EDGE = re.compile(r"^\W+|\W+$")
STATES, KEEP = 1 << 16, 1 << 19


@dataclass(frozen=True)
class Learn:
    sample: int = 8_000
    most: int = 64  # letters of a prefix
    support: int = 5  # toxic documents at least, and
    share: float = 0.01  # of all toxic documents
    odds: float = 3.0
    window: int = 8
    ridge: float = 1.0


@dataclass
class Trie:
    """Terms as (text, open). Nodes are numbers; ``limit`` is the greatest number of edits of a term below."""

    terms: list[tuple[str, bool]]
    kids: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: dict[int, int] = field(default_factory=dict)
    limit: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self) -> None:
        for k, (text, _) in enumerate(self.terms):
            node, edits = 0, allowed(text)
            self.limit[0] = max(self.limit[0], edits)
            for c in text:
                if c not in self.kids[node]:
                    self.kids[node][c] = len(self.kids)
                    self.kids.append({})
                    self.limit.append(0)
                node = self.kids[node][c]
                self.limit[node] = max(self.limit[node], edits)
            self.ends[node] = k


def allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Matcher:
    """The trie times the Levenshtein automaton, determinised step by step.

    A state is a set of (node, edits); states are numbered as they are met, and
    state 0 is the empty one. ``open[s]`` and ``closed[s]`` tell the best term
    that ends in s with any ending to follow, and as a whole word.
    """

    def __init__(self, terms: list[tuple[str, bool]]):
        self.trie = Trie(terms)
        self.tokens: dict[str, tuple[int, int] | None] = {}
        self._reset()

    def _reset(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.open: list[tuple[int, int] | None] = []
        self.closed: list[tuple[int, int] | None] = []
        self._state(frozenset())
        self.start = self._state(self._closure({0: 0}))

    def _state(self, found: frozenset) -> int:
        s = self.number.get(found)
        if s is None:
            s = self.number[found] = len(self.sets)
            self.sets.append(found)
            self.steps.append({})
            self.open.append(self._ending(found, True))
            self.closed.append(self._ending(found, False))
        return s

    def _closure(self, found: dict[int, int]) -> frozenset:
        """Deletions: a letter of the term that the word lacks."""
        todo = list(found)
        while todo:
            node = todo.pop()
            e = found[node] + 1
            for kid in self.trie.kids[node].values():
                if e <= self.trie.limit[kid] and e < found.get(kid, 99):
                    found[kid] = e
                    todo.append(kid)
        return frozenset(found.items())

    def _step(self, s: int, c: str) -> int:
        out: dict[int, int] = {}
        for node, e in self.sets[s]:
            if e + 1 <= self.trie.limit[node] and e + 1 < out.get(node, 99):
                out[node] = e + 1  # insertion
            for k, kid in self.trie.kids[node].items():
                cost = e + (k != c)
                if cost <= self.trie.limit[kid] and cost < out.get(kid, 99):
                    out[kid] = cost
        return self._state(self._closure(out))

    def _ending(self, found: frozenset, open_: bool) -> tuple[int, int] | None:
        """(edits, term) of the best term that ends here."""
        hits = [(e, k) for node, e in found if (k := self.trie.ends.get(node)) is not None and self.trie.terms[k][1] == open_ and e <= allowed(self.trie.terms[k][0])]
        return min(hits, default=None)

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the best term that the word matches, or None."""
        if len(self.sets) >= STATES:
            self._reset()
        s, best, steps, open_ = self.start, None, self.steps, self.open
        for c in word:
            nxt = steps[s].get(c)
            if nxt is None:
                nxt = steps[s][c] = self._step(s, c)
            s = nxt
            if not s:
                return best
            if (hit := open_[s]) and (best is None or hit < best):
                best = hit
        hit = self.closed[s]
        return hit if hit and (best is None or hit < best) else best

    def token(self, raw: str) -> tuple[int, int] | None:
        """The match of a word of a text, without the marks at its ends and in lower case."""
        found = self.match(EDGE.sub("", raw.lower()))
        if len(raw) < 40:
            if len(self.tokens) >= KEEP:
                self.tokens.clear()
            self.tokens[raw] = found
        return found


def features(text: str | None, m: Matcher, window: int) -> list[float]:
    """Of exact and of misspelled hits: their weight as abuse, as quotation; the share of hits among the words; any hit."""
    raw, seen = (text or "").split(), m.tokens
    hits = [(i, h) for i, w in enumerate(raw) if (h := seen[w] if w in seen else m.token(w))]
    sums = [0.0] * 4
    for i, (edits, _) in hits:
        near = raw[max(0, i - window) : i + window + 1]
        marks = sum((x[0] in MARKS) + (x[-1] in MARKS) for x in near)
        bare = [EDGE.sub("", x.lower()) for x in near]
        quotes = marks + sum(x in REPORT for x in bare) - sum(x in ADDRESS for x in bare)
        abuse = 1 / (1 + np.exp(quotes - 2.0))
        sums[2 * (edits > 0)] += abuse
        sums[2 * (edits > 0) + 1] += 1 - abuse
    return [*np.log1p(sums), len(hits) / max(1, len(raw)), float(bool(hits)), float(any(h[0] == 0 for _, h in hits))]


N_FEATURES = 7


@dataclass(frozen=True)
class Model:
    terms: tuple[tuple[str, bool], ...]
    weights: tuple[float, ...]  # intercept first
    window: int

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([features(t, matcher(self.terms), self.window) for t in texts]).reshape(len(texts), N_FEATURES)
        return logistic(self.weights[0] + x @ np.array(self.weights[1:]))


_MATCHERS: dict[tuple, Matcher] = {}


def matcher(terms: tuple[tuple[str, bool], ...]) -> Matcher:
    if terms not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[terms] = Matcher(list(terms))
    return _MATCHERS[terms]


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Logistic regression by Newton steps; the intercept is not shrunk."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, shrink = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    shrink[0, 0] = 1e-6
    for _ in range(50):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink, x.T @ (y - p) - shrink @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def sample(docs: DataFrame, labels: DataFrame, learn: Learn) -> DataFrame:
    """(y, text) of at most ``learn.sample`` labelled documents. docs: doc_id, text; labels: doc_id, y."""
    ids = labels.filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(learn.sample)  # the bound of what is broadcast
    return settle(docs.join(F.broadcast(settle(ids, "toxic-ids")), "doc_id").groupBy(whole("text").alias("text")).agg(F.max("y").alias("y")).select("y", "text"), "toxic-sample")


def lexicon(rows: DataFrame, learn: Learn) -> list[tuple[str, bool]]:
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return []
    bare = F.transform(words(F.col("text")), lambda w: F.regexp_replace(F.lower(w), "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", ""))
    by_word = rows.select("y", F.explode(F.array_distinct(bare)).alias("w")).groupBy("w").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    size = F.length("w")
    cut = F.explode(F.array_union(F.sequence(F.lit(1), F.least(size, F.lit(learn.most))), F.array(size))).alias("k")
    prefixes = by_word.filter(size > 0).select("w", "t", "c", cut).select(F.substring("w", F.lit(1), F.col("k")).alias("p"), "t", "c", (size == F.col("k")).alias("end"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    found = prefixes.groupBy("p").agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.sum(F.when(F.col("end"), F.col("t")).otherwise(0)).alias("whole")).filter(F.col("t") >= max(learn.support, learn.share * toxic)).withColumn("odds", odds).filter(F.col("odds") >= learn.odds)
    return chosen({r["p"]: (r["t"], r["whole"]) for r in found.collect()})  # prefixes in a share of the sample's toxic documents each


def chosen(found: dict[str, tuple[int, int]]) -> list[tuple[str, bool]]:
    """Of each shortest prefix, its longest form with nearly all of its count; the most frequent terms first."""
    out: dict[str, tuple[int, bool]] = {}
    grown: dict[str, list[str]] = {}
    for p in sorted(found):
        grown.setdefault(p[:-1], []).append(p)
    roots = [p for p in sorted(found) if p[:-1] not in found]
    for root in roots:
        term = root
        while True:
            longer = [p for p in grown.get(term, ()) if found[p][0] >= 0.9 * found[term][0]]
            if not longer or found[term][1] >= 0.9 * found[term][0]:
                break
            term = longer[0]
        out[term] = (found[term][0], found[term][1] < 0.9 * found[term][0])
    return [(p, out[p][1]) for p in sorted(out, key=lambda p: (-out[p][0], p))]


def train(docs: DataFrame, labels: DataFrame, learn: Learn = Learn()) -> Model:
    """docs: doc_id, text; labels: doc_id, y (0 or 1), without the held-out fold."""
    rows = sample(docs, labels, learn)
    terms = tuple(lexicon(rows, learn))
    window = learn.window

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            x = [features(t, matcher(terms), window) for t in p["text"]]
            yield pd.DataFrame({"y": p["y"], "x": x})

    got = rows.mapInPandas(measure, "y int, x array<double>").toPandas() if terms else rows.select("y").toPandas()
    if not len(got):
        return Model((), (-30.0, *[0.0] * N_FEATURES), window)
    y = got["y"].to_numpy(float)
    if not terms:
        p = min(max(y.mean(), 1e-9), 1 - 1e-9)
        return Model((), (float(np.log(p / (1 - p))), *[0.0] * N_FEATURES), window)
    order = np.lexsort(np.array(got["x"].tolist()).T)  # the same sums whatever the order of the rows
    return Model(terms, tuple(fit(np.array(got["x"].tolist())[order], y[order], learn.ridge).tolist()), window)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for big in parts:
            for at in range(0, len(big), ROWS):
                p = big.iloc[at : at + ROWS]
                yield pd.DataFrame({"doc_id": p["doc_id"].astype("Int64"), "score": model.scores(p["text"].tolist())})

    return rows.mapInPandas(run, "doc_id long, score double")
