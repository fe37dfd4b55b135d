"""Quality rules as a short-circuit cascade.

Every rule is a native boolean expression over one document. On a bounded
sample the cascade measures what each rule costs (wall time of evaluating it
alone, less the time of reading the sample) and which documents it rejects;
then it orders the rules greedily by conditional rejections per cost: of the
documents that the rules so far let pass, how many does the next one reject
for each second. The verdict is a chain of CASE branches in that order, so a
document meets the dear rules only if the cheap and selective ones let it
pass. The words, which most rules need, are split once for all of a document's
rules. The order changes cost only; a document is kept if and only if no rule
rejects it, so the verdicts do not depend on the sample.

Edge cases: a null text counts as empty (no words, hence rejected by
``min_words``); repeated rows are judged one by one; an empty table gives an
empty result (the order is then the declared one); other columns pass through
untouched.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, settle, whole, words

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS + "+", ""))).cast("long")


def lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")


def n_lines(text: Column) -> Column:
    return F.size(lines(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    return let(lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(w: Column) -> Column:
    """Words in windows of WINDOW words that occur twice or more in the text.

    Hashes of the windows tell the texts without any repeat (equal windows have
    equal hashes); the others compare the windows themselves.
    """

    def starts(w: Column) -> Column:
        return F.sequence(F.lit(0), F.size(w) - WINDOW)

    def at(w: Column, i: Column) -> list[Column]:
        return [F.get(w, i + k) for k in range(WINDOW)]

    def repeats(w: Column) -> Column:
        return F.size(F.array_distinct(F.transform(starts(w), lambda i: F.xxhash64(*at(w, i))))) < F.size(w) - WINDOW + 1

    def covered(w: Column) -> Column:
        grams = F.sort_array(F.transform(starts(w), lambda i: F.struct(F.concat_ws(" ", *at(w, i)).alias("g"), i.alias("i"))))

        def twice(s: Column) -> Column:
            g = lambda j: F.get(s, j)["g"]
            hit = F.transform(s, lambda x, j: F.when(F.coalesce(x["g"] == g(j - 1), F.lit(False)) | F.coalesce(x["g"] == g(j + 1), F.lit(False)), x["i"]))
            return F.sort_array(F.array_compact(hit))

        def span(p: Column) -> Column:
            gaps = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
            return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

        return let(let(grams, twice), span)

    def count(w: Column) -> Column:
        return F.when((F.size(w) > WINDOW) & repeats(w), covered(w)).otherwise(F.lit(0))

    return count(w).cast("long")


#: Measures of the text, and of its words.
OF_TEXT = {"n_symbols": n_symbols, "n_lines": n_lines, "n_dup_lines": n_dup_lines}
OF_WORDS = {
    "n_words": lambda w: F.size(w).cast("long"),
    "word_chars": lambda w: F.length(F.array_join(w, "")).cast("long"),
    "n_repeat_words": n_repeat_words,
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


class Measures:
    """The measures by name: as expressions of a text and its words, or as columns where they have been computed."""

    def __init__(self, text: Column | None = None, split: Column | None = None):
        self.text, self.split = text, split

    def __getattr__(self, name: str) -> Column:
        if self.text is None:
            return F.col(name)
        return OF_TEXT[name](self.text) if name in OF_TEXT else OF_WORDS[name](self.split)


def measured(text: Column, body: Callable[[Measures], Column]) -> Column:
    """``body`` of the text's measures, for which its words are split once."""
    return let(words(text), lambda w: body(Measures(text, w)))


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps Measures to a boolean column."""

    name: str
    rejects: Callable[[Measures], Column]


def base_rules() -> list[Rule]:
    return [
        Rule("min_words", lambda m: m.n_words < 10),
        Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 20 * m.n_words),
    ]


def method_rules() -> list[Rule]:
    """Rules beyond the base: shares over the whole text."""
    return [
        Rule("symbols", lambda m: 100 * m.n_symbols > 10 * m.word_chars),
        Rule("word_length", lambda m: (m.word_chars < 2 * m.n_words) | (m.word_chars > 20 * m.n_words)),
        Rule("duplicate_lines", lambda m: 100 * m.n_dup_lines > 40 * m.n_lines),
    ]


def estimate(docs: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = 1000, fraction: float = 0.02,
             seed: int = 7, runs: int = 3) -> tuple[dict[str, float], dict[int, int]]:
    """Seconds of each rule on the sample, and how many sampled documents each set of rules (a bit mask) rejects.

    The sample has at most ``sample_rows`` rows, drawn from all of the table. A
    rule's cost is the least of ``runs`` timings, less that of splitting the
    words, which all rules share; the driver gets one row per mask that occurs.
    """
    sample = docs.select(whole(text).alias("t")).sample(fraction, seed).orderBy(F.rand(seed)).limit(sample_rows)
    sample = settle(sample, "quality-sample")
    t = F.col("t")

    def once(e: Column) -> float:
        began = time.perf_counter()
        sample.agg(F.count_if(e)).collect()
        return time.perf_counter() - began

    def seconds(body: Callable[[Measures], Column]) -> float:
        return min(once(measured(t, body)) for _ in range(runs))

    idle = seconds(lambda m: m.n_words < 0)
    cost = {r.name: max(1e-4, seconds(r.rejects) - idle) for r in rules}
    mask = measured(t, lambda m: sum((F.when(r.rejects(m), F.lit(1 << k)).otherwise(F.lit(0)) for k, r in enumerate(rules)), F.lit(0)))
    return cost, {x["m"]: x["n"] for x in sample.groupBy(mask.alias("m")).agg(F.count("*").alias("n")).collect()}


def order(rules: Sequence[Rule], cost: dict[str, float], masks: dict[int, int]) -> list[Rule]:
    """Greedy order by rejections among the survivors per second; ties (such as no rejections) by lower cost, then as declared."""
    left, out, alive = list(enumerate(rules)), [], dict(masks)
    while left:
        hits = {k: sum(n for m, n in alive.items() if m >> k & 1) for k, _ in left}
        k, rule = min(left, key=lambda x: (-hits[x[0]] / cost[x[1].name], cost[x[1].name], x[0]))
        out.append(rule)
        left.remove((k, rule))
        alive = {m: n for m, n in alive.items() if not m >> k & 1}
    return out


def cascade(rules: Sequence[Rule], m: Measures) -> Column:
    """Name of the first rule, in the given order, that rejects the document; null if none does."""
    first = F.lit(None).cast("string")
    for r in reversed(rules):
        first = F.when(r.rejects(m), F.lit(r.name)).otherwise(first)
    return first


def planned(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> list[Rule]:
    rules = list(rules if rules is not None else base_rules() + method_rules())
    return order(rules, *estimate(docs, rules, text))


def keep(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    rules = planned(docs, rules, text)
    return docs.filter(measured(whole(text), lambda m: cascade(rules, m)).isNull())
