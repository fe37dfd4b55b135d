"""Secret scans over an incremental blob ledger.

Every version of a document is content-addressed by the SHA-256 of its text.
The ledger is a Parquet table with one row per scan of a blob: the blob, the
rule versions (``kind@version``) that the scan ran, and the findings. A run
lists the distinct blobs of all versions, takes from the ledger what each blob
has been scanned for, runs only the pairs of blob and rule version not yet
there, appends them, and joins the findings back to every path that ever held
the blob. So a text in a thousand copies is scanned once, an unchanged text
never again, and a changed rule rescans its own kind alone.

Addresses come before bodies: a run over a ledger that has entries first joins
the distinct addresses to it, and only the rows whose address is unseen give
their bodies to a shuffle. Up to FEW unseen addresses are broadcast for that;
beyond, rows meet them in a shuffled join, which then moves all bodies once.
Copies meet by partial aggregation on the blob's address: each map task sends a
blob once at most. Paths and findings join on the address; a blob that a third
of the paths share is a skewed key that adaptive execution splits.

Findings are spans in code points, end exclusive. A rule is a regular
expression, the least length of one of its groups, and words of which one must
be there (any case) for the expression to match at all. Matches are leftmost
and non-overlapping per kind; those that fail the length are dropped after
matching.

Edge cases: a null text counts as empty; repeated rows give repeated results;
a null path is a path like any other; empty tables give empty results; other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, let, settle, whole


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base rules, in the order of the kinds.
ASSIGN = Rule("assign", 1, "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6)
ACCESS = Rule("access", 1, "AKIA[A-Z0-9]+", 0, 20)
HEX = Rule("hex", 1, "[0-9a-f]{24,}")
BASE = (ASSIGN, ACCESS, HEX)
#: What the method adds.
RULES = (*BASE, Rule("pem", 1, "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"), Rule("hub", 1, "gh[pousr]_[A-Za-z0-9]{36,}"))

#: Unseen addresses (64 characters each) that are broadcast.
FEW = 1_000_000

SPAN = "array<struct<start:int,ord:int,end:int,kind:string>>"
PIECES = "array<struct<s:int,e:int>>"


def blocks(v: Column) -> Column:
    """An array in runs as long as the square root of its size."""
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v)))).cast("int")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(v)), width), lambda at: F.slice(v, at, width))


def folded(x: Column, carry: Column, out: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """The array that a fold over ``x`` appends to; ``step(carry, element)`` gives the next carry and an array of what to append.

    The elements are folded in blocks of the square root of their number, and
    the blocks' arrays are joined: appending to one array each time would copy
    what is there for every element.
    """
    empty = F.array().cast(out)

    def put(a: Column, y: Column) -> Column:
        carried, more = step(a["carry"], y)
        return F.struct(carried.alias("carry"), F.concat(a["out"], more).alias("out"))

    def join(a: Column, block: Column) -> Column:
        inner = F.aggregate(block, F.struct(a["carry"].alias("carry"), empty.alias("out")), put)
        return let(inner, lambda i: F.struct(i["carry"].alias("carry"), F.concat(a["out"], i["out"]).alias("out")))

    start = F.struct(carry.alias("carry"), empty.alias("out"))
    return let(x, lambda v: F.aggregate(blocks(v), start, join, lambda a: a["out"]))


def spans(text: Column, rule: Rule, ord_: int) -> Column:
    """Spans of one rule. The pieces between matches and the matches give the places by their lengths."""

    def step(at: Column, y: Column) -> tuple[Column, Column]:
        end = at + y["gap"] + y["len"]
        found = F.struct((at + y["gap"]).alias("start"), F.lit(ord_).alias("ord"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        return end, F.when(y["size"] >= rule.least, F.array(found)).otherwise(F.array().cast(SPAN))

    p = F.lit(rule.pattern)
    sizes = lambda a: F.transform(a, F.length)
    gaps = sizes(F.split(text, rule.pattern))
    whole_match = sizes(F.regexp_extract_all(text, p, F.lit(0)))
    judged = sizes(F.regexp_extract_all(text, p, F.lit(rule.group))) if rule.group else whole_match
    zipped = F.zip_with(F.arrays_zip(whole_match.alias("len"), judged.alias("size")), F.slice(gaps, F.lit(1), F.size(whole_match)), lambda m, g: F.struct(g.alias("gap"), m["len"].alias("len"), m["size"].alias("size")))
    return F.when(text.rlike(rule.pattern), folded(zipped, F.lit(0), SPAN, step)).otherwise(F.array().cast(SPAN))


def versions(docs: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, blob) of every version."""
    return docs.select(F.col(path).alias("path"), F.sha2(whole(text), 256).alias("blob"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """(blob, scanned, found); empty where there is no ledger yet."""
    schema = f"blob string, scanned array<string>, found {SPAN}"
    try:
        return spark.read.schema(schema).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan(docs: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, text: str = "text") -> None:
    """Scan what the ledger lacks and append it."""
    spark = docs.sparkSession
    ids = F.array(*[F.lit(r.id) for r in rules])
    todo = unseen(docs, read_ledger(spark, ledger), ids, text)
    found = F.concat(*[F.when(F.array_contains("scanned", r.id), spans(F.col("body"), r, k)).otherwise(F.array().cast(SPAN)) for k, r in enumerate(rules)])
    todo.select("blob", "scanned", found.alias("found")).write.mode("append").parquet(ledger)


def unseen(docs: DataFrame, known: DataFrame, ids: Column, text: str = "text") -> DataFrame:
    """(blob, body, scanned: the rule versions that ``known`` lacks for it), a row for each blob that lacks any."""
    bodies = docs.select(F.sha2(whole(text), 256).alias("blob"), whole(text).alias("body"))
    if known.isEmpty():
        return bodies.groupBy("blob").agg(F.first("body").alias("body")).withColumn("scanned", ids)
    done = known.groupBy("blob").agg(F.flatten(F.collect_set("scanned")).alias("done"))
    lacks = F.array_except(ids, F.coalesce("done", F.array().cast("array<string>")))
    todo = bodies.select("blob").distinct().join(done, "blob", "left").select("blob", lacks.alias("scanned"))
    todo = broadcast_if_small(settle(todo.filter(F.size("scanned") > 0), "unseen-blobs"), FEW)
    return bodies.join(todo, "blob").groupBy("blob").agg(F.first("body").alias("body"), F.first("scanned").alias("scanned"))


def findings(spark: SparkSession, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(blob, spans by start, then kind) of the blobs in which the rules, in their given versions, have found something.

    A later rule version replaces what an earlier one found: a scan's findings
    count if the scan ran the version in force.
    """
    ids = {r.kind: r.id for r in rules}
    keep = lambda s: F.filter(F.col("found"), lambda x: F.array_contains(F.col("scanned"), F.element_at(s, x["kind"])))
    force = F.create_map(*[F.lit(y) for x in ids.items() for y in x])
    rows = read_ledger(spark, ledger).filter(F.size("found") > 0).withColumn("found", keep(force)).filter(F.size("found") > 0)
    return rows.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("spans"))


def join_paths(docs: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, path: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, blob, spans) of every version; spans are null where nothing was found."""
    return versions(docs, path, text).join(findings(docs.sparkSession, ledger, rules), "blob", "left")


def written(spans_: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans_, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(text: Column, spans_: Column, mark: str = "[SECRET]") -> Column:
    """The text with the union of the spans replaced by a mark; null spans leave it as it is."""

    def union(s: Column) -> Column:
        """The pieces of text that no span covers, each but the last before a mark: from the end of all spans so far to the next start beyond it."""

        def step(end: Column, x: Column) -> tuple[Column, Column]:
            piece = F.struct(end.alias("s"), x["start"].alias("e"))
            apart = (x["start"] > end) | ((end == 0) & (x["start"] == 0))
            return F.greatest(end, x["end"]), F.when(apart, F.array(piece)).otherwise(F.array().cast(PIECES))

        return folded(F.sort_array(s), F.lit(0), PIECES, step)

    def cut(u: Column) -> Column:
        """A run's pieces are cut from the run's part of the text, as a cut counts its place from the beginning."""

        def joined(run: Column) -> Column:
            first = F.element_at(run, 1)["s"]
            part = F.substring(text, first + 1, F.element_at(run, -1)["e"] - first)
            return let(part, lambda t: F.array_join(F.transform(run, lambda x: F.concat(F.substring(t, x["s"] - first + 1, x["e"] - x["s"]), F.lit(mark))), ""))

        last = F.array_max(F.transform(spans_, lambda x: x["end"]))
        return F.concat(F.array_join(F.transform(blocks(u), joined), ""), F.substring(text, last + 1, F.length(text)))

    return F.when(spans_.isNull() | (F.size(spans_) == 0), text).otherwise(let(union(spans_), cut))
