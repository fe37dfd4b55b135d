"""URL filter: a path-template tree per host, rejected by smoothed labelled purity.

The tree is grown level by level over the distinct (host, path) pairs, which
are pre-aggregated to page counts and counts of labelled and of bad pages. At
every level, below every template so far:

* a segment is *variable* if its parent has at least ``min_children`` distinct
  segments and the segment itself holds at most ``max_share`` of the parent's
  pages; variable segments become the wildcard ``*``;
* of the other branches, those that are *statistically similar* to their
  siblings taken together are merged into ``~``: the shape of what follows
  (nothing, a number, a word, more than one segment) differs by a total
  variation of at most ``0.2 + 1/sqrt(pages)``, and the labelled purity
  differs by at most ``z`` standard errors. A branch without labels counts as similar by its shape only if its siblings'
  labels agree (all good or all bad), so that a merge never blurs a mixed level. Every branch is compared with the pool of its
  siblings, never with each sibling, so the work is linear in the branches;
* any other segment keeps its name.

The tree grows to the last segment of every path. Where one distinct path is
left below a template, each further segment would keep its name; from level
``alone`` on such paths take all of theirs at once, so that a path of
thousands of segments costs no level of its own. A template's
bad share is smoothed towards its host's, the host's towards that of all
labelled pages: ``(bad + a * prior) / (labelled + a)``. A template is rejected
if its smoothed share is at least ``cut``.

Parents have as many rows as there are templates, children as many as distinct
segments; both come from partial aggregates, and a host with a third of all
pages is a skewed join key that adaptive execution splits.

Hosts and paths: see ``parts``. Edge cases: a null url, or one without
``://``, has an empty host and path; an empty path is the template of no
segments; repeated urls add to the counts; without any label, every template
has the prior 0 and is allowed; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, settle


#: The written policy of the registered query.
POLICY = ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")


@dataclass(frozen=True)
class Policy:
    """Fits urls of ``host`` and all its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def policies(text: Sequence[str]) -> list[Policy]:
    """``allow org/`` or ``block example.org/en/1``."""
    out = []
    for line in text:
        verdict, where = line.split(" ", 1)
        host, slash, path = where.partition("/")
        out.append(Policy(verdict, host, slash + path))
    return out


def parts(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest(rules: Sequence[Policy], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or null. Of equally long ones, block wins, then the name's order.

    The rules are a short written policy; they become one CASE expression.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block", r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


@dataclass(frozen=True)
class Tree:
    alone: int = 4
    min_children: int = 12
    max_share: float = 0.05
    distance: float = 0.2
    z: float = 2.0
    smooth: float = 4.0
    cut: float = 0.5


def shape(segs: Column, level: int) -> Column:
    """What follows level ``level``: 0 nothing, 1 a last segment that starts with a digit, 2 another last segment, 3 more."""
    nxt = F.get(segs, F.lit(level + 1))
    return F.when(nxt.isNull(), 0).when(F.get(segs, F.lit(level + 2)).isNotNull(), 3).when(nxt.rlike("^[0-9]"), 1).otherwise(2)


def templates(pages: DataFrame, t: Tree = Tree()) -> DataFrame:
    """(host, path, tpl) for every distinct host and path of ``pages`` (host, path, n, labelled, bad)."""
    rows = pages.withColumn("segs", F.slice(F.split("path", "/"), 2, F.greatest(F.lit(1), F.length("path")))).withColumn("tpl", F.lit(""))
    rows = settle(rows, "url-paths")
    deepest = rows.agg(F.max(F.size("segs"))).first()[0] or 0
    done = None
    for k in range(deepest):
        if k >= t.alone:
            rows, ended = parted(rows, k)
            done = ended if done is None else done.unionByName(ended)
            if rows.isEmpty():
                break
        seg = F.get("segs", F.lit(k))
        s = shape(F.col("segs"), k)
        here = rows.withColumn("seg", seg).withColumn("shape", s)
        kids = here.filter(F.col("seg").isNotNull()).groupBy("host", "tpl", "seg").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("lab"), F.sum("bad").alias("bad"),
            *[F.sum(F.when(F.col("shape") == i, F.col("n")).otherwise(0)).alias(f"s{i}") for i in range(4)])
        kids = settle(kids, "url-segments")
        totals = kids.groupBy("host", "tpl").agg(
            F.count("*").alias("kids"), *[F.sum(c).alias(f"p_{c}") for c in ("n", "lab", "bad", "s0", "s1", "s2", "s3")])
        both = kids.join(totals, ["host", "tpl"])
        variable = (F.col("kids") >= t.min_children) & (F.col("n") <= t.max_share * F.col("p_n"))
        tv = sum((F.abs(F.col(f"s{i}") / F.col("n") - F.col(f"p_s{i}") / F.col("p_n")) for i in range(4)), F.lit(0.0)) / 2
        p = F.col("p_bad") / F.col("p_lab")
        agree = (
            F.when(F.col("p_lab") == 0, True)
            .when(F.col("lab") == 0, (F.col("p_bad") == 0) | (F.col("p_bad") == F.col("p_lab")))
            .otherwise(F.abs(F.col("bad") / F.col("lab") - p) <= t.z * F.sqrt(p * (1 - p) / F.col("lab")))
        )
        similar = (F.col("kids") > 1) & (tv <= t.distance + 1 / F.sqrt("n")) & agree
        named = both.select("host", "tpl", "seg", F.when(variable, "*").when(similar, "~").otherwise(F.col("seg")).alias("as"))
        rows = here.join(named, ["host", "tpl", "seg"], "left").withColumn("tpl", F.when(F.col("seg").isNull(), F.col("tpl")).otherwise(F.concat("tpl", F.lit("/"), "as"))).drop("seg", "shape", "as")
        rows = settle(rows, "url-level")
    rows = rows if done is None else rows.unionByName(done)
    return rows.select("host", "path", "n", "labelled", "bad", "tpl")


def parted(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The rows whose template several paths share that go on beyond ``k`` segments, and the others, with their whole template."""
    goes_on = F.size("segs") > k
    shared = rows.filter(goes_on).groupBy("host", "tpl").agg(F.count("*").alias("paths")).filter("paths > 1")
    both = settle(rows.join(shared, ["host", "tpl"], "left").withColumn("shared", goes_on & F.col("paths").isNotNull()).drop("paths"), "url-shared")
    rest = F.concat("tpl", F.lit("/"), F.array_join(F.slice("segs", k + 1, F.greatest(F.lit(1), F.size("segs"))), "/"))
    ended = both.filter(~F.col("shared")).withColumn("tpl", F.when(goes_on, rest).otherwise(F.col("tpl")))
    return both.filter("shared").drop("shared"), ended.drop("shared")


def judged(pages: DataFrame, t: Tree = Tree()) -> DataFrame:
    """(host, path, tpl, share, verdict) for every distinct host and path of ``pages`` (host, path, bad: null if unlabelled)."""
    counts = pages.groupBy("host", "path").agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"))
    rows = templates(counts, t)
    per_tpl = rows.groupBy("host", "tpl").agg(F.sum("labelled").alias("lab"), F.sum("bad").alias("bad"))
    per_host = per_tpl.groupBy("host").agg(F.sum("lab").alias("h_lab"), F.sum("bad").alias("h_bad"))
    # the bad share of all labelled pages: one number
    prior = per_host.agg(F.when(F.coalesce(F.sum("h_lab"), F.lit(0)) > 0, F.sum("h_bad") / F.sum("h_lab")).otherwise(0.0).alias("prior")).scalar()
    hosts = per_host.withColumn("prior", prior).select("host", ((F.col("h_bad") + t.smooth * F.col("prior")) / (F.col("h_lab") + t.smooth)).alias("h_share"))
    share = (F.col("bad") + t.smooth * F.col("h_share")) / (F.col("lab") + t.smooth)
    verdicts = per_tpl.join(hosts, "host").select("host", "tpl", share.alias("share"), F.when(share >= t.cut, "block").otherwise("allow").alias("verdict"))
    return rows.select("host", "path", "tpl").join(verdicts, ["host", "tpl"])
