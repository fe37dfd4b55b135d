"""The registered queries opN_<name>: each operator on its whole table, with the columns its contract asks for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import ann, arrowtokens, bpe, divergence, katz, mixing, quality, secrets, ssjoin, tokencounts, toxicity, urlfilter, whitening
from .common import settle, table, whole, words
from .oracle import ORACLE

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def fold(n: int) -> Column:
    """crc32 of the id as text, mod n; null without an id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents").select("doc_id", "text"), F.coalesce(fold(4) == 2, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held).select("doc_id", F.col("toxic").cast("int").alias("y"))
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.size(words(whole("text"))).cast("long").alias("size"), F.md5(whole("text")).alias("text_hash"))
    rows = mixing.mix(settle(docs, "mix-sizes"), F.col("doc_id"), F.col("source"), F.col("size"), F.col("text_hash"))
    return rows.select("row.doc_id", *[F.col(f"plan.{c}") for c in ("size", "source_size", "target", "taken")])


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"), fold(10) == 0)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ledger = table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "ledger")
    secrets.scan(docs, ledger)
    rows = secrets.join_paths(docs, ledger)
    of = lambda *kinds: F.filter("spans", lambda x: x["kind"].isin(*kinds))
    counts = [F.coalesce(F.size(of(r.kind)), F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE]
    base = F.coalesce(secrets.written(of(*[r.kind for r in secrets.BASE])), F.lit(""))
    return rows.select(F.col("path").alias("doc_id"), *counts, F.sha2(base, 256).alias("base_sha256"), F.coalesce(secrets.written(F.col("spans")), F.lit("")).alias("spans"))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    host, path = urlfilter.parts(F.col("url"))
    pages = table(spark, sf_dir, "pages").select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = urlfilter.longest(urlfilter.policies(urlfilter.POLICY), F.col("host"), F.col("path"))
    pages = settle(pages.withColumn("rule", rule).withColumn("ruled", verdict), "pages")
    judged = urlfilter.judged(pages.select("host", "path", (F.col("ruled") == "block").alias("bad")))
    return pages.join(judged.select("host", "path", "tpl", "verdict"), ["host", "path"]).select("page_id", "host", "path", "rule", F.coalesce("ruled", "verdict").alias("verdict"), F.col("tpl").alias("template"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0).withColumnRenamed("id", "vec_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    order = quality.planned(docs, quality.method_rules())
    # the contract asks for the measures themselves: split once, they are columns, and the verdicts read these
    measures = quality.measured(whole("text"), lambda m: F.struct(*[getattr(m, c).alias(c) for c in quality.MEASURES]))
    rows = docs.select("doc_id", F.inline(F.array(measures)))
    known = quality.Measures()
    failed = quality.cascade(quality.base_rules(), known).isNotNull()
    rows = rows.withColumn("base_failed", failed)
    kept = F.when(F.col("base_failed"), False).otherwise(quality.cascade(order, known).isNull())
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op9_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrowtokens.read(spark, arrowtokens.write(table(spark, sf_dir, "documents"), VOCABULARY, scratch_path(spark, "arrow")))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ssjoin.join(table(spark, sf_dir, "documents"), ssjoin.Jaccard(4, 85, 100)).drop("class_id")


def op11_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.count(table(spark, sf_dir, "documents"), VOCABULARY, 1024)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(whitening.whiten(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_mixing, op3_katz, op4_secrets, op5_urls, op6_ann, op7_quality, op8_bpe, op9_arrow, op10_jaccard, op11_counts, op12_divergence, op13_whitening)
}
__all__ = ["ORACLE", "QUERIES"]
