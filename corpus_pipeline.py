"""A training-corpus pipeline over `documents`: five stages, each calling one operator of ``tessel.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet to the shared scratch folder and read again as the next
one's docs. All but the last return the columns of documents; where a stage
changes a text, ``n_chars`` follows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.llm import bpe, mixing, quality, secrets, ssjoin
from tessel.llm.common import broadcast_if_small, settle, table, whole, words
from tessel.llm.queries import VOCABULARY
from tessel.session import scratch_path

#: Shingles of five words, similarity of 0.8.
NEAR = ssjoin.Jaccard(5, 80, 100)


def _measured(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType)) if "n_chars" in like.columns else docs


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that a rule rejects go."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group stays, that of the least id."""
    return ssjoin.representatives(docs, NEAR)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: the spans of secrets are replaced by a mark; all documents stay, clean ones as they are."""
    ledger = scratch_path(spark, "pipeline-ledger")
    secrets.scan(docs, ledger)
    found = broadcast_if_small(settle(secrets.findings(spark, ledger), "pipeline-findings"))
    # the rows as structs, so that no name of theirs clashes
    packed = docs.select(F.struct("*").alias("row"), F.sha2(whole("text"), 256).alias("blob"))
    old = F.col("row").getField("text")
    text = F.when(F.col("spans").isNull(), old).otherwise(secrets.redact(whole(old), F.col("spans")))
    rows = packed.join(found, "blob", "left").withColumn("body", text)
    return _measured(rows.select(*[F.col("body").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]), docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: a row per whole copy and per cut part that the mix takes."""
    plan = mixing.mix(docs, F.col("doc_id"), F.col("source"), F.size(words(whole("text"))), F.md5(whole("text")))
    return _measured(mixing.realise(plan, "text", docs.columns), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding: ids and decoded text of every row, as digests."""
    return bpe.digests(docs, VOCABULARY)


STAGES = [
    ("quality rules", rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", redacted),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs


#: The last stage is no SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None
