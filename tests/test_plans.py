"""Plan-shape tests: the properties the design relies on at scale.

These read the physical plan Spark chose (before AQE re-planning) and check
pruning, pushdown, partial aggregation before every grouping exchange, and
the exchange count of each query family, so that a regression in plan shape
fails a test even when the results stay right.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tessel.operators import joins
from tessel.plans.catalog import QUERIES

from .conftest import SF_SMALL


def plan(df) -> str:
    """The physical plan as text, with scan metadata (ReadSchema) untruncated."""
    conf = df.sparkSession.conf
    old = conf.get("spark.sql.maxMetadataStringLength")
    conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set("spark.sql.maxMetadataStringLength", old)


def exchanges(p: str) -> list[str]:
    """Shuffle exchanges (broadcasts excluded), one line each."""
    return [ln for ln in p.splitlines() if re.search(r"\bExchange (hash|range|Single|Round)", ln)]


def grouping_exchanges_have_partial_agg(p: str) -> bool:
    """Every hash exchange that feeds a final aggregate sits on a partial one."""
    lines = p.splitlines()
    for i, ln in enumerate(lines):
        if "Exchange hashpartitioning" in ln and "REPARTITION_BY" not in ln and i > 0 \
                and "Aggregate" in lines[i - 1]:
            below = lines[i + 1] if i + 1 < len(lines) else ""
            if "Aggregate" not in below:
                return False
    return True


def test_document_derivation_prunes_and_pre_aggregates(spark):
    p = plan(QUERIES["fact_quarterly"](spark, SF_SMALL))
    li = [ln for ln in p.splitlines() if "lineitem.parquet" in ln]
    assert li, p
    schema = re.search(r"ReadSchema: struct<([^>]*)", li[0]).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == sorted(
        ["l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"])
    assert grouping_exchanges_have_partial_agg(p)
    # (supplier, quarter) partial agg; one repartition by supplier; supplier side of the join
    assert len(exchanges(p)) == 3, exchanges(p)


def test_row_local_queries_add_no_exchange(spark):
    base = len(exchanges(plan(QUERIES["fact_quarterly"](spark, SF_SMALL))))
    for name in ("series_quarterly_period", "series_full_outer", "freq_full_outer", "typed_union",
                 "split_typed", "legacy_wide", "series_long", "fact_annual", "fact_metric"):
        assert len(exchanges(plan(QUERIES[name](spark, SF_SMALL)))) == base, name


def test_grouped_queries_pre_aggregate(spark):
    for name in ("type_counts", "series_bearing", "metric_catalog", "quality_report_quarterly",
                 "series_long_pivot", "snapshot_partition", "new_symbols"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert grouping_exchanges_have_partial_agg(p), name


def test_directory_filters_reach_the_scan(spark):
    p = plan(QUERIES["symbol_directory"](spark, SF_SMALL))
    scan = [ln for ln in p.splitlines() if "customer.parquet" in ln][0]
    assert "EqualTo(c_mktsegment,BUILDING)" in scan
    assert "ReadSchema: struct<c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string>" in scan


def test_new_keys_one_exchange_and_hot_key(spark):
    # One key holds a third of the current rows and also appears in ``seen``.
    n = 3000
    current = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    seen = spark.createDataFrame([(7,), (1,), (None,)], "k long")
    current = current.unionByName(spark.createDataFrame([(None,)], "k long"))
    out = joins.new_keys(current, seen, ["k"])
    p = plan(out)
    assert len(exchanges(p)) == 1 and "partial_max" in p
    got = {r.k for r in out.collect()}
    expect = {i for i in range(n) if i % 3 != 0 and i not in (1, 7)}  # the null key is known too
    assert got == expect


def test_row_index_broadcasts_only_partition_offsets(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7 % 2000).alias("k"))
    p = plan(joins.with_row_index(df, ["k"], num_partitions=5))
    bcast = [ln for ln in p.splitlines() if "BroadcastExchange" in ln]
    assert len(bcast) == 1
    # the broadcast side is the per-partition count table (keys: partition id)
    assert "_pid" in p.split("BroadcastExchange", 1)[1].splitlines()[1]


def test_dated_scan_prunes_partitions(spark):  # S3
    p = plan(QUERIES["raw_scan_date"](spark, SF_SMALL))
    scan = [ln for ln in p.splitlines() if "FileScan json" in ln][0]
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_date#\d+ = 2024-01-15", scan), scan
    assert "ReadSchema: struct<event_id:bigint,value:double>" in scan


def test_top_k_is_not_a_global_sort(spark):  # L2
    p = plan(QUERIES["symbol_top100"](spark, SF_SMALL))
    assert "TakeOrderedAndProject(limit=100" in p and not exchanges(p)
    assert "ReadSchema: struct<c_name:string>" in p


def test_a_known_date_is_written_without_a_shuffle(spark):  # K1, K3
    from tessel.session import scratch_path
    from tessel.sinks import writers
    df = spark.range(1000).repartition(4)
    path = scratch_path(spark, "lake-files")
    writers.lake_replace(df, path, "2024-01-07")
    assert spark.read.parquet(path).rdd.getNumPartitions() >= 1
    assert spark.read.parquet(path).select("_metadata.file_path").distinct().count() == 4  # one file a task
    writers.lake_replace(df.limit(0), path, "2024-01-07")
    assert writers.lake_read(spark, path).count() == 0


def test_discovery_reads_the_documents_once(spark):  # P4
    from tessel.functions.json import parse_documents
    from tessel.plans import staging
    texts = spark.createDataFrame([('{"symbol":"A","metric":{"x":1},"series":{"annual":{"a":[],"b":[]},"quarterly":{"c":[]}}}',), ('{"symbol":"B"}',)], "doc string")
    assert staging.discover_metrics(parse_documents(texts)) == (["x"], {"annual": ["a", "b"], "quarterly": ["c"]})
