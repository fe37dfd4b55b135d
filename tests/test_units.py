"""Unit tests for the helpers that have no query of their own (U rows of the inventory)."""

import datetime as dt
import json
import os
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessel.functions import keys
from tessel.functions.json import parse_documents
from tessel.functions.schema import empty_frame, require_columns, unique_names
from tessel.operators import joins, quality, reshape, series
from tessel.session import checkpoint_root, scratch_path
from tessel.sinks import writers
from tessel.sources import landing
from tessel.streaming import ingest


def test_unique_names_and_require(spark):  # P6, P16
    assert unique_names(["a", "A", "symbol", "a"], ["symbol"]) == ["a", "metric_A", "metric_symbol", "metric_metric_a"]
    df = spark.createDataFrame([(1, 2)], "period int, a int")
    assert require_columns(df, "a") and not require_columns(df, "type")


def test_empty_frame_is_union_identity(spark):  # U3, U2
    s = T.StructType([T.StructField("symbol", T.StringType())])
    one = spark.createDataFrame([("A",)], s)
    two = spark.createDataFrame([("B", 1.0)], "symbol string, x double")
    out = reshape.union_ragged([empty_frame(spark, s), one, two])
    assert sorted(map(tuple, out.collect())) == [("A", None), ("B", 1.0)]


def test_read_with_fallback(spark):  # S4
    base = scratch_path(spark, "fallback")
    spark.createDataFrame([(1,)], "a long").write.json(f"{base}/old")
    s = T.StructType([T.StructField("a", T.LongType())])
    df = landing.read_with_fallback(spark, f"{base}/missing", f"{base}/old", s)
    assert [r.a for r in df.collect()] == [1]
    with pytest.raises(Exception):
        landing.read_with_fallback(spark, f"{base}/missing", None, s).collect()


def test_write_selected(spark):  # K9
    calls = []
    outs = {"a": spark.range(1), "b": spark.range(2)}
    writers.write_selected(outs, ["b"], lambda n, df: calls.append((n, df.count())))
    assert calls == [("b", 2)]
    with pytest.raises(KeyError):
        writers.write_selected(outs, ["zzz"], lambda n, df: None)


def test_observed_count(spark):  # A3
    df, obs = quality.observed_count(spark.range(7))
    df.collect()
    assert obs.get["num_records"] == 7


def test_preview_and_files(spark):  # L4, T2
    path = scratch_path(spark, "files")
    df = spark.range(1000).withColumn(writers.DATE_COL, F.lit("2024-01-01").cast("date"))
    writers.write_partitioned(df, path, files=2)
    local = path.replace("file:", "")
    part = [p for p in os.listdir(local) if p.startswith(writers.DATE_COL)][0]
    n_files = [f for f in os.listdir(f"{local}/{part}") if f.endswith(".parquet")]
    assert 1 <= len(n_files) <= 2
    assert spark.read.parquet(path).count() == 1000


def test_row_index_many_partitions(spark):  # J1, T1
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(13)
    out = joins.with_row_index(df, ["k"], num_partitions=7)
    got = sorted((r.k, r.rn) for r in out.collect())
    assert got == [(k, k + 1) for k in range(5000)]


def test_zip_join_uneven(spark):
    a = spark.createDataFrame([(i, f"a{i}") for i in range(5)], "ka int, va string")
    b = spark.createDataFrame([(i, f"b{i}") for i in range(3)], "kb int, vb string")
    with pytest.raises(ValueError):
        joins.zip_join(a, ["ka"], b, ["kb"])
    out = joins.zip_join(a, ["ka"], b, ["kb"], pad=True)
    assert sorted((r.rn, r.va, r.vb) for r in out.collect()) == [(i + 1, f"a{i}", f"b{i}" if i < 3 else None) for i in range(5)]


def test_new_keys_stream_twice(spark):  # J4 streaming form, S8
    root = scratch_path(spark, "keys-landing")
    s = T.StructType([T.StructField("symbol", T.StringType())])
    spark.createDataFrame([("A",), ("B",), ("A",)], s).write.json(f"{root}/1")
    table, ckpt = scratch_path(spark, "key-table"), scratch_path(spark, "key-ckpt")
    ingest.track_new_keys(ingest.landing_stream(spark, f"{root}/*", s), ["symbol"], table, ckpt)
    spark.createDataFrame([("B",), ("C",)], s).write.json(f"{root}/2")
    ingest.track_new_keys(ingest.landing_stream(spark, f"{root}/*", s), ["symbol"], table, ckpt)
    ingest.track_new_keys(ingest.landing_stream(spark, f"{root}/*", s), ["symbol"], table, ckpt)
    got = sorted(r.symbol for r in spark.read.parquet(table).collect())
    assert got == ["A", "B", "C"]


def test_key_expressions(spark):  # S11, S12, R3
    df = spark.createDataFrame([
        ("s3://bucket/raw/2024-01-01/name_AAPL.json", "stock_X.A_path", "a.b.c"),
        ("noslash", "stock_MSFT_path", "plain"),
        ("dir/", "x", "a."),
    ], "p string, m string, d string")
    out = df.select(keys.path_key("p").alias("pk"), keys.fanout_key("m").alias("fk"),
                    keys.last_dotted("d").alias("ld")).collect()
    assert [tuple(r) for r in out] == [("name_AAPL", "stock_X", "c"), ("noslash", "stock_MSFT", "plain"),
                                       ("", "", "")]


def test_checkpoint_root_is_shared_setting(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")


# --- properties ---------------------------------------------------------------

periods = st.lists(st.dates(dt.date(2000, 1, 1), dt.date(2030, 1, 1)), min_size=0, max_size=8, unique=True)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ps=periods, n_metrics=st.integers(1, 3))
def test_position_equals_period_when_aligned(spark, ps, n_metrics):
    ps = sorted(ps, reverse=True)
    metrics = [f"m{i}" for i in range(n_metrics)]
    body = {"symbol": "S", "metric": {}, "series": {"annual": {
        m: [{"period": p.isoformat(), "v": float(i + j)} for j, p in enumerate(ps)] for i, m in enumerate(metrics)}}}
    d = parse_documents(spark.createDataFrame([(json.dumps(body),)], "doc string"))
    a = sorted(map(tuple, series.align_freq(d, "annual", metrics, "position").collect()))
    b = sorted(map(tuple, series.align_freq(d, "annual", metrics, "period").collect()))
    assert a == b and len(a) == len(ps)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lens=st.lists(st.integers(0, 6), min_size=1, max_size=3))
def test_position_rows_are_max_length(spark, lens):
    metrics = [f"m{i}" for i in range(len(lens))]
    body = {"symbol": "S", "series": {"quarterly": {
        m: [{"period": f"20{10 + j}-01-01", "v": 1.0} for j in range(n)] for m, n in zip(metrics, lens)}}}
    d = parse_documents(spark.createDataFrame([(json.dumps(body),)], "doc string"))
    assert series.align_freq(d, "quarterly", metrics, "position").count() == max(lens)


def test_union_then_split_is_identity(spark):
    from tessel.plans.catalog import docs
    from tessel.sources.fixtures import METRIC_KEYS, SERIES_METRICS
    d = docs(spark, "/root/testdata/sf0.001")
    q = series.align_freq(d, "quarterly", SERIES_METRICS, "period", prefix="quarterly_")
    _, q2, _ = reshape.split_typed(reshape.typed_union(d, METRIC_KEYS, SERIES_METRICS))
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, q2.select(*q.columns).collect()))


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_declared_table_schemas_match_files(spark, sf):
    from tessel.sources.tables import SCHEMAS, table
    for name in SCHEMAS:
        inferred = spark.read.parquet(f"{sf}/{name}.parquet").schema
        declared = table(spark, sf, name).schema
        assert [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in inferred], name


def test_stage_equals_split_of_typed_union(spark):
    from tessel.plans import staging
    from tessel.plans.catalog import docs
    from tessel.sources.fixtures import METRIC_KEYS, SERIES_METRICS
    d = docs(spark, "/root/testdata/sf0.001", gappy=True)
    direct = staging.stage(d, METRIC_KEYS, SERIES_METRICS)
    via = reshape.split_by_type(reshape.typed_union(d, METRIC_KEYS, SERIES_METRICS, bearing_only=True))
    general = reshape.split_typed(reshape.typed_union(d, METRIC_KEYS, SERIES_METRICS))
    for a, b, c in zip((direct.metric, direct.quarterly_metric, direct.annual_metric), via, general):
        assert a.columns == b.columns == c.columns
        rows = sorted(map(tuple, a.collect()))
        assert rows == sorted(map(tuple, b.collect())) == sorted(map(tuple, c.collect()))


def test_discover_metrics(spark):  # P4
    from tessel.plans import staging
    from tessel.plans.catalog import docs
    from tessel.sources.fixtures import METRIC_KEYS, SERIES_METRICS
    keys, names = staging.discover_metrics(docs(spark, "/root/testdata/sf0.001"))
    assert keys == list(METRIC_KEYS) and names == {"annual": list(SERIES_METRICS), "quarterly": list(SERIES_METRICS)}


def test_lake_replace_is_idempotent_and_dated(spark):  # K3, D15
    path = scratch_path(spark, "lake")
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "symbol string, v double")
    writers.lake_append(df, path, "2024-01-07")
    writers.lake_append(df, path, "2024-01-07")
    assert spark.read.parquet(path).count() == 4  # append duplicates by design
    writers.lake_replace(df, path, "2024-01-07")
    writers.lake_replace(df.limit(1), path, "2024-01-14")
    got = spark.read.parquet(path).groupBy(writers.DATE_COL).count().collect()
    assert sorted((str(r[0]), r[1]) for r in got) == [("2024-01-07", 2), ("2024-01-14", 1)]


def test_landing_overwrite_replaces_only_its_date(spark):  # K1, S3
    root = scratch_path(spark, "landing")
    s = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("v", T.DoubleType())])
    writers.land_json(spark.createDataFrame([("A", 1.0)], s), root, "2024-01-01")
    writers.land_json(spark.createDataFrame([("B", 2.0)], s), root, "2024-01-02")
    writers.land_json(spark.createDataFrame([("C", 3.0)], s), root, "2024-01-01")
    day1 = landing.scan_date(spark, root, s, "2024-01-01").collect()
    day2 = landing.scan_date(spark, root, s, "2024-01-02").collect()
    assert [r.symbol for r in day1] == ["C"] and [r.symbol for r in day2] == ["B"]
    per_symbol = scratch_path(spark, "landing-per-symbol")
    writers.land_json(spark.createDataFrame([("X.A", 1.0), ("X.B", 2.0)], s), per_symbol, "2024-01-01",
                      per_symbol=True)
    full = landing.with_partitions(T.StructType([s["v"]]), T.StructField(writers.DATE_COL, T.DateType()),
                                   T.StructField("symbol", T.StringType()))
    back = landing.read_json(spark, per_symbol, full)
    assert sorted((r.symbol, r.v) for r in back.collect()) == [("X.A", 1.0), ("X.B", 2.0)]
    keys = {r.path_symbol for r in landing.with_path_key(back).select("path_symbol").collect()}
    assert all(re.fullmatch(r"part-\d{5}-[0-9a-f-]{36}", k) for k in keys), keys


point = st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(-5, 5).map(float)))


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(arrays=st.lists(st.lists(point, max_size=8), min_size=1, max_size=3))
def test_period_alignment_matches_brute_force(spark, arrays):
    """Unsorted arrays, duplicate periods and null values against a plain-Python group-by-max."""
    metrics = [f"m{i}" for i in range(len(arrays))]
    day = lambda k: dt.date(2020, 1, 1) + dt.timedelta(days=k)
    body = {"symbol": "S", "series": {"f": {
        m: [{"period": day(k).isoformat(), "v": v} for k, v in pts] for m, pts in zip(metrics, arrays)}}}
    d = parse_documents(spark.createDataFrame([(json.dumps(body),)], "doc string"))
    got = sorted(tuple(r) for r in series.align_freq(d, "f", metrics, "period").drop("symbol").collect())
    expected = []
    for k in sorted({k for pts in arrays for k, _ in pts}):
        row = [day(k)]
        for pts in arrays:
            vals = [v for kk, v in pts if kk == k and v is not None]
            row.append(max(vals) if vals else None)
        expected.append(tuple(row))
    assert got == expected


def test_jobs_warehouse_selection(spark):  # K4, K9 through the job functions
    from tessel.plans import jobs
    from tessel.sources.fixtures import documents
    land = writers.land_json(documents(spark, "/root/testdata/sf0.001").drop("suppkey"),
                             scratch_path(spark, "doc-landing"), "2024-01-07")
    st_root = scratch_path(spark, "staging")
    run = jobs.transform_landing(spark, land, st_root, "2024-01-07")
    typed = spark.read.parquet(run["path"])
    for name, t in zip(jobs.STAGING_TABLES, ("metric", "quarterly_metric", "annual_metric")):
        assert typed.filter(F.col("type") == t).count() == run["rows"][name] > 0
    names = jobs.update_warehouse(spark, st_root, "tessel_test", "2024-01-07", selection=["metric"],
                                  location=scratch_path(spark, "wh"))
    assert names == ["tessel_test.metric_fact"]
    m = spark.table("tessel_test.metric_fact")
    assert m.columns == ["symbol", "firstShip", "s_acctbal", "s_nationkey"]
    assert m.filter(F.col("firstShip").isNotNull()).count() == 0


def test_doc_freq_full_outer_equals_join(spark):  # J3
    from tessel.operators import series
    from tessel.plans.catalog import docs
    from tessel.sources.fixtures import SERIES_METRICS
    d = docs(spark, "/root/testdata/sf0.001", gappy=True)
    q = series.align_freq(d, "quarterly", SERIES_METRICS, "period", prefix="q_")
    a = series.align_freq(d, "annual", SERIES_METRICS, "period", prefix="a_")
    joined = series.freq_full_outer(q, a)
    local = series.doc_freq_full_outer(d, SERIES_METRICS)
    assert sorted(joined.columns) == sorted(local.columns)
    cols = sorted(local.columns)
    rows = lambda df: sorted(map(tuple, df.select(*cols).collect()), key=repr)
    assert rows(joined) == rows(local)
    assert "Exchange" not in local._jdf.queryExecution().executedPlan().toString().split("Generate")[0]


def test_entity_width_follows_the_shuffle_width(spark):
    from tessel.sources import fixtures
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for width in (1, 4 * cores):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            assert fixtures._per_entity_partitions(spark) == max(cores, width)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
