"""Landings of many shapes: ragged snapshots, types that drift, whole files, buckets, stateful keys, routes, sketches."""

import datetime
import json
import os
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessel.functions.json import parse_documents
from tessel.operators import joins, quality, reshape, series
from tessel.plans.catalog import QUERIES
from tessel.session import per_entity_partitions, scratch_path
from tessel.sinks import folders, writers
from tessel.sources import landing
from tessel.streaming import ingest

from .conftest import SF_SMALL


def test_ragged_read_widens_types(spark):  # U2
    root = scratch_path(spark, "ragged")
    shots = [[{"a": 1, "b": True}], [{"a": 2.5, "c": {"x": 1}}], [{"a": 3, "b": "t", "d": None}], ["no json"]]
    for k, rows in enumerate(shots):
        spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in rows], "value string").write.text(f"{root}/snapshot={k}")
    df = landing.read_ragged(spark, root, [T.StructField("snapshot", T.IntegerType())])
    assert dict(df.dtypes) == {"a": "double", "b": "string", "c": "string", "d": "string", "snapshot": "int"}
    got = {r.snapshot: (r.a, r.b, r.c, r.d) for r in df.collect()}
    assert got == {0: (1.0, "true", None, None), 1: (2.5, None, '{"x": 1}', None), 2: (3.0, "t", None, None), 3: (None,) * 4}


def test_union_of_frames_of_many_shapes(spark):  # U2
    n = 40
    frames = [spark.range(1).select(F.lit(f"s{k}").alias("symbol"), F.lit(k if k % 2 else k + 0.5).alias("v"), F.lit(k).alias(f"only_{k}")) for k in range(n)]
    out = reshape.union_ragged(frames)
    assert dict(out.dtypes)["v"] == "double" and len(out.columns) == n + 2
    rows = out.select("symbol", "v", "only_7").collect()
    assert len(rows) == n and {r.only_7 for r in rows} == {7, None} and {r.symbol: r.v for r in rows}["s4"] == 4.5


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_lake_types_drift(spark, fmt):  # K3
    path = scratch_path(spark, "lake") + "/t"
    frame = lambda v, t: spark.createDataFrame([("A", v)], f"symbol string, v {t}")
    writers.lake_append(frame(1, "int"), path, "2024-01-07", fmt)
    writers.lake_append(frame(2, "int"), path, "2024-01-07", fmt)
    assert dict(writers.lake_read(spark, path).dtypes) == {"symbol": "string", "v": "int", "snapshot_date": "date"}
    writers.lake_append(frame(1.5, "double"), path, "2024-01-14", fmt)
    writers.lake_append(frame(7, "int"), path, "2024-01-14", fmt)  # takes the date's type
    assert sorted(r.v for r in writers.lake_read(spark, path).collect()) == [1.0, 1.5, 2.0, 7.0]
    with pytest.raises(ValueError, match="too narrow"):
        writers.lake_append(frame("x", "string"), path, "2024-01-14", fmt)
    writers.lake_replace(frame("x", "string"), path, "2024-01-14", fmt)
    got = sorted((str(r.snapshot_date), r.v) for r in writers.lake_read(spark, path).collect())
    assert got == [("2024-01-07", "1"), ("2024-01-07", "2"), ("2024-01-14", "x")]


def test_lake_scans_grow_with_the_sets_of_columns(spark):
    path = scratch_path(spark, "lake") + "/t"
    for k in range(1, 7):
        writers.lake_replace(spark.createDataFrame([(k,)], "v int" if k % 2 else "v double") if k % 2 else spark.createDataFrame([(k + 0.5,)], "v double"), path, f"2024-01-0{k}")
    plan = writers.lake_read(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and writers.lake_read(spark, path).count() == 6
    one = writers.lake_read(spark, path).filter("snapshot_date = date'2024-01-03'")
    assert [r.v for r in one.collect()] == [3.0]


def test_whole_files_and_their_keys(spark):  # S5, S11
    root = scratch_path(spark, "files")
    s = "symbol string, value string"
    names = ["A", "X.B", "a b", "p+q", "c#1", "é%"]
    spark.createDataFrame([(n, '{\n "symbol":\n "' + n + '"\n}') for n in names], s).write.partitionBy("symbol").text(root)
    got = landing.whole_files(spark, root).collect()
    assert sorted(r.path_symbol for r in got) == sorted(names)
    assert all(json.loads(r.doc)["symbol"] == r.path_symbol for r in got)
    flat = scratch_path(spark, "flat")
    spark.createDataFrame([("x",)], "value string").coalesce(1).write.text(flat)
    assert [r.path_symbol.startswith("part-") for r in landing.whole_files(spark, flat).collect()] == [True]


def test_full_outer_series_comes_in_order_of_periods(spark):  # L3
    points = lambda *days: [{"period": f"2023-{m:02d}-01", "v": float(m)} for m in days]
    docs = [{"symbol": s, "series": {"annual": {"a": points(*draw), "b": points(*draw[::-1])}}} for s, draw in (("A", [3, 1, 2]), ("B", [9, 12, 4, 1]))]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string").coalesce(1)
    got = series.full_outer_series(parse_documents(df), ["annual"], ["a", "b"]).collect()
    assert [(r.symbol, r.date.month) for r in got] == [("A", 1), ("A", 2), ("A", 3), ("B", 1), ("B", 4), ("B", 9), ("B", 12)]


def test_bucketed_join_has_no_exchange(spark):  # J3, S7
    place = scratch_path(spark, "buckets")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS b_{place[-8:]}")
    rows = [(f"s{k % 9}", k, float(k)) for k in range(60)]
    tables = []
    for name, some in (("q", rows[:40]), ("a", rows[20:])):
        df = spark.createDataFrame(some, f"symbol string, date int, {name}_v double")
        tables.append(writers.bucketed_save(df, f"b_{place[-8:]}.{name}", ["symbol", "date"], 4, f"{place}/{name}"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = series.freq_full_outer(spark.table(tables[0]), spark.table(tables[1]))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert out.count() == 60 and out.filter("q_v = a_v").count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_new_keys_know_the_null_key(spark):  # J4
    null, some = spark.createDataFrame([(None,), (None,), (1,)], "k int"), spark.createDataFrame([(1,)], "k int")
    assert [r.k for r in joins.new_keys(null, some, ["k"]).collect()] == [None]
    assert joins.new_keys(null, null, ["k"]).collect() == []


@pytest.mark.parametrize("way", ["table", "state"])
def test_streams_know_the_null_key(spark, way):
    root, out, ckpt = (scratch_path(spark, x) for x in ("keys", "out", "ckpt"))
    s = T.StructType([T.StructField("k", T.LongType()), T.StructField("m", T.StringType())])
    found = []
    for n, keys in enumerate([[(1, "a"), (None, "a"), (None, "a")], [(None, "a"), (2, None), (1, "a")], [(2, None), (3, "c")]]):
        spark.createDataFrame(keys, s).write.json(f"{root}/{n}")
        stream = ingest.landing_stream(spark, f"{root}/*", s)
        ingest.track_new_keys(stream, ["k", "m"], out, ckpt) if way == "table" else ingest.first_seen(stream, ["k", "m"], out, ckpt)
        found.append(sorted(((r.k, r.m) for r in spark.read.schema(s).parquet(out).collect()), key=str))
    assert found[0] == [(1, "a"), (None, "a")]
    assert found[1] == sorted([(1, "a"), (2, None), (None, "a")], key=str)
    assert found[2] == sorted([(1, "a"), (2, None), (3, "c"), (None, "a")], key=str)


def test_routes_and_their_counts(spark):  # S8, Q1, A3
    root, sink, ckpt = (scratch_path(spark, x) for x in ("lines", "sink", "ckpt"))
    schema = T.StructType([T.StructField("a", T.LongType())])
    spark.createDataFrame([('{"a": 1}',), ("junk",), ('{"a": "x"}',), ('{"b": 2}',)], "value string").repartition(2).write.text(f"{root}/0")
    first = ingest.ingest_routed(spark, f"{root}/*", schema, sink, ckpt, max_files_per_trigger=1)
    assert first.totals == {"good": 3, "quarantine": 1} and first.batches >= 1
    assert ingest.ingest_routed(spark, f"{root}/*", schema, sink, ckpt).totals == {}  # nothing new
    assert [r.text for r in ingest.read_route(spark, sink, schema, ingest.BAD).collect()] == ["junk"]
    assert sorted((r.a for r in ingest.read_route(spark, sink, schema, ingest.GOOD).collect()), key=str) == [1, None, None]


def test_sketches_stay_within_their_errors(spark):  # Q2
    draw = random.Random(1)
    old = [(float(draw.gauss(0, 1)), draw.randrange(5000), None if draw.random() < 0.1 else 1.0) for _ in range(40_000)]
    new = [(float(draw.gauss(0.5, 1)), draw.randrange(10_000), None if draw.random() < 0.3 else 1.0) for _ in range(40_000)]
    frame = lambda rows: spark.createDataFrame(rows, "x double, k int, y double")
    path = scratch_path(spark, "sketches")
    for n, part in enumerate((old[:15_000], old[15_000:])):
        quality.sketch(frame(part), ["x", "k", "y"]).write.parquet(f"{path}/part={n}")
    a, b = quality.merged(spark.read.parquet(path)), quality.sketch(frame(new), ["x", "k", "y"])
    got = {r.column_name: r for r in quality.drift(a, b).collect()}
    values = sorted(v for v, _, _ in old), sorted(v for v, _, _ in new)
    assert got["x"].old_n == got["x"].new_n == 40_000
    exact = max(abs(sum(v <= x for v in values[0]) - sum(v <= x for v in values[1])) / 40_000 for x in values[1][:: 400])
    assert abs(got["x"].rank_shift - exact) <= 2 * quality.RANK_ERROR + 0.01
    ratio = len({k for _, k, _ in new}) / len({k for _, k, _ in old})
    assert abs(got["k"].distinct_ratio / ratio - 1) <= 2 * quality.DISTINCT_ERROR
    nulls = [sum(y is None for *_, y in rows) / 40_000 for rows in (old, new)]
    assert abs(got["y"].null_shift - (nulls[1] - nulls[0])) < 1e-9 and got["y"].rank_shift == 0
    full = {r.column_name: r for r in quality.summary(a).collect()}
    assert abs(sum(v <= full["x"].q50 for v in values[0]) / 40_000 - 0.5) <= quality.RANK_ERROR
    assert full["k"].null_share == 0


def test_sketches_of_empty_and_missing_columns(spark):
    none = quality.sketch(spark.createDataFrame([], "x double"), ["x"])
    some = quality.sketch(spark.createDataFrame([(None,), (float("nan"),)], "z double"), ["z"])
    got = {r.column_name: r for r in quality.drift(none, some).collect()}
    assert got["x"].old_n == 0 and got["x"].rank_shift is None and got["z"].new_n == 2 and got["z"].old_n is None
    assert quality.summary(none).first().q50 is None


def symbol_files(spark, root):
    """Of the files in symbol folders: the numbers of the tasks that wrote them, and the most files of a folder."""
    files = [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path").collect()]
    per_symbol = {}
    for f in files:
        per_symbol.setdefault(re.search("symbol=([^/]+)", f)[1], []).append(f)
    return {re.search(r"/part-(\d+)-", f)[1] for f in files}, max(map(len, per_symbol.values()))


def test_pair_folders_are_written_by_many_tasks(spark):  # K5
    root = QUERIES["parquet_pair"](spark, SF_SMALL).inputFiles()[0].split("/series/")[0]
    for side in ("metrics", "series"):
        tasks, most = symbol_files(spark, f"{root}/{side}")
        assert len(tasks) > 1 and most == 1


def test_metric_folders_are_written_by_many_tasks(spark):  # K5
    root = QUERIES["parquet_pair_metrics"](spark, SF_SMALL).inputFiles()[0].split("/metrics/")[0]
    tasks, most = symbol_files(spark, f"{root}/metrics")
    assert len(tasks) > 1 and most == 1


def test_landed_folders_are_written_by_many_tasks(spark):  # S10
    root = scratch_path(spark, "landing-per-symbol")
    many = spark.range(0, 200, 1, 4).selectExpr("concat('S', id % 100) AS symbol", "id AS v")
    writers.land_json(many, root, "2024-01-01", per_symbol=True)
    tasks, most = symbol_files(spark, root)
    assert len(tasks) > 1 and most == 1  # and one file for all documents of a symbol
    assert spark.read.json(root).count() == 200


def layout(root):
    """Folders below a root that hold files, with the number of files and of checksum files of each."""
    out = {}
    for at, _, names in os.walk(root):
        if names := [x for x in names if "_SUCCESS" not in x]:
            out[os.path.relpath(at, root)] = (len([x for x in names if not x.startswith(".")]), len([x for x in names if x.endswith(".crc")]))
    return out


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_folders_as_of_sparks_writer(spark, tmp_path, fmt):  # K5, S10
    odd = [None, "", " a ", "a/b=c%2F", "é+ü", "x{y}[z]^", "\x01\x7f", 'q"\'#:*?\\', "~!@$&(),;|<>`"] + [f"S{i}" for i in range(40)]
    rows = [(s, i, f"t\n\"{i}\"" if i % 3 else None, datetime.date(1500 + 17 * (i % 40), 1, 1), Decimal(i) / 4, [{"k": float(i)}] if i % 2 else []) for i, s in enumerate(odd * 3)]
    df = spark.createDataFrame(rows, "symbol string, `a.b` int, t string, d date, x decimal(9,2), m array<map<string,double>>").withColumn(
        "d0", F.when(F.col("`a.b`") % 2 == 0, F.lit("2024-01-07").cast("date"))).repartition(3, "`a.b`")
    spark_at, at = str(tmp_path / "spark"), str(tmp_path / "here")
    df.write.format(fmt).partitionBy("d0", "symbol").save(spark_at)
    assert folders.write(df, f"file://{at}", fmt, ["d0", "symbol"])
    assert layout(at) == layout(spark_at)
    read = lambda p: sorted(map(repr, spark.read.schema(df.schema).format(fmt).load(p).collect()))  # noqa: E731  # verifies the checksums
    assert len(read(at)) == len(rows) and read(at) == read(spark_at)
    opened = lambda s, o: spark.read.schema(s).options(**o).format(fmt).load(at)
    found = landing.read_folders(spark, opened, df.schema, ["d0", "symbol"])  # of values, without Spark's search for them
    leaf = found._jdf.queryExecution().optimizedPlan().collectLeaves().head()
    assert leaf.relation().partitionSchema().isEmpty() and found.schema.names == spark.read.schema(df.schema).format(fmt).load(at).schema.names
    assert sorted(map(repr, found.collect())) == read(spark_at)
    mode = lambda p: {oct(os.stat(os.path.join(d, x)).st_mode) for d, a, b in os.walk(p) for x in a + b}
    assert mode(at) == mode(spark_at)
    if fmt == "parquet":  # names and types of columns without a declared schema, too
        assert spark.read.parquet(at).schema == spark.read.parquet(spark_at).schema


def test_folders_replaced_again_and_failed(spark, tmp_path):
    at = str(tmp_path / "here")
    write = lambda df: writers.write_partitioned(df, at, "json", ["symbol"], as_dealt=True)
    many = spark.range(0, 30000, 1, 2).selectExpr("'hot' AS symbol", "id").union(spark.range(5).selectExpr("concat('S', id) AS symbol", "id"))
    write(many.repartition(4, "symbol"))
    assert {k: v[0] for k, v in layout(at).items()} == {"symbol=hot": 1, **{f"symbol=S{i}": 1 for i in range(5)}}  # one file, over batches
    write(spark.range(7).selectExpr("concat('S', id % 2) AS symbol", "id + 100 AS id"))
    got = [tuple(r) for r in spark.read.schema("symbol string, id long").json(at).filter("symbol <> 'hot'").select("symbol", "id").collect()]
    assert sorted(got) == sorted([(f"S{i % 2}", i + 100) for i in range(7)] + [(f"S{i}", i) for i in (2, 3, 4)])
    before = layout(at)
    with pytest.raises(Exception, match="broken"):
        write(spark.range(0, 100, 1, 4).selectExpr("concat('S', id) AS symbol", "if(id = 99, raise_error('broken'), id) AS id"))
    assert layout(at) == before and not [x for x in os.listdir(at) if x.startswith(".")]


def test_folders_left_to_sparks_writer(spark, tmp_path):
    df = spark.sql("SELECT 'S' AS symbol, TIMESTAMP'2024-01-07 01:02:03' AS t")
    assert not folders.write(df, str(tmp_path), "parquet", ["symbol"])  # Arrow writes another kind of timestamp
    writers.write_partitioned(df, str(tmp_path / "t"), partition_cols=["symbol"], as_dealt=True)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_symbol_folders_are_listed_and_read_in_few_tasks(spark):  # K5, S10
    root, most, size = scratch_path(spark, "few-tasks"), "spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.maxPartitionBytes"
    writers.land_json(spark.range(200).selectExpr("concat('S', id) AS symbol", "id AS v"), root, "2024-01-01", per_symbol=True)
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("v", T.LongType())])
    before, kept = spark.conf.get(size), spark.conf.get(most)
    spark.conf.set(size, "4m")  # so a file a task, as each counts as 4 MB
    seen, few = [], landing.FOLDER_TASKS * per_entity_partitions(spark)
    try:
        assert landing.scan_date(spark, root, schema, "2024-01-01").rdd.getNumPartitions() == 200
        read = lambda s, o: (seen.append(int(spark.conf.get(most))), landing.read_json(spark, root, s, o))[1]
        got = landing.read_folders(spark, read, schema, ["symbol"])
        assert got.rdd.getNumPartitions() == seen[0] == few < 200 and spark.conf.get(most) == kept
        assert sorted(r.v for r in got.collect()) == [*range(200)]
        assert landing.scan_date(spark, root, schema, "2024-01-01", per_symbol=True).rdd.getNumPartitions() == few
        for name in ("parquet_pair", "parquet_pair_metrics", "manifest_per_symbol"):
            assert QUERIES[name](spark, SF_SMALL).rdd.getNumPartitions() <= few
    finally:
        spark.conf.set(size, before)
