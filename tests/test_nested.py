"""Documents of undeclared shape: paths, flattening, passthrough, and values that do not fit."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessel.functions.json import parse_documents
from tessel.functions.types import cast_to, wider, widest
from tessel.operators import nested
from tessel.plans import jobs
from tessel.session import scratch_path
from tessel.sinks import writers
from tessel.sources import landing

DATE = "2024-01-07"


def variants(spark, *docs):
    texts = [(d if isinstance(d, str) or d is None else json.dumps(d),) for d in docs]
    return spark.createDataFrame(texts, "text string").select(F.try_parse_json("text").alias("doc"))


def test_flatten_at_any_depth(spark):  # P17
    deep = {"z": 1}
    for k in range(8):
        deep = {f"l{k}": deep}
    df = variants(spark, {"a": 1, "b": {"c": "x", "d": {"e": 2.5, "f": None}}, "none": {}, "list": [1, {"q": 2}], "t": True}, deep, {}, None, "[1]", "7", "no json")
    got = [r.doc for r in nested.flatten_metrics(df, "doc").collect()]
    assert got[0] == {"a": "1", "b.c": "x", "b.d.e": "2.5", "b.d.f": None, "t": "true"}
    assert got[1] == {"l7.l6.l5.l4.l3.l2.l1.l0.z": "1"}
    assert got[2] == {} and got[3:] == [None] * 4


def test_flatten_keeps_one_value_of_a_name(spark):
    got = nested.flatten_metrics(variants(spark, {"a.b": 2, "a": {"b": 1}, "`<": {">": {"<a<": 3}}}), "doc").first().doc
    assert got == {"a.b": "1", "`<.>.<a<": "3"}


def test_depth_reads_brackets_of_types_alone(spark):
    df = variants(spark, {"<<<`<": {"b<": 1}}, {"a": [[{"b": 1}]]}, None)
    assert nested.depth(df, F.col("doc")) == 4 and nested.depth(df.limit(1), F.col("doc")) == 2
    assert nested.depth(df.filter("false"), F.col("doc")) == 0
    assert nested.paths(df.filter("false")).collect() == []


def test_paths_as_the_merged_schema(spark):  # P2, P3
    docs = [{"s": {"a": [{"p": "x", "v": 1}, {"v": 2.5}], "n": [1, 2]}, "k": 1}, {"s": {"a": [{"p": "y", "q": {"r": [{"t": 1}]}}]}, "k": 2.5}, {"s": {"a": []}}]
    df = variants(spark, *docs)
    found = nested.paths(df)
    by = {(r.path, r.kind): r.docs for r in found.collect()}
    assert by["s.a", "ARRAY"] == 3 and by["s.a[]", "OBJECT"] == 2 and by["s.a[].v", "BIGINT"] == 1 and by["s.a[].v", "DECIMAL"] == 1
    assert by["s.a[].q.r[].t", "BIGINT"] == 1 and by["k", "BIGINT"] == 1 and by["k", "DECIMAL"] == 1
    assert sorted(map(tuple, nested.object_arrays(found).collect())) == [("s.a", 2)]
    assert sorted(map(tuple, nested.array_fields(found).collect())) == [("s.a.p", "string", 2), ("s.a.q", "object", 1), ("s.a.v", "double", 1)]
    # no path that Spark's own merged schema lacks, and none missing
    merged = df.agg(F.schema_of_variant_agg("doc").alias("s")).first().s
    names = {p.replace("[]", "").split(".")[-1] for p, _ in by}
    assert all(f"{n}: " in merged for n in names) and merged.count(": ") == len({p for p, _ in by if not p.endswith("[]")})


def test_paths_of_conflicting_kinds(spark):
    found = nested.paths(variants(spark, {"a": 1}, {"a": {"b": [{"c": 1}]}}, {"a": [{"c": "x"}, {"c": None}]}, {"a": None}, "[1]", None))
    by = {(r.path, r.kind) for r in found.collect()}
    assert {("a", "BIGINT"), ("a", "OBJECT"), ("a", "ARRAY"), ("a", "VOID"), ("a.b[].c", "BIGINT"), ("a[].c", "STRING"), ("a[].c", "VOID")} <= by
    assert {r.path for r in nested.object_arrays(found).collect()} == {"a", "a.b"}
    assert {(r.path, r.type) for r in nested.array_fields(found).collect()} == {("a.c", "string"), ("a.b.c", "bigint")}


def test_passthrough_types_and_names(spark):  # P10
    docs = [{"symbol": "A", "n": 1, "x": 1, "b": True, "date": "d", "o": {"k": 1}, "m": {"k": 1}, "z": None},
            {"symbol": "B", "n": 2.5, "x": "t", "b": False, "m": 5, "z": None}, {"symbol": "C"}]
    texts = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string")
    d = texts.select(F.inline(F.array(F.struct(F.get_json_object("doc", "$.symbol").alias("symbol"), nested.rest(F.try_parse_json("doc")).alias("rest")))))
    types = nested.scalar_fields(d)
    assert {k: t.simpleString() for k, t in types.items()} == {"n": "double", "x": "string", "b": "boolean", "date": "string", "m": "bigint", "z": "string"}
    out, names = nested.with_scalars(d, types, taken=["date"])
    assert sorted(names) == sorted(["b", "metric_date", "m", "n", "x", "z"])
    got = {r.symbol: r for r in out.collect()}
    assert (got["A"].n, got["A"].x, got["A"].b, got["A"].metric_date, got["A"].m) == (1.0, "1", True, "d", None)
    assert (got["B"].n, got["B"].x, got["B"].m) == (2.5, "t", 5) and all(got["C"][n] is None for n in names)
    assert json.loads(out.filter("symbol = 'A'").select(F.to_json(F.col("rest")["o"])).first()[0]) == {"k": 1}  # lossless


POINTS = [{"period": "2023-03-31", "v": 1.5}, {"period": "2023-06-30", "v": 2.5}]


def land(spark, *docs):
    root = scratch_path(spark, "landing")
    lines = [(d if isinstance(d, str) else json.dumps(d),) for d in docs]
    spark.createDataFrame(lines, "value string").write.text(f"{root}/{writers.DATE_COL}={DATE}")
    return root


def test_one_bad_value_costs_that_value(spark):  # Q1, D6
    bad = {"symbol": "A", "metric": {"beta": 1}, "series": {
        "annual": {"eps": [{"period": "2022-12-31", "v": "N/A"}, {"period": "soon", "v": 3}, {"period": "2021-12-31", "v": 4}], "pe": POINTS[:1]},
        "quarterly": {"eps": POINTS}}}
    root = land(spark, bad, {"symbol": "B", "metric": "none", "series": {"annual": {"eps": POINTS}, "quarterly": {"eps": POINTS}}},
                {"symbol": "C", "metric": {"beta": 2}}, "garbage", '{"symbol": "D", "metric": {"beta"', '["E"]')
    staged, lake = scratch_path(spark, "staging"), scratch_path(spark, "lake")
    out = jobs.transform_landing(spark, root, staged, DATE)
    assert out["rows"]["quarantine"] == 3 and out["rows"]["metric"] == 3 and out["bad_values"] == 3
    assert {r.text for r in jobs.read_quarantine(spark, staged, DATE).collect()} == {"garbage", '{"symbol": "D", "metric": {"beta"', '["E"]'}
    jobs.update_lake(spark, staged, lake, DATE)
    annual = {(r.symbol, str(r.date)): (r.eps, r.pe) for r in writers.lake_read(spark, f"{lake}/annual_metric_fact").collect()}
    assert annual["A", "2022-12-31"] == (None, None) and annual["A", "2021-12-31"] == (4.0, None) and annual["A", "None"] == (3.0, None)
    assert annual["B", "2023-06-30"] == (2.5, None)
    metric = {r.symbol: r.beta for r in writers.lake_read(spark, f"{lake}/metric_fact").collect()}
    assert metric == {"A": 1.0, "B": None, "C": 2.0}


def test_passthrough_reaches_the_facts(spark):  # P10, F5
    docs = [{"symbol": s, "metricType": "all", "rank": r, "type": "t", "metric": {"beta": 1}, "series": {"annual": {"eps": POINTS}, "quarterly": {"eps": POINTS}}} for s, r in (("A", 1), ("B", "x"))]
    root = land(spark, *docs)
    for way in (True, {"rank": T.StringType(), "type": T.StringType(), "metricType": T.StringType()}):
        staged, lake = scratch_path(spark, "staging"), scratch_path(spark, "lake")
        jobs.transform_landing(spark, root, staged, DATE, passthrough=way)
        jobs.update_lake(spark, staged, lake, DATE)
        for name, rows in (("annual_metric", 4), ("quarterly_metric", 4), ("metric", 2)):
            fact = writers.lake_read(spark, f"{lake}/{name}_fact").collect()
            assert len(fact) == rows and {(r.symbol, r["rank"], r.metricType, r.metric_type) for r in fact} == {("A", "1", "all", "t"), ("B", "x", "all", "t")}


def test_documents_of_garbage_are_flagged(spark):  # S5
    df = spark.createDataFrame([('{"symbol": "A"}',), ("junk",), (None,)], "doc string")
    got = [(r.symbol, r._corrupt_record) for r in parse_documents(df, flagged=True).collect()]
    assert sorted(got, key=str) == [("A", None), (None, "junk"), (None, None)]
    assert parse_documents(df, fields=["symbol"]).columns == ["symbol"]


@pytest.mark.parametrize(("a", "b", "want"), [
    ("int", "bigint", "bigint"), ("tinyint", "double", "double"), ("decimal(5,2)", "bigint", "double"), ("float", "float", "float"),
    ("date", "timestamp", "timestamp"), ("boolean", "int", "string"), ("array<int>", "int", "string"), ("void", "date", "date"), ("string", "double", "string")])
def test_widening(a, b, want):
    x, y = (T.NullType() if s == "void" else T.StructType.fromDDL(f"c {s}")["c"].dataType for s in (a, b))
    assert wider(x, y).simpleString() == wider(y, x).simpleString() == want
    assert widest([x, y, x]) == wider(x, y)


def test_widening_casts(spark):
    row = spark.range(1).select(cast_to(F.array(F.lit(1)), T.ArrayType(T.IntegerType()), T.StringType()).alias("a"), cast_to(F.lit(1.5), T.DoubleType(), T.StringType()).alias("b")).first()
    assert tuple(row) == ("[1]", "1.5")


def test_parse_of_a_date_without_landing(spark):
    root = scratch_path(spark, "landing")
    assert landing.scan_date_variant(spark, root, DATE).collect() == []
