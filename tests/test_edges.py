"""Edge documents (one per semantic decision D1-D23), small and inline."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessel.functions.json import parse_documents
from tessel.functions.schema import DOC_SCHEMA
from tessel.operators import facts, quality, reshape, series
from tessel.plans import staging

D = dt.date


def docs_of(spark, *texts):
    return parse_documents(spark.createDataFrame([(t,) for t in texts], "doc string"))


def doc(symbol, metric=None, **freqs):
    body = {"symbol": symbol, "metric": metric or {}}
    if freqs:
        body["series"] = {f: {m: [{"period": p, "v": v} for p, v in pts] for m, pts in ms.items()}
                          for f, ms in freqs.items()}
    return json.dumps(body)


MISALIGNED = doc("AAA", {"x": 1}, annual={
    "a": [("2024-01-01", 1.0), ("2023-01-01", 2.0)],
    "b": [("2023-01-01", 20.0)],
})


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_misaligned_position_vs_period(spark):  # D1
    d = docs_of(spark, MISALIGNED)
    pos = series.align_freq(d, "annual", ["a", "b"], "position")
    assert rows(pos, "date", "a", "b") == [(D(2023, 1, 1), 2.0, None), (D(2024, 1, 1), 1.0, 20.0)]
    per = series.align_freq(d, "annual", ["a", "b"], "period")
    assert rows(per, "date", "a", "b") == [(D(2023, 1, 1), 2.0, 20.0), (D(2024, 1, 1), 1.0, None)]


def test_empty_array_and_missing_metric(spark):  # D22, D23
    d = docs_of(spark, doc("E", annual={"a": [("2024-01-01", 1.0)], "b": []}),
                doc("F", annual={"a": [("2024-01-01", 3.0)]}))
    out = series.align_freq(d, "annual", ["a", "b"], "position")
    assert rows(out, "symbol", "a", "b") == [("E", 1.0, None), ("F", 3.0, None)]
    cat = reshape.metric_catalog(d)
    assert rows(cat, "metric", "n_symbols") == [("a", 2)]


@pytest.mark.parametrize("text", [
    json.dumps({"symbol": "N", "metric": {"x": "1"}, "series": None}),
    json.dumps({"symbol": "N", "metric": {"x": "1"}, "series": {}}),
    json.dumps({"symbol": "N", "metric": {"x": "1"}}),
])
def test_no_series(spark, text):  # W2, D10
    d = docs_of(spark, text)
    assert reshape.has_series(d).count() == 0
    typed = reshape.typed_union(d, ["x"], ["a"])
    assert rows(typed, "type", "symbol") == [("metric", "N")]
    st = staging.stage(d, ["x"], ["a"])
    assert st.metric.count() == 1 and st.quarterly_metric.count() == 0


def test_annual_only_is_metric_only_at_split(spark):  # D9, W3
    d = docs_of(spark, doc("A1", {"x": "2"}, annual={"a": [("2024-01-01", 1.0)]}),
                doc("B2", {"x": "3"}, annual={"a": [("2024-01-01", 5.0)]},
                    quarterly={"a": [("2024-01-01", 4.0)]}))
    typed = reshape.typed_union(d, ["x"], ["a"])
    assert rows(reshape.series_bearing(typed), "symbol") == [("B2",)]
    m, q, a = reshape.split_typed(typed)
    assert rows(m, "symbol") == [("A1",), ("B2",)]
    assert rows(a, "symbol", "annual_a") == [("B2", 5.0)]
    assert q.columns == ["date", "symbol", "quarterly_a"]


def test_text_metric_becomes_null(spark):  # D6
    d = docs_of(spark, doc("T", {"hi": "2024-01-02", "n": 5}))
    st = staging.stage(d, ["hi", "n"], [])
    f = facts.metric_fact(st.metric).collect()[0]
    assert f["hi"] is None and f["n"] == 5.0
    rep = quality.quality_report(st.metric, ["symbol"], ["hi", "n"])
    assert rows(rep, "column_name", "n_bad_cast") == [("hi", 1), ("n", 0)]


def test_one_annual_metric_keeps_all_columns(spark):  # D3
    d = docs_of(spark, doc("O", {"x": "1"}, annual={"a": [("2024-01-01", 1.0)]},
                           quarterly={"a": [("2024-01-01", 1.0)]}))
    _, q, a = staging.stage(d, ["x"], ["a"]).tables()
    assert a.columns == ["date", "symbol", "annual_a"] and a.count() == 1


def test_dotted_symbols_stay_distinct(spark):  # D12
    d = docs_of(spark, doc("X.A", {"x": "1"}), doc("X.B", {"x": "2"}))
    assert rows(reshape.metric_wide(d, ["x"]), "symbol", "x") == [("X.A", "1"), ("X.B", "2")]


def test_metric_named_like_period(spark):  # D7
    d = docs_of(spark, doc("P", annual={"periodEnd": [("2024-01-01", 7.0)]}))
    out = series.align_freq(d, "annual", ["periodEnd"], "position")
    assert rows(out, "date", "periodEnd") == [(D(2024, 1, 1), 7.0)]


def test_duplicate_period_takes_max(spark):
    d = docs_of(spark, doc("DUP", annual={"a": [("2024-01-01", 1.0), ("2024-01-01", 3.0)]}))
    assert rows(series.align_freq(d, "annual", ["a"], "period"), "a") == [(3.0,)]
    assert rows(series.align_freq(d, "annual", ["a"], "position"), "a") == [(1.0,), (3.0,)]


def test_null_value(spark):
    d = docs_of(spark, doc("NV", annual={"a": [("2024-01-01", None)]}))
    out = series.align_freq(d, "annual", ["a"], "period")
    assert rows(out, "date", "a") == [(D(2024, 1, 1), None)]


def test_key_order_and_single_quotes(spark):  # D11, S5
    a = '{"series": {}, "metric": {"x": 1}, "symbol": "K"}'
    b = "{'symbol': 'K', 'metric': {'x': 1}}"
    d = docs_of(spark, a, b)
    assert rows(reshape.metric_wide(d, ["x"]), "symbol", "x") == [("K", "1"), ("K", "1")]


def test_corrupt_document_is_quarantined(spark):  # Q1, D8
    texts = spark.createDataFrame([(MISALIGNED,), (MISALIGNED[:-5],)], "doc string")
    good, bad = quality.split_quarantine(texts, "doc", DOC_SCHEMA)
    assert good.count() == 1
    assert rows(bad, "reason") == [("malformed json",)]


def test_no_rows(spark):  # D10, U3
    d = parse_documents(spark.createDataFrame([], "doc string"))
    st = staging.stage(d, ["x"], ["a"])
    f = staging.to_facts(st)
    assert f.quarterly_metric.count() == 0
    assert f.quarterly_metric.columns == ["date", "symbol", "a"]


def test_series_long_positions(spark):
    d = docs_of(spark, MISALIGNED)
    out = series.to_long(d)
    assert rows(out, "metric", "pos", "date") == [
        ("a", 0, D(2024, 1, 1)), ("a", 1, D(2023, 1, 1)), ("b", 0, D(2023, 1, 1))]


def test_fact_keep_source(spark):  # D4
    d = docs_of(spark, doc("S", annual={"a": [("2024-01-01", 1.5)]}, quarterly={"a": [("2024-01-01", 1.0)]}))
    st = staging.stage(d, [], ["a"])
    f = facts.series_fact(st.annual_metric.withColumnRenamed("annual_a", "annual.a"), keep_source=True)
    assert f.columns == ["date", "symbol", "annual.a", "a"]
    assert f.select(F.col("a")).collect()[0][0] == 1.5


def test_union_nulls_are_typed(spark):  # D2
    d = docs_of(spark, doc("S", {"x": "1"}, annual={"a": [("2024-01-01", 1.5)]},
                           quarterly={"a": [("2024-01-01", 1.0)]}))
    t = reshape.typed_union(d, ["x"], ["a"])
    types = dict(t.dtypes)
    assert types["x"] == "string" and types["quarterly_a"] == "double" and types["annual_a"] == "double"
    metric_row = t.filter(F.col("type") == "metric").collect()[0]
    assert metric_row["quarterly_a"] is None and metric_row["x"] == "1"
    annual_row = t.filter(F.col("type") == "annual_metric").collect()[0]
    assert annual_row["annual_a"] == 1.5 and isinstance(annual_row["annual_a"], float)


def test_fact_symbol_is_a_real_string_cast(spark):  # D5
    staged = spark.createDataFrame([(D(2024, 1, 1), 42, "2.5")], "date date, symbol int, quarterly_a string")
    f = facts.series_fact(staged)
    assert dict(f.dtypes) == {"date": "date", "symbol": "string", "quarterly_a": "float"}
    assert f.collect()[0]["symbol"] == "42"


def test_symbol_first_in_every_staging_table(spark):  # D21, P15
    d = docs_of(spark, doc("S", {"x": "1"}, annual={"a": [("2024-01-01", 1.5)]},
                           quarterly={"a": [("2024-01-01", 1.0)]}),
                doc("M", {"x": "2"}))
    st = staging.stage(d, ["x"], ["a"])
    assert st.metric.columns[0] == "symbol"
    assert st.quarterly_metric.columns[:2] == ["date", "symbol"]
    assert st.annual_metric.columns[:2] == ["date", "symbol"]
    assert sorted(r.symbol for r in st.metric.collect()) == ["M", "S"]


def test_quality_duplicates_are_null_safe(spark):  # Q2
    df = spark.createDataFrame(
        [("S", None, 1.0), ("T", None, 2.0), ("S", D(2024, 1, 1), 3.0), ("S", D(2024, 1, 1), None),
         ("U", None, 4.0), ("U", None, 5.0)], "symbol string, date date, a double")
    r = quality.quality_report(df, ["symbol", "date"], ["a"]).collect()[0]
    # (S, 2024-01-01) and (U, null) each appear twice: two rows beyond the first
    assert (r.n, r.n_null, r.n_bad_cast, r.n_dup_keys) == (6, 1, 0, 2)
