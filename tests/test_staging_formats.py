"""Staging in formats that keep no column metadata."""

import json

import pytest

from tessel.plans import jobs
from tessel.session import scratch_path
from tessel.sinks import writers

DATE = "2024-01-07"
POINTS = [{"period": "2023-03-31", "v": 1.5}, {"period": "2023-06-30", "v": None}]
DOCS = [
    {"symbol": "A", "metric": {"beta": "0.5", "say": ' two\nlines, "quoted" \\" '}, "series": {"quarterly": {"eps": POINTS}, "annual": {"eps": POINTS, "beta": POINTS[:1]}}},
    {"symbol": "B", "metric": {"say": ""}, "series": {"quarterly": {"eps": POINTS[1:]}, "annual": {"beta": POINTS}}},
]
LINES = [*map(json.dumps, DOCS), '{"symbol": "C", "metric": {"say": "\\"cut']


@pytest.fixture(scope="module")
def landed(spark):
    root = scratch_path(spark, "landing")
    spark.createDataFrame([(x,) for x in LINES], "value string").write.text(f"{root}/{writers.DATE_COL}={DATE}")
    return root


def through(spark, landed, fmt):
    """What staging of a format becomes in the lake, and its quarantine."""
    staged, lake = scratch_path(spark, "staging"), scratch_path(spark, "lake")
    jobs.transform_landing(spark, landed, staged, DATE, fmt=fmt)
    jobs.update_lake(spark, staged, lake, DATE, fmt=fmt)
    frames = [spark.read.parquet(f"{lake}/{t}_fact") for t in jobs.STAGING_TABLES]
    frames.append(jobs.read_quarantine(spark, staged, DATE, fmt))
    return [(f.dtypes, sorted(map(tuple, f.collect()), key=repr)) for f in frames]


@pytest.mark.parametrize("fmt", ["json", "csv", "orc"])
def test_same_facts_as_from_parquet(spark, landed, fmt):
    want = through(spark, landed, "parquet")
    assert any(1.5 in r for r in want[1][1]) and any(1.5 in r for r in want[2][1]) and len(want[3][1]) == 1
    assert through(spark, landed, fmt) == want


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_staging_without_column_groups_raises(spark, fmt):
    staged = scratch_path(spark, "staging")
    old = spark.createDataFrame([("quarterly_metric", "A", 1.5)], "type string, symbol string, quarterly_eps double")
    old.write.format(fmt).partitionBy("type").save(writers.stage_path(staged, DATE, "typed"))
    with pytest.raises(ValueError, match="column groups"):
        jobs.update_lake(spark, staged, scratch_path(spark, "lake"), DATE, fmt=fmt)
