"""tessel: document-shaped series data on Spark DataFrames.

Typical use::

    from tessel import parse_documents, stage, to_facts
    docs = parse_documents(spark.read.text(path).withColumnRenamed("value", "doc"))
    facts = to_facts(stage(docs, metric_keys, series_metrics, align_mode="period"))
    facts.quarterly_metric.write.parquet(out)
"""

from .functions.json import parse_documents, parse_json, with_quarantine
from .functions.schema import DOC_SCHEMA
from .operators.joins import new_keys, zip_join
from .operators.series import (align, align_freq, doc_freq_full_outer, freq_full_outer, full_outer_series,
                               to_long)
from .plans.staging import discover_metrics, legacy_wide, stage, to_facts

__all__ = [
    "DOC_SCHEMA", "align", "align_freq", "discover_metrics", "doc_freq_full_outer", "freq_full_outer",
    "full_outer_series", "legacy_wide", "new_keys", "parse_documents", "parse_json", "stage", "to_facts",
    "to_long", "with_quarantine", "zip_join",
]
