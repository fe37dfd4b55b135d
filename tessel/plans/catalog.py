"""Query catalogue: every operator of the inventory as a runnable query.

Each entry takes ``(spark, sf_dir)``, reads the driver tables (or documents
Spark derives from them) and returns a DataFrame; those about sinks run their
write jobs first and return what is read back. Column names match the DuckDB
oracles in :mod:`tessel.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casts, keys
from ..functions.json import parse_documents, parse_json
from ..functions.schema import DOC_SCHEMA, FREQS
from ..operators import facts, joins, nested, quality, reshape, series
from ..session import scratch_path
from ..sinks import writers
from ..sources import directory, landing
from ..sources.fixtures import METRIC_KEYS, SERIES_METRICS, document_text, documents
from ..sources.tables import table
from ..streaming import ingest
from . import staging

# Fixed values used by the catalogue's queries.
SOURCE_NAME = "fundamentals"
DIRECTORY_REGION = "AMERICA"
NEW_KEY_CUTOFF = "1996-01-01"
SNAPSHOTS = ("2024-01-07", "2024-01-14")
SCAN_DATE = "2024-01-15"
WAREHOUSE_DB = "core"
SMALL_BALANCE = 1000  # parts the documents of the made cases
PROPS_SCHEMA = T.StructType([T.StructField("k", T.LongType())])
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def docs(spark: SparkSession, sf_dir: str, gappy: bool = False, fields: Sequence[str] | None = None) -> DataFrame:
    """Landed document text parsed with the declared schema, or some of its fields."""
    return parse_documents(document_text(spark, sf_dir, gappy), fields=fields)


# --- series alignment (R1, R2, P5, P8, J2) ------------------------------------

@query("series_annual_position")
def series_annual_position(spark, sf_dir):
    return series.align_freq(docs(spark, sf_dir), "annual", SERIES_METRICS, "position")


@query("series_quarterly_position")
def series_quarterly_position(spark, sf_dir):
    return series.align_freq(docs(spark, sf_dir), "quarterly", SERIES_METRICS, "position")


@query("series_annual_period")
def series_annual_period(spark, sf_dir):
    return series.align_freq(docs(spark, sf_dir), "annual", SERIES_METRICS, "period")


@query("series_quarterly_period")
def series_quarterly_period(spark, sf_dir):
    return series.align_freq(docs(spark, sf_dir), "quarterly", SERIES_METRICS, "period")


# --- facts (F1-F4, C1-C4) -----------------------------------------------------

def _facts(spark, sf_dir, align_mode="period") -> staging.Facts:
    st = staging.stage(docs(spark, sf_dir), METRIC_KEYS, SERIES_METRICS, align_mode)
    return staging.to_facts(st)


@query("fact_quarterly")
def fact_quarterly(spark, sf_dir):
    return _facts(spark, sf_dir).quarterly_metric


@query("fact_annual")
def fact_annual(spark, sf_dir):
    return _facts(spark, sf_dir).annual_metric


@query("fact_metric")
def fact_metric(spark, sf_dir):
    st = staging.stage(docs(spark, sf_dir, fields=["symbol", "metric"]), METRIC_KEYS, SERIES_METRICS)
    return staging.to_facts(st).metric


# --- documents and series reshaping ------------------------------------------

@query("series_long")
def series_long(spark, sf_dir):
    return series.to_long(docs(spark, sf_dir))


@query("series_full_outer")
def series_full_outer(spark, sf_dir):
    return series.full_outer_series(docs(spark, sf_dir), FREQS, SERIES_METRICS)


@query("freq_full_outer")
def freq_full_outer(spark, sf_dir):
    """J3 on documents: both frequencies side by side, aligned per document."""
    return series.doc_freq_full_outer(docs(spark, sf_dir), SERIES_METRICS)


@query("legacy_wide")
def legacy_wide(spark, sf_dir):
    return staging.legacy_wide(docs(spark, sf_dir), METRIC_KEYS, SERIES_METRICS)


@query("metric_long")
def metric_long(spark, sf_dir):
    return reshape.metric_long(docs(spark, sf_dir, fields=["symbol", "metric"]))


@query("attach_constant")
def attach_constant(spark, sf_dir):
    return reshape.attach_constant(docs(spark, sf_dir, fields=["symbol"]), source=SOURCE_NAME)


@query("metric_catalog")
def metric_catalog(spark, sf_dir):
    return reshape.metric_catalog(docs(spark, sf_dir))


@query("metric_width")
def metric_width(spark, sf_dir):
    return reshape.metric_width(docs(spark, sf_dir))


@query("has_series")
def has_series(spark, sf_dir):
    return reshape.has_series(docs(spark, sf_dir, gappy=True)).select("symbol")


def _typed(spark, sf_dir, align_mode="period"):
    d = docs(spark, sf_dir)
    return reshape.typed_union(d, METRIC_KEYS, SERIES_METRICS, align_mode)


@query("typed_union")
def typed_union(spark, sf_dir):
    return _typed(spark, sf_dir)


@query("typed_union_position")
def typed_union_position(spark, sf_dir):
    return _typed(spark, sf_dir, align_mode="position")


@query("type_counts")
def type_counts(spark, sf_dir):
    return reshape.type_counts(_typed(spark, sf_dir))


@query("series_bearing")
def series_bearing(spark, sf_dir):
    return reshape.series_bearing(_typed(spark, sf_dir))


@query("split_typed")
def split_typed(spark, sf_dir):
    """F2 from documents: W3 decided per document, no shuffle."""
    return staging.stage(docs(spark, sf_dir), METRIC_KEYS, SERIES_METRICS).quarterly_metric


@query("split_typed_gappy_annual")
def split_typed_gappy_annual(spark, sf_dir):
    """F2 on an already-typed frame (general form: grouped W3 + semi join)."""
    return reshape.split_typed(_typed(spark, sf_dir))[2]


@query("ragged_union")
def ragged_union(spark, sf_dir):
    d = docs(spark, sf_dir)
    first = reshape.metric_wide(d, ["s_acctbal", "s_nationkey"]).withColumn("snapshot", F.lit("a"))
    second = reshape.metric_wide(d, ["firstShip", "s_acctbal"]).withColumn("snapshot", F.lit("b"))
    return reshape.union_ragged([first, second])


# --- documents of undeclared shape (VARIANT) ---------------------------------

def _wild_text(spark, sf_dir):
    """Documents whose shape no schema declares: other top-level fields, one of them of two types; metrics nested two
    and three deep, with an empty object and an array between; points without a ``v`` where a frequency is short."""
    d = documents(spark, sf_dir)
    nation, balance = F.col("metric")["s_nationkey"].cast("int"), F.col("metric")["s_acctbal"].cast("double")
    place = F.struct(nation.alias("nation"), F.struct(F.col("metric")["firstShip"].alias("first"), nation.alias("port")).alias("ship"))
    metric = F.struct(F.col("metric")["firstShip"].alias("since"), place.alias("place"), F.create_map().cast("map<string,int>").alias("none"),
                      F.array(nation, nation).alias("codes"), F.struct(balance.alias("usd.cents")).alias("balance"))
    notes = F.array(F.struct(F.col("symbol").alias("by"), nation.alias("rank")))

    def text(code, mark):
        return F.to_json(F.struct("symbol", metric.alias("metric"), "series", F.lit("all").alias("metricType"), (balance < SMALL_BALANCE).alias("small"),
                                  nation.alias("nation"), code.alias("code"), F.struct(notes.alias("notes"), mark.alias("mark")).alias("profile")))

    text = F.when(balance < SMALL_BALANCE, text(F.col("symbol"), balance)).otherwise(text(nation, nation))
    return d.select(text.alias("doc"))


def _wild(spark, sf_dir):
    """The declared fields, and all others as a map of VARIANT."""
    doc = F.try_parse_json("doc")
    parsed = parse_json(F.col("doc"), DOC_SCHEMA)
    once = _wild_text(spark, sf_dir).select(F.inline(F.array(F.struct(parsed.alias("p"), doc.alias("v")))))
    return once.select("p.*", nested.rest(F.col("v")).alias(nested.REST))


@query("doc_passthrough")
def doc_passthrough(spark, sf_dir):
    """P10: the other top-level scalars, found in the data, on every metric and series row."""
    d = _wild(spark, sf_dir)
    d, names = nested.with_scalars(d, nested.scalar_fields(d))
    typed = reshape.typed_union(d, ["since"], SERIES_METRICS, passthrough=names)
    return typed.select("type", "symbol", "date", "since", "annual_sales", *names)


@query("legacy_wide_passthrough")
def legacy_wide_passthrough(spark, sf_dir):
    """F5 with the other top-level scalars repeated beside the metrics."""
    d = _wild(spark, sf_dir)
    d, names = nested.with_scalars(d, nested.scalar_fields(d))
    return staging.legacy_wide(d, ["since"], SERIES_METRICS, names).select("symbol", "date", "since", "annual_sales", "quarterly_sales", *names)


@query("passthrough_fact")
def passthrough_fact(spark, sf_dir):
    """P10 through the jobs: fields found in the landing reach staging and the fact in the lake, with their types."""
    from . import jobs
    root, staged, lake = (scratch_path(spark, x) for x in ("wild-landing", "staging", "lake"))
    _wild_text(spark, sf_dir).write.text(f"{root}/{writers.DATE_COL}={SNAPSHOTS[0]}")
    jobs.transform_landing(spark, root, staged, SNAPSHOTS[0], ["since"], SERIES_METRICS, passthrough=True)
    jobs.update_lake(spark, staged, lake, SNAPSHOTS[0], ["annual_metric"])
    return writers.lake_read(spark, f"{lake}/annual_metric_fact")


@query("metric_flatten")
def metric_flatten(spark, sf_dir):
    """Nested metrics under dotted names; the empty object and the array are left out."""
    d = _wild_text(spark, sf_dir).select(F.get_json_object("doc", "$.symbol").alias("symbol"), F.try_parse_json("doc").alias("v"))
    d = d.select("symbol", F.try_variant_get("v", "$.metric", "variant").alias("metric"))
    return reshape.metric_long(nested.flatten_metrics(d))


def _wild_paths(spark, sf_dir):
    return nested.paths(_wild_text(spark, sf_dir).select(F.try_parse_json("doc").alias("doc")))


@query("schema_paths")
def schema_paths(spark, sf_dir):
    """Every path of the documents with the kinds found there."""
    return _wild_paths(spark, sf_dir)


@query("schema_arrays")
def schema_arrays(spark, sf_dir):
    """P2 as data: the arrays of objects inside the documents."""
    return nested.object_arrays(_wild_paths(spark, sf_dir))


@query("schema_leaves")
def schema_leaves(spark, sf_dir):
    """P3 as data: the fields of those arrays' elements, with the type that holds all their values."""
    return nested.array_fields(_wild_paths(spark, sf_dir))


# --- directory, keys, joins ---------------------------------------------------

@query("symbol_directory")
def symbol_directory(spark, sf_dir):
    """Equality predicates on the record (segment) and on its
    listing region (a dimension attribute, as the exchange is for a symbol)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    listed = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    pred = ((F.col("c_mktsegment") == "BUILDING") & (F.col("r_name") == DIRECTORY_REGION)
            & (F.col("c_acctbal") > 0))
    return directory.sorted_symbols(directory.directory(listed, "c_name", pred))


@query("symbol_top100")
def symbol_top100(spark, sf_dir):
    return directory.first_symbols(directory.directory(table(spark, sf_dir, "customer"), "c_name"), 100)


@query("documents_for_symbols")
def documents_for_symbols(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier")
    wanted = directory.directory(sup, "s_name", F.col("s_acctbal") > 0)
    n_freq = F.when(F.col("series").isNull(), F.lit(0)).otherwise(F.size("series"))
    counted = docs(spark, sf_dir, fields=["symbol", "series"]).select("symbol", n_freq.cast("int").alias("n_freq"))
    return directory.for_symbols(counted, wanted)


@query("json_parse_props")
def json_parse_props(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", parse_json(F.col("props"), PROPS_SCHEMA)["k"].alias("k"))


@query("parquet_scan")
def parquet_scan(spark, sf_dir):
    """A parquet read; only the selected columns reach the scan."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query("path_to_key")
def path_to_key(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", keys.path_key("url").alias("key"))


@query("fanout_key")
def fanout_key(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    meta = F.concat(F.lit("stock_"), F.col("event_type"),
                    F.when(F.col("value") >= 100, F.lit(".A")).otherwise(F.lit("")), F.lit("_path"))
    return ev.select("event_id", keys.fanout_key(meta).alias("key"))


@query("zip_join")
def zip_join(spark, sf_dir):
    """The i-th customer (by key) beside the i-th order (by key); the longer side's rest is padded."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return joins.zip_join(cust, ["c_custkey"], orders, ["o_orderkey"], pad=True) \
        .select("rn", "c_name", "o_orderkey", "o_totalprice")


@query("new_symbols")
def new_symbols(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    cutoff = F.lit(NEW_KEY_CUTOFF).cast("date")
    return joins.new_keys(o.filter(F.col("o_orderdate") >= cutoff),
                          o.filter(F.col("o_orderdate") < cutoff), ["o_custkey"])


@query("snapshot_partition")
def snapshot_partition(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.to_date("ts").alias("snapshot_date")).agg(F.count(F.lit(1)).alias("n")) \
        .select("snapshot_date", casts.date_label("snapshot_date").alias("label"), "n")


# --- quality -----------------------------------------------------------------

@query("quarantine")
def quarantine(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    # Error events carry their type's plain name, which is no JSON.
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("props"))
    return quality.quarantine_counts(ev.select("event_id", text.alias("props")), "props", PROPS_SCHEMA)


@query("quality_report")
def quality_report(spark, sf_dir):
    st = staging.stage(docs(spark, sf_dir), METRIC_KEYS, SERIES_METRICS)
    return quality.quality_report(st.metric, ["symbol"], list(METRIC_KEYS))


@query("quality_report_quarterly")
def quality_report_quarterly(spark, sf_dir):
    return quality.quality_report(fact_quarterly(spark, sf_dir), ["symbol", "date"], list(SERIES_METRICS))


@query("to_json_doc")
def to_json_doc(spark, sf_dir):
    return document_text(spark, sf_dir).select(
        F.get_json_object("doc", "$.symbol").alias("symbol"), F.col("doc").alias("raw"))


# --- sinks and scans (write to a fresh folder under spark.checkpoint.dir) ----

def _events_landing(spark, sf_dir) -> str:
    ev = table(spark, sf_dir, "events").withColumn(writers.DATE_COL, F.to_date("ts"))
    return writers.land_json(ev.drop("ts"), scratch_path(spark, "events-landing"))


@query("raw_write_read")
def raw_write_read(spark, sf_dir):
    root = _events_landing(spark, sf_dir)
    full = landing.with_partitions(EVENT_SCHEMA, T.StructField(writers.DATE_COL, T.DateType()))
    return landing.read_json(spark, root, full).select("event_id", writers.DATE_COL, "value")


@query("raw_scan_date")
def raw_scan_date(spark, sf_dir):
    root = _events_landing(spark, sf_dir)
    return landing.scan_date(spark, root, EVENT_SCHEMA, SCAN_DATE).select("event_id", writers.DATE_COL, "value")


@query("fallback_scan")
def fallback_scan(spark, sf_dir):
    """The date's primary path was never written, so the same date of the
    backcompat landing is read instead."""
    legacy = _events_landing(spark, sf_dir)
    primary = scratch_path(spark, "events-primary")  # nothing lands here
    part = f"{writers.DATE_COL}={SCAN_DATE}"
    df = landing.read_with_fallback(spark, f"{primary}/{part}", f"{legacy}/{part}", EVENT_SCHEMA)
    return df.select("event_id", "value")


@query("landed_fact_quarterly")
def landed_fact_quarterly(spark, sf_dir):
    root = writers.land_json(documents(spark, sf_dir).drop("suppkey"),
                             scratch_path(spark, "doc-landing"), SNAPSHOTS[0])
    landed = landing.scan_date(spark, root, DOC_SCHEMA, SNAPSHOTS[0])
    st = staging.stage(landed, METRIC_KEYS, SERIES_METRICS)
    return staging.to_facts(st).quarterly_metric


@query("write_manifest")
def write_manifest(spark, sf_dir):
    root = writers.land_json(documents(spark, sf_dir).drop("suppkey"),
                             scratch_path(spark, "doc-landing"), SNAPSHOTS[0])
    landed = landing.scan_date(spark, root, DOC_SCHEMA, SNAPSHOTS[0])
    in_path = F.regexp_extract("file_path", f"{writers.DATE_COL}=([^/]+)/", 1)
    return writers.manifest(landed).select("symbol", writers.DATE_COL, in_path.alias("path_date"))


@query("staging_roundtrip")
def staging_roundtrip(spark, sf_dir):
    st = staging.stage(docs(spark, sf_dir), METRIC_KEYS, SERIES_METRICS)
    root = scratch_path(spark, "staging")
    writers.stage_write(st.quarterly_metric, root, "quarterly_metric", SNAPSHOTS[0])
    return landing.stage_read(spark, root, "quarterly_metric", SNAPSHOTS[0])


@query("parquet_pair")
def parquet_pair(spark, sf_dir):
    d = docs(spark, sf_dir)
    root = scratch_path(spark, "parquet-pair")
    wide = series.full_outer_series(d, FREQS, SERIES_METRICS)
    met = reshape.metric_wide(d, METRIC_KEYS)
    cols = [writers.DATE_COL, "symbol"]
    writers.write_partitioned(writers.with_snapshot(met, SNAPSHOTS[0]), f"{root}/metrics", partition_cols=cols, as_dealt=True)
    writers.write_partitioned(writers.with_snapshot(wide, SNAPSHOTS[0]), f"{root}/series", partition_cols=cols, as_dealt=True)
    schema = T.StructType([f for f in wide.schema.fields if f.name != "symbol"]
                          + [T.StructField(writers.DATE_COL, T.DateType()), T.StructField("symbol", T.StringType())])
    return landing.read_folders(spark, lambda s, o: spark.read.schema(s).options(**o).parquet(f"{root}/series"), schema, [writers.DATE_COL, "symbol"])


@query("parquet_pair_metrics")
def parquet_pair_metrics(spark, sf_dir):
    """K5, the other half: the metric rows, by date and symbol folders."""
    root = scratch_path(spark, "parquet-pair")
    met = writers.with_snapshot(reshape.metric_wide(docs(spark, sf_dir), METRIC_KEYS), SNAPSHOTS[0])
    writers.write_partitioned(met, f"{root}/metrics", partition_cols=[writers.DATE_COL, "symbol"], as_dealt=True)
    schema = T.StructType([*[T.StructField(k, T.StringType()) for k in METRIC_KEYS],
                           T.StructField(writers.DATE_COL, T.DateType()), T.StructField("symbol", T.StringType())])
    return landing.read_folders(spark, lambda s, o: spark.read.schema(s).options(**o).parquet(f"{root}/metrics"), schema, [writers.DATE_COL, "symbol"])


@query("warehouse_table")
def warehouse_table(spark, sf_dir):
    root = scratch_path(spark, "warehouse")
    name = writers.warehouse_save(spark, fact_annual(spark, sf_dir), f"{WAREHOUSE_DB}_{root[-12:]}",
                                  "annual_metric_fact", f"{root}/{WAREHOUSE_DB}.db")
    return spark.table(name)


@query("lake_append")
def lake_append(spark, sf_dir):
    path = scratch_path(spark, "lake") + "/annual_metric_fact"
    fact = fact_annual(spark, sf_dir)
    for d in SNAPSHOTS:
        writers.lake_append(fact, path, d)
    return writers.lake_read(spark, path)


@query("lake_drift")
def lake_drift(spark, sf_dir):
    """K3 over drifting schemas: the second date brings another metric; the first is replaced by nothing, then by all."""
    path = scratch_path(spark, "lake") + "/annual_metric_fact"
    fact = fact_annual(spark, sf_dir)
    writers.lake_replace(fact.drop("sales"), path, SNAPSHOTS[0])
    writers.lake_replace(fact, path, SNAPSHOTS[1])
    writers.lake_replace(fact.limit(0), path, SNAPSHOTS[1])
    writers.lake_replace(fact, path, SNAPSHOTS[1])
    writers.lake_replace(fact, path, "2024-01-21")
    writers.lake_replace(fact.limit(0), path, "2024-01-21")
    return writers.lake_read(spark, path)


@query("awkward_keys")
def awkward_keys(spark, sf_dir):
    """Metric keys named like frequencies, keys and paths reach the metric fact under their own names."""
    names = {"annual_yield": "s_acctbal", "quarterly_x.y": "s_nationkey", "date": "s_acctbal", "type": "s_nationkey"}
    renamed = F.map_from_arrays(F.array(*[F.lit(k) for k in names]), F.array(*[F.col("metric")[v] for v in names.values()]))
    d = docs(spark, sf_dir).withColumn("metric", renamed)
    typed = reshape.typed_union(d, list(names), SERIES_METRICS)
    path = writers.stage_write_typed(typed, scratch_path(spark, "staging"), SNAPSHOTS[0])
    metric = facts.metric_fact(reshape.split_by_type(spark.read.parquet(path))[0])
    return metric.withColumnRenamed("quarterly_x.y", "quarterly_x_y")


@query("landing_quarantine")
def landing_quarantine(spark, sf_dir):
    """Q1 in the job: lines that are no JSON go to the quarantine, and one value that does not fit costs that value alone.

    To make the cases, nation names land beside the documents, and the first
    value of each document with a small balance is put in words.
    """
    from . import jobs
    spoilt = F.regexp_replace("doc", '^(.*?"v":)[0-9.]+', '$1"unknown"')
    below = F.get_json_object("doc", "$.metric.s_acctbal").cast("double") < SMALL_BALANCE
    texts = document_text(spark, sf_dir).select(F.when(below, spoilt).otherwise(F.col("doc")).alias("doc"))
    lines = texts.unionByName(table(spark, sf_dir, "nation").select(F.col("n_name").alias("doc")))
    root, staged = scratch_path(spark, "mixed-landing"), scratch_path(spark, "staging")
    lines.write.text(f"{root}/{writers.DATE_COL}={SNAPSHOTS[0]}")
    jobs.transform_landing(spark, root, staged, SNAPSHOTS[0])
    good, _, annual = reshape.split_by_type(landing.stage_read_typed(spark, staged, SNAPSHOTS[0]))
    values = annual.groupBy("symbol").agg(*[F.count(f"annual_{m}").alias(f"n_{m}") for m in SERIES_METRICS])
    bad = jobs.read_quarantine(spark, staged, SNAPSHOTS[0])
    return good.select("symbol").join(values, "symbol", "left").unionByName(bad, allowMissingColumns=True)


@query("discovered_metrics")
def discovered_metrics(spark, sf_dir):
    """Names by side, where the frequencies differ (no quarterly sales)."""
    d = docs(spark, sf_dir).withColumn("series", F.transform_values("series", lambda f, m: F.when(
        f == "quarterly", F.map_filter(m, lambda k, _: k != "sales")).otherwise(m)))
    metric, found = staging.discover_metrics(d)
    rows = [("metric", k) for k in metric] + [(f, k) for f, ks in found.items() for k in ks]
    return spark.createDataFrame(rows, "side string, name string")


@query("warehouse_selected")
def warehouse_selected(spark, sf_dir):
    """K4, K9: the job that saves selected facts as catalog tables, at a place of its own."""
    from . import jobs
    landed = writers.land_json(documents(spark, sf_dir).drop("suppkey"), scratch_path(spark, "doc-landing"), SNAPSHOTS[1])
    staged, place = scratch_path(spark, "staging"), scratch_path(spark, "warehouse")
    jobs.transform_landing(spark, landed, staged, SNAPSHOTS[1])
    names = jobs.update_warehouse(spark, staged, f"{WAREHOUSE_DB}_{place[-12:]}", SNAPSHOTS[1], ["quarterly_metric"], place)
    return spark.table(names[0])


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    root = _events_landing(spark, sf_dir)
    sink = scratch_path(spark, "stream-sink")
    ckpt = scratch_path(spark, "stream-ckpt")
    full = landing.with_partitions(EVENT_SCHEMA, T.StructField(writers.DATE_COL, T.DateType()))
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest_available(ingest.landing_stream(spark, root, full), sink, ckpt)
    return spark.read.schema(full).parquet(sink).select("event_id", "value")


@query("staged_fact_annual")
def staged_fact_annual(spark, sf_dir):
    """S7 + F4: the three staging tables written, read back, and cast to facts."""
    st = staging.stage(docs(spark, sf_dir), METRIC_KEYS, SERIES_METRICS)
    root = scratch_path(spark, "staging")
    for name, df in (("metric", st.metric), ("quarterly_metric", st.quarterly_metric),
                     ("annual_metric", st.annual_metric)):
        writers.stage_write(df, root, name, SNAPSHOTS[0])
    staged = staging.Staging(*[landing.stage_read(spark, root, n, SNAPSHOTS[0])
                               for n in ("metric", "quarterly_metric", "annual_metric")])
    return staging.to_facts(staged).annual_metric


@query("staged_freq_full_outer")
def staged_freq_full_outer(spark, sf_dir):
    """J3 in its two-frame form: the staged quarterly and annual tables, read
    back from storage as independent frames, side by side on (symbol, date)."""
    st = staging.stage(docs(spark, sf_dir), METRIC_KEYS, SERIES_METRICS)
    root = scratch_path(spark, "staging")
    for name, df in (("quarterly_metric", st.quarterly_metric), ("annual_metric", st.annual_metric)):
        writers.stage_write(df, root, name, SNAPSHOTS[0])
    q = landing.stage_read(spark, root, "quarterly_metric", SNAPSHOTS[0])
    a = landing.stage_read(spark, root, "annual_metric", SNAPSHOTS[0])
    return series.freq_full_outer(q, a)


@query("series_long_pivot")
def series_long_pivot(spark, sf_dir):
    """J2 in its multi-row form: long points pivoted back to wide (one shuffle)."""
    long_df = series.to_long(docs(spark, sf_dir)).filter(F.col("freq") == "quarterly")
    return series.pivot_long(long_df, ["symbol", "date"], "metric", "v", SERIES_METRICS)


@query("stream_new_symbols")
def stream_new_symbols(spark, sf_dir):
    """J4, streaming form: keys landed after the cutoff that no earlier batch had."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    root = scratch_path(spark, "orders-landing")
    cutoff = F.lit(NEW_KEY_CUTOFF).cast("date")
    key_table, ckpt = scratch_path(spark, "key-table"), scratch_path(spark, "key-ckpt")
    s = T.StructType([T.StructField("o_custkey", T.LongType()), T.StructField("day", T.DateType())])

    o.filter(F.col("day") < cutoff).write.json(f"{root}/before")
    ingest.track_new_keys(ingest.landing_stream(spark, f"{root}/*", s), ["o_custkey"], key_table, ckpt)
    last = spark.read.parquet(key_table).agg(F.max("batch_id")).first()[0]  # one number
    o.filter(F.col("day") >= cutoff).write.json(f"{root}/after")
    ingest.track_new_keys(ingest.landing_stream(spark, f"{root}/*", s), ["o_custkey"], key_table, ckpt)
    return spark.read.parquet(key_table).filter(F.col("batch_id") > (-1 if last is None else last)).select("o_custkey")


@query("staging_counts")
def staging_counts(spark, sf_dir):
    """A3: row counts of the three staging tables, observed on the staging
    write job itself (no extra count jobs), as a frame."""
    from . import jobs
    landing_root = writers.land_json(documents(spark, sf_dir).drop("suppkey"),
                                     scratch_path(spark, "doc-landing"), SNAPSHOTS[1])
    out = jobs.transform_landing(spark, landing_root, scratch_path(spark, "staging"), SNAPSHOTS[1])
    rows = sorted((k, n) for k, n in out["rows"].items() if k in jobs.STAGING_TABLES)
    return spark.createDataFrame(rows, "table_name string, n long")


@query("weekly_fact_quarterly")
def weekly_fact_quarterly(spark, sf_dir):
    """T3/F3 end to end on storage: land documents for a date, run the
    transformation job (metrics discovered from the data), update the lake
    twice for the same date (idempotent replace), read the quarterly fact."""
    from . import jobs
    landing_root = writers.land_json(documents(spark, sf_dir).drop("suppkey"),
                                     scratch_path(spark, "doc-landing"), SNAPSHOTS[1])
    staging_root, lake_root = scratch_path(spark, "staging"), scratch_path(spark, "lake")
    jobs.transform_landing(spark, landing_root, staging_root, SNAPSHOTS[1])
    for _ in range(2):
        jobs.update_lake(spark, staging_root, lake_root, SNAPSHOTS[1], selection=["quarterly_metric"])
    return writers.lake_read(spark, f"{lake_root}/quarterly_metric_fact")


# --- many snapshots, types that drift, whole files, buckets ------------------------

N_RAGGED = 200  # snapshots of as many different column sets


@query("ragged_union_many")
def ragged_union_many(spark, sf_dir):
    """200 snapshots of as many schemas, landed as they are and read as one frame in one pass over them.

    Each part's record is in the snapshot of its key's remainder, beside a
    column of that snapshot alone; ``amount`` is a whole number, a fraction or
    text, and ``level`` a whole number or a fraction, by snapshot.
    """
    c = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    shot = F.pmod("p_partkey", F.lit(N_RAGGED)).cast("int")
    whole, half = F.col("p_size").cast("string"), (F.col("p_size") + F.lit(0.5)).cast("string")
    amount = F.when(shot % 3 == 0, whole).when(shot % 3 == 1, half).otherwise(F.concat(F.lit('"'), F.col("p_brand"), F.lit('"')))
    level = F.when(shot % 2 == 0, whole).otherwise(half)
    line = F.format_string('{"part":%s,"amount":%s,"level":%s,"only_%s":%s}', F.col("p_partkey").cast("string"), amount, level, shot.cast("string"), whole)
    root = scratch_path(spark, "ragged-landing")
    c.select(line.alias("value"), shot.alias("snapshot")).repartition("snapshot").write.partitionBy("snapshot").text(root)
    return landing.read_ragged(spark, root, [T.StructField("snapshot", T.IntegerType())])


@query("lake_type_drift")
def lake_type_drift(spark, sf_dir):
    """K3: a column that is a whole number on one date, a fraction on the next and text on the third, in three formats."""
    path = scratch_path(spark, "lake") + "/balances"
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("symbol"), "s_nationkey", "s_acctbal")
    whole = s.select("symbol", F.col("s_nationkey").cast("int").alias("level"), F.floor("s_acctbal").cast("int").alias("amount"))
    part = s.select("symbol", F.col("s_nationkey").cast("long").alias("level"), (F.floor("s_acctbal") + F.lit(0.5)).alias("amount"))
    text = s.select("symbol", (F.col("s_nationkey") + F.lit(0.25)).alias("level"), F.col("symbol").alias("amount"))
    writers.lake_replace(whole, path, SNAPSHOTS[0])
    writers.lake_append(part, path, SNAPSHOTS[1], "json")
    writers.lake_append(text, path, "2024-01-21", "csv")
    return writers.lake_read(spark, path)


@query("stream_new_symbols_state")
def stream_new_symbols_state(spark, sf_dir):
    """J4 as state: three runs of one stream over a growing landing; each key once, when it is first seen, and the null key too.

    To have a null key, orders of the year before the cutoff land once more without one.
    """
    o = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    cutoff = F.lit(NEW_KEY_CUTOFF).cast("date")
    early, late = o.filter(F.col("day") < cutoff), o.filter(F.col("day") >= cutoff)
    nameless = early.filter(F.col("day") >= F.add_months(cutoff, -12)).select(F.lit(None).cast("long").alias("o_custkey"), "day")
    root, sink, ckpt = (scratch_path(spark, x) for x in ("orders-landing", "first-seen", "first-seen-ckpt"))
    s = T.StructType([T.StructField("o_custkey", T.LongType()), T.StructField("day", T.DateType())])
    for k, part in enumerate([early.unionByName(nameless), late, late.unionByName(nameless)]):
        part.write.option("ignoreNullFields", "false").json(f"{root}/{k}")
        ingest.first_seen(ingest.landing_stream(spark, f"{root}/*", s), ["o_custkey"], f"{sink}/run={k}", ckpt)
    return spark.read.schema("o_custkey long, run int").parquet(sink)


@query("stream_ingest_quarantine")
def stream_ingest_quarantine(spark, sf_dir):
    """Lines go to their route inside the stream, over two runs; counts of the sink beside those the listener saw.

    To make the case, error events land as their plain type, which is no JSON.
    """
    ev = table(spark, sf_dir, "events")
    line = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.to_json(F.struct("event_id", "value")))
    root, sink, ckpt = (scratch_path(spark, x) for x in ("events-lines", "routes", "routes-ckpt"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    seen = dict.fromkeys((ingest.GOOD, ingest.BAD), 0)
    for k, part in enumerate((F.col("value") < 100, F.coalesce(F.col("value") >= 100, F.lit(True)))):
        ev.filter(part).select(line.alias("value")).write.text(f"{root}/{k}")
        for name, n in ingest.ingest_routed(spark, f"{root}/*", schema, sink, ckpt, max_files_per_trigger=4).totals.items():
            seen[name] += n
    good, bad = (ingest.read_route(spark, sink, schema, r) for r in (ingest.GOOD, ingest.BAD))
    return good.agg(F.lit(ingest.GOOD).alias("route"), F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.lit(seen[ingest.GOOD]).cast("long").alias("observed")) \
        .unionByName(bad.agg(F.lit(ingest.BAD).alias("route"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("ids"),
                             F.lit(seen[ingest.BAD]).cast("long").alias("observed")))


@query("whole_file_scan")
def whole_file_scan(spark, sf_dir):
    """One document per file, over many lines, in a folder for each symbol; its key from the place, its text whole."""
    d = documents(spark, sf_dir)
    doc = F.to_json(F.struct("symbol", "metric", "series"), {"pretty": "true"})
    root = scratch_path(spark, "documents-landing")
    d.select("symbol", doc.alias("value")).write.partitionBy("symbol").text(root)
    files = landing.whole_files(spark, root)
    parsed = parse_json(F.col("doc"), DOC_SCHEMA)
    once = files.select("path_symbol", (F.size(F.split("doc", "\n")) > 10).alias("many_lines"), F.inline(F.array(F.struct(parsed.alias("p")))))
    n = lambda f: F.size(F.flatten(F.map_values(F.col("p.series")[f]))).cast("long")
    return once.select("path_symbol", "p.symbol", "many_lines", n("annual").alias("n_annual"), n("quarterly").alias("n_quarterly"))


@query("bucketed_freq_full_outer")
def bucketed_freq_full_outer(spark, sf_dir):
    """J3 over catalog tables of equal buckets: the frequencies side by side, without a shuffle."""
    st = staging.stage(docs(spark, sf_dir), METRIC_KEYS, SERIES_METRICS)
    place = scratch_path(spark, "buckets")
    base = f"{WAREHOUSE_DB}_{place[-12:]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {base}")
    buckets = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    q, a = (writers.bucketed_save(df, f"{base}.{name}", ["symbol", "date"], buckets, f"{place}/{name}")
            for name, df in (("quarterly", st.quarterly_metric), ("annual", st.annual_metric)))
    return series.freq_full_outer(spark.table(q), spark.table(a))


@query("quality_drift")
def quality_drift(spark, sf_dir):
    """Q2 across dates: each ship year's line items as stored sketches, the later half of the years against the earlier."""
    li = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"), "l_quantity", "l_extendedprice", "l_discount", "l_suppkey")
    values = ["l_quantity", "l_extendedprice", "l_discount", "l_suppkey"]
    kept = scratch_path(spark, "sketches")
    quality.sketch_by(li, "year", values).write.parquet(kept)
    sketches = spark.read.parquet(kept)
    early = F.col("year") < 1996
    return quality.drift(quality.merged(sketches.filter(early)), quality.merged(sketches.filter(~early)))


def _landed_facts(spark, sf_dir) -> tuple[str, str]:
    """Documents landed and staged for a date: place of the staging, and a place for what is made of it."""
    from . import jobs
    landed = writers.land_json(documents(spark, sf_dir).drop("suppkey"), scratch_path(spark, "doc-landing"), SNAPSHOTS[0])
    staged = scratch_path(spark, "staging")
    jobs.transform_landing(spark, landed, staged, SNAPSHOTS[0], METRIC_KEYS, SERIES_METRICS)
    return staged, scratch_path(spark, "facts")


@query("lake_metric_fact")
def lake_metric_fact(spark, sf_dir):
    """The metric fact through the jobs into the lake."""
    from . import jobs
    staged, place = _landed_facts(spark, sf_dir)
    jobs.update_lake(spark, staged, place, SNAPSHOTS[0], ["metric"])
    return writers.lake_read(spark, f"{place}/metric_fact")


@query("warehouse_metric_fact")
def warehouse_metric_fact(spark, sf_dir):
    """The metric fact through the jobs into a catalog table."""
    from . import jobs
    staged, place = _landed_facts(spark, sf_dir)
    return spark.table(jobs.update_warehouse(spark, staged, f"{WAREHOUSE_DB}_{place[-12:]}", SNAPSHOTS[0], ["metric"], place)[0])


@query("manifest_per_symbol")
def manifest_per_symbol(spark, sf_dir):
    """A folder for each symbol; the file at each path of the manifest holds the document of its symbol."""
    root = writers.land_json(documents(spark, sf_dir).drop("suppkey"), scratch_path(spark, "doc-landing"), SNAPSHOTS[0], per_symbol=True)
    landed = landing.scan_date(spark, root, DOC_SCHEMA, SNAPSHOTS[0], per_symbol=True)
    kept = scratch_path(spark, "manifest")
    writers.manifest(landed).write.parquet(kept)
    del landed  # the driver holds the list of files of one read at a time
    listed = spark.read.schema(f"symbol string, {writers.DATE_COL} date, file_path string").parquet(kept)
    read = landing.in_few_tasks(spark, lambda: landing.whole_files(spark, f"{root}/{writers.DATE_COL}={SNAPSHOTS[0]}"))
    n = F.size(F.flatten(F.map_values(parse_json(F.col("doc"), DOC_SCHEMA)["series"]["annual"]))).cast("long")
    return listed.join(read.select("path_symbol", "file_path", n.alias("n_annual")), "file_path").select("symbol", writers.DATE_COL, "path_symbol", "n_annual")
