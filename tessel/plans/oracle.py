"""DuckDB oracle SQL for the query catalogue.

Written independently of the Spark plans: the series points are recomputed
relationally from ``lineitem`` and ``supplier`` (quarterly and annual sums
straight from lineitem, no roll-up), and alignment is expressed with window
functions and filtered aggregates instead of array functions.
"""

from __future__ import annotations

_PER_FREQ = """
  SELECT '{freq}' AS freq, l_suppkey AS suppkey,
         CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS period,
         CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
         CAST(SUM(CASE WHEN l_returnflag = 'R' AND l_discount > 0.08
                       THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE) AS returned,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sales
  FROM lineitem {of} GROUP BY 1, 2, 3"""

_PTS_ONE = """
  SELECT s.s_name AS symbol, s.s_suppkey AS suppkey, p.freq, '{m}' AS metric, p.period, p.{m} AS v
  FROM {per} p JOIN supplier s ON s.s_suppkey = p.suppkey WHERE p.{m} IS NOT NULL"""

# The large returns, of which the gappy documents are made.
_LARGE = "WHERE l_returnflag = 'R' AND l_quantity >= 48 AND l_discount >= 0.1"

# Base CTEs: per (freq, supplier, period) sums; long points ``pts``; the
# gappy variant ``gpts``; the metric row ``met``.
BASE = (
    "WITH per AS (" + _PER_FREQ.format(freq="quarterly", unit="quarter", of="")
    + "\n  UNION ALL" + _PER_FREQ.format(freq="annual", unit="year", of="") + "),\n"
    + "gper AS (" + _PER_FREQ.format(freq="quarterly", unit="quarter", of=_LARGE)
    + "\n  UNION ALL" + _PER_FREQ.format(freq="annual", unit="year", of=_LARGE) + "),\n"
    + "pts AS (" + "\n  UNION ALL".join(_PTS_ONE.format(m=m, per="per") for m in ("quantity", "returned", "sales"))
    + "),\n"
    + "gall AS (" + "\n  UNION ALL".join(_PTS_ONE.format(m=m, per="gper") for m in ("quantity", "returned", "sales"))
    + "),\n"
    + """gpts AS (
  SELECT * FROM gall WHERE freq = 'annual' OR symbol IN
    (SELECT symbol FROM gall WHERE freq = 'quarterly' GROUP BY symbol HAVING count(DISTINCT period) > 1)),
met AS (
  SELECT s.s_name AS symbol, s.s_suppkey AS suppkey,
         strftime(f.first_ship, '%Y-%m-%d') AS firstShip,
         CAST(CAST(s.s_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS s_acctbal,
         CAST(s.s_nationkey AS VARCHAR) AS s_nationkey
  FROM supplier s LEFT JOIN (
    SELECT l_suppkey, MIN(CAST(l_shipdate AS DATE)) AS first_ship FROM lineitem GROUP BY 1
  ) f ON f.l_suppkey = s.s_suppkey)
""")

M = ("quantity", "returned", "sales")


def _filtered(col: str, metrics=M, prefix: str = "", cast: str | None = None, agg: str = "max") -> str:
    out = []
    for m in metrics:
        e = f"{agg}({col}) FILTER (WHERE metric = '{m}')"
        if cast:
            e = f"CAST({e} AS {cast})"
        out.append(f"{e} AS {prefix}{m}")
    return ", ".join(out)


def period_sql(freq: str, src: str = "pts", cast: str | None = None) -> str:
    return (f"SELECT symbol, period AS date, {_filtered('v', cast=cast)} "
            f"FROM {src} WHERE freq = '{freq}' GROUP BY symbol, period")


def position_sql(freq: str, src: str = "pts") -> str:
    dates = ", ".join(f"max(period) FILTER (WHERE metric = '{m}')" for m in M)
    return (f"SELECT symbol, coalesce({dates}) AS date, {_filtered('v')} FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY symbol, metric ORDER BY period DESC) AS pos "
            f"FROM {src} WHERE freq = '{freq}') GROUP BY symbol, pos")


# Symbols with both annual and quarterly rows.
_BEARING = "(SELECT symbol FROM pts GROUP BY symbol HAVING count(DISTINCT freq) = 2)"

ORACLE: dict[str, str] = {
    "series_annual_position": BASE + position_sql("annual"),
    "series_quarterly_position": BASE + position_sql("quarterly"),
    "series_annual_period": BASE + period_sql("annual"),
    "series_quarterly_period": BASE + period_sql("quarterly"),
    "fact_quarterly": BASE + (
        f"SELECT date, symbol, quantity, returned, sales FROM ({period_sql('quarterly', cast='FLOAT')}) "
        f"WHERE symbol IN {_BEARING}"),
    "fact_annual": BASE + (
        f"SELECT date, symbol, quantity, returned, sales FROM ({period_sql('annual', cast='FLOAT')}) "
        f"WHERE symbol IN {_BEARING}"),
    "fact_metric": BASE + (
        "SELECT symbol, TRY_CAST(firstShip AS FLOAT) AS firstShip, "
        "TRY_CAST(s_acctbal AS FLOAT) AS s_acctbal, TRY_CAST(s_nationkey AS FLOAT) AS s_nationkey FROM met"),
}


def _prefixed_period(freq: str, prefix: str, src: str = "pts") -> str:
    return (f"SELECT symbol, period AS date, {_filtered('v', prefix=prefix)} "
            f"FROM {src} WHERE freq = '{freq}' GROUP BY symbol, period")


def _full_outer_cols() -> str:
    out = []
    for f in ("annual", "quarterly"):
        for m in M:
            out.append(f"max(v) FILTER (WHERE freq = '{f}' AND metric = '{m}') AS {f}_{m}")
    return ", ".join(out)


_FULL_OUTER = f"SELECT symbol, period AS date, {_full_outer_cols()} FROM pts GROUP BY symbol, period"

_TYPED = f"""
  SELECT 'metric' AS type, symbol, firstShip, s_acctbal, s_nationkey FROM met
  UNION ALL BY NAME
  SELECT 'quarterly_metric' AS type, * FROM ({_prefixed_period('quarterly', 'quarterly_', '{src}')})
  UNION ALL BY NAME
  SELECT 'annual_metric' AS type, * FROM ({_prefixed_period('annual', 'annual_', '{src}')})"""

_TYPED_POSITION = (
    "\n  SELECT 'metric' AS type, symbol, firstShip, s_acctbal, s_nationkey FROM met"
    "\n  UNION ALL BY NAME\n  SELECT 'quarterly_metric' AS type, symbol, date, "
    + ", ".join(f"{m} AS quarterly_{m}" for m in M) + f" FROM ({position_sql('quarterly')})"
    "\n  UNION ALL BY NAME\n  SELECT 'annual_metric' AS type, symbol, date, "
    + ", ".join(f"{m} AS annual_{m}" for m in M) + f" FROM ({position_sql('annual')})")


def _quality(src: str, keys: str, cols) -> str:
    aggs = ["count(*) AS n", f"count(*) - count(DISTINCT {keys}) AS dup"]
    for i, c in enumerate(cols):
        aggs.append(f"count(*) FILTER (WHERE {c} IS NULL) AS null{i}")
        aggs.append(f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS FLOAT) IS NULL) AS bad{i}")
    parts = [f"SELECT '{c}' AS column_name, n, null{i} AS n_null, bad{i} AS n_bad_cast, dup AS n_dup_keys FROM agg"
             for i, c in enumerate(cols)]
    return f", agg AS (SELECT {', '.join(aggs)} FROM {src})\n" + "\nUNION ALL ".join(parts)


_EVENTS_FANOUT = ("'stock_' || event_type || CASE WHEN value >= 100 THEN '.A' ELSE '' END || '_path'")

_FACT_ANNUAL = (f"SELECT date, symbol, quantity, returned, sales FROM ({period_sql('annual', cast='FLOAT')}) "
                f"WHERE symbol IN {_BEARING}")

ORACLE.update({
    "series_long": BASE + (
        "SELECT symbol, freq, metric, "
        "CAST(row_number() OVER (PARTITION BY symbol, freq, metric ORDER BY period DESC) - 1 AS INTEGER) AS pos, "
        "period AS date, v FROM pts"),
    "series_full_outer": BASE + _FULL_OUTER,
    "freq_full_outer": BASE + (
        f"SELECT * FROM ({_prefixed_period('quarterly', 'q_')}) q "
        f"FULL OUTER JOIN ({_prefixed_period('annual', 'a_')}) a USING (symbol, date)"),
    "legacy_wide": BASE + f"SELECT * FROM ({_FULL_OUTER}) w JOIN (SELECT symbol, firstShip, s_acctbal, "
                          f"s_nationkey FROM met) m USING (symbol)",
    "metric_long": BASE + (
        "SELECT symbol, 'firstShip' AS metric, firstShip AS value FROM met UNION ALL "
        "SELECT symbol, 's_acctbal', s_acctbal FROM met UNION ALL "
        "SELECT symbol, 's_nationkey', s_nationkey FROM met"),
    "attach_constant": BASE + "SELECT symbol, 'fundamentals' AS source FROM met",
    "metric_catalog": BASE + (
        "SELECT freq, metric, count(DISTINCT symbol) AS n_symbols, count(*) AS n_points "
        "FROM pts GROUP BY freq, metric"),
    "metric_width": BASE + (
        "SELECT m.symbol, CAST(3 AS INTEGER) AS n_metrics, CAST(coalesce(g.n, 0) AS INTEGER) AS n_series "
        "FROM met m LEFT JOIN (SELECT symbol, count(DISTINCT (freq, metric)) AS n FROM pts GROUP BY symbol) g "
        "USING (symbol)"),
    "has_series": BASE + "SELECT DISTINCT symbol FROM gpts",
    "typed_union": BASE + _TYPED.replace("{src}", "pts"),
    "typed_union_position": BASE + _TYPED_POSITION,
    "type_counts": BASE + f"SELECT type, count(*) AS n FROM ({_TYPED.replace('{src}', 'pts')}) GROUP BY type",
    "series_bearing": BASE + (
        "SELECT symbol, count(DISTINCT period) FILTER (WHERE freq = 'annual') AS n_annual, "
        "count(DISTINCT period) FILTER (WHERE freq = 'quarterly') AS n_quarterly FROM pts "
        "GROUP BY symbol HAVING n_annual > 0 AND n_quarterly > 0"),
    "split_typed": BASE + (
        f"SELECT * FROM ({_prefixed_period('quarterly', 'quarterly_')}) WHERE symbol IN {_BEARING}"),
    "split_typed_gappy_annual": BASE + (
        f"SELECT * FROM ({_prefixed_period('annual', 'annual_')}) WHERE symbol IN "
        "(SELECT symbol FROM pts GROUP BY symbol HAVING count(DISTINCT freq) = 2)"),
    "ragged_union": BASE + (
        "SELECT symbol, s_acctbal, s_nationkey, 'a' AS snapshot FROM met UNION ALL BY NAME "
        "SELECT symbol, firstShip, s_acctbal, 'b' AS snapshot FROM met"),
    "symbol_directory": (
        "SELECT c_name AS symbol FROM customer JOIN nation ON c_nationkey = n_nationkey "
        "JOIN region ON n_regionkey = r_regionkey WHERE c_mktsegment = 'BUILDING' "
        "AND r_name = 'AMERICA' AND c_acctbal > 0 ORDER BY c_name"),
    "symbol_top100": "SELECT c_name AS symbol FROM customer ORDER BY c_name LIMIT 100",
    "documents_for_symbols": BASE + (
        "SELECT s.s_name AS symbol, CAST((SELECT count(DISTINCT freq) FROM pts WHERE pts.suppkey = s.s_suppkey) "
        "AS INTEGER) AS n_freq FROM supplier s WHERE s.s_acctbal > 0"),
    "json_parse_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "parquet_scan": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "path_to_key": "SELECT page_id, split_part(string_split(url, '/')[-1], '.', 1) AS key FROM pages",
    "fanout_key": (
        f"SELECT event_id, CASE WHEN contains(meta, '.') THEN split_part(meta, '.', 1) "
        f"ELSE substr(meta, 1, length(meta) - 5) END AS key FROM (SELECT event_id, {_EVENTS_FANOUT} AS meta "
        f"FROM events)"),
    "zip_join": (
        "SELECT rn, c_name, o_orderkey, o_totalprice FROM "
        "(SELECT c_name, row_number() OVER (ORDER BY c_custkey) AS rn FROM customer) "
        "FULL JOIN (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) "
        "USING (rn)"),
    "new_symbols": (
        "SELECT DISTINCT o_custkey FROM orders o WHERE o_orderdate >= DATE '1996-01-01' AND NOT EXISTS "
        "(SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderdate < DATE '1996-01-01')"),
    "snapshot_partition": (
        "SELECT CAST(ts AS DATE) AS snapshot_date, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS label, "
        "count(*) AS n FROM events GROUP BY 1"),
    "quarantine": (
        "SELECT json_valid(p) AS ok, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' "
        "THEN event_type ELSE props END AS p FROM events) GROUP BY 1"),
    "quality_report": BASE.rstrip() + _quality("met", "symbol", ("firstShip", "s_acctbal", "s_nationkey")),
    "quality_report_quarterly": BASE.rstrip() + (
        f", fq AS (SELECT date, symbol, quantity, returned, sales FROM "
        f"({period_sql('quarterly', cast='FLOAT')}) WHERE symbol IN {_BEARING})"
    ) + _quality("fq", "(symbol, date)", M),
    "raw_write_read": "SELECT event_id, CAST(ts AS DATE) AS snapshot_date, value FROM events",
    "raw_scan_date": ("SELECT event_id, CAST(ts AS DATE) AS snapshot_date, value FROM events "
                      "WHERE CAST(ts AS DATE) = DATE '2024-01-15'"),
    "fallback_scan": "SELECT event_id, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
    "staging_counts": BASE + (
        "SELECT 'metric' AS table_name, count(*) AS n FROM met UNION ALL "
        f"SELECT 'quarterly_metric', count(*) FROM ({period_sql('quarterly')}) WHERE symbol IN {_BEARING} "
        f"UNION ALL SELECT 'annual_metric', count(*) FROM ({period_sql('annual')}) WHERE symbol IN {_BEARING}"),
    "staged_freq_full_outer": BASE + (
        f"SELECT * FROM (SELECT * FROM ({_prefixed_period('quarterly', 'quarterly_')}) "
        f"WHERE symbol IN {_BEARING}) q FULL JOIN (SELECT * FROM ({_prefixed_period('annual', 'annual_')}) "
        f"WHERE symbol IN {_BEARING}) a USING (symbol, date)"),
    "landed_fact_quarterly": None,  # filled below (same as fact_quarterly)
    "staging_roundtrip": BASE + (
        f"SELECT * FROM ({_prefixed_period('quarterly', 'quarterly_')}) WHERE symbol IN {_BEARING}"),
    "parquet_pair": BASE + f"SELECT *, DATE '2024-01-07' AS snapshot_date FROM ({_FULL_OUTER})",
    "warehouse_table": BASE + _FACT_ANNUAL,
    "lake_append": BASE + (
        f"SELECT *, DATE '2024-01-07' AS snapshot_date FROM ({_FACT_ANNUAL}) UNION ALL "
        f"SELECT *, DATE '2024-01-14' AS snapshot_date FROM ({_FACT_ANNUAL})"),
    "stream_ingest": "SELECT event_id, value FROM events",
})
ORACLE["landed_fact_quarterly"] = ORACLE["fact_quarterly"]

ORACLE.update({
    "staged_fact_annual": ORACLE["fact_annual"],
    "series_long_pivot": BASE + period_sql("quarterly"),
    "stream_new_symbols": ORACLE["new_symbols"],
})

ORACLE["weekly_fact_quarterly"] = BASE + (
    f"SELECT date, symbol, quantity, returned, sales, DATE '2024-01-14' AS snapshot_date FROM "
    f"({period_sql('quarterly', cast='FLOAT')}) WHERE symbol IN {_BEARING}")

# The landed JSON text itself. Points nested per (freq, metric) in
# descending period order, map keys in name order, ``series`` left out when
# a document has none (Spark's writer omits null fields).
_METRIC_MAP = "map(['firstShip', 's_acctbal', 's_nationkey'], [m.firstShip, m.s_acctbal, m.s_nationkey])"
ORACLE["to_json_doc"] = BASE + f""",
arrs AS (SELECT symbol, freq, metric,
                list(struct_pack(period := period, v := v) ORDER BY period DESC, v DESC) AS pts
         FROM pts GROUP BY symbol, freq, metric),
freqs AS (SELECT symbol, freq, map_from_entries(list((metric, pts) ORDER BY metric)) AS fm
          FROM arrs GROUP BY symbol, freq),
docs AS (SELECT symbol, map_from_entries(list((freq, fm) ORDER BY freq)) AS series
         FROM freqs GROUP BY symbol)
SELECT m.symbol AS symbol,
       CAST(CASE WHEN d.series IS NULL
                 THEN to_json(struct_pack(symbol := m.symbol, metric := {_METRIC_MAP}))
                 ELSE to_json(struct_pack(symbol := m.symbol, metric := {_METRIC_MAP}, series := d.series))
            END AS VARCHAR) AS raw
FROM met m LEFT JOIN docs d ON d.symbol = m.symbol"""

ORACLE.update({
    "write_manifest": "SELECT s_name AS symbol, DATE '2024-01-07' AS snapshot_date, '2024-01-07' AS path_date FROM supplier",
    "parquet_pair_metrics": BASE + "SELECT symbol, firstShip, s_acctbal, s_nationkey, DATE '2024-01-07' AS snapshot_date FROM met",
    "lake_drift": BASE + (
        f"SELECT date, symbol, quantity, returned, NULL AS sales, DATE '2024-01-07' AS snapshot_date FROM ({_FACT_ANNUAL}) UNION ALL "
        f"SELECT date, symbol, quantity, returned, sales, DATE '2024-01-14' AS snapshot_date FROM ({_FACT_ANNUAL})"),
    "awkward_keys": BASE + (
        "SELECT symbol, CAST(s_acctbal AS FLOAT) AS annual_yield, CAST(s_nationkey AS FLOAT) AS quarterly_x_y, "
        "CAST(s_acctbal AS FLOAT) AS metric_date, CAST(s_nationkey AS FLOAT) AS metric_type FROM met"),
    "discovered_metrics": BASE + (
        "SELECT unnest(['firstShip', 's_acctbal', 's_nationkey']) AS name, 'metric' AS side UNION ALL "
        "SELECT DISTINCT metric, freq FROM pts WHERE NOT (freq = 'quarterly' AND metric = 'sales')"),
    "warehouse_selected": ORACLE["fact_quarterly"],
})

# --- documents of undeclared shape -------------------------------------------

_WILD = BASE.rstrip() + """,
wild AS (
  SELECT s_name AS symbol, s_acctbal < 1000 AS small, CAST(s_nationkey AS BIGINT) AS nation, 'all' AS metricType,
         CASE WHEN s_acctbal < 1000 THEN s_name ELSE CAST(s_nationkey AS VARCHAR) END AS code,
         regexp_replace(CAST(CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS VARCHAR), '[.]0$', '') AS usd
  FROM supplier)
"""
_OTHERS = "w.code, w.metricType, w.nation, w.small"


def _sales(freq: str) -> str:
    return f"max(v) FILTER (WHERE freq = '{freq}' AND metric = 'sales')"


ORACLE.update({
    "doc_passthrough": _WILD + f"""
SELECT 'metric' AS type, m.symbol, NULL AS date, m.firstShip AS since, NULL AS annual_sales, {_OTHERS} FROM met m JOIN wild w USING (symbol)
UNION ALL SELECT p.type, p.symbol, p.date, NULL, p.sales, {_OTHERS} FROM (
  SELECT freq || '_metric' AS type, symbol, period AS date, {_sales('annual')} AS sales FROM pts GROUP BY freq, symbol, period) p JOIN wild w USING (symbol)""",
    "legacy_wide_passthrough": _WILD + f"""
SELECT m.symbol, p.date, m.firstShip AS since, p.annual_sales, p.quarterly_sales, {_OTHERS} FROM (
  SELECT symbol, period AS date, {_sales('annual')} AS annual_sales, {_sales('quarterly')} AS quarterly_sales FROM pts GROUP BY symbol, period) p
JOIN met m USING (symbol) JOIN wild w USING (symbol)""",
    "passthrough_fact": _WILD + (
        f"SELECT f.*, {_OTHERS}, DATE '2024-01-07' AS snapshot_date FROM ({_FACT_ANNUAL}) f JOIN wild w USING (symbol)"),
    "metric_flatten": _WILD + """
SELECT symbol, metric, value FROM (
  SELECT symbol, 'since' AS metric, firstShip AS value FROM met UNION ALL SELECT symbol, 'place.ship.first', firstShip FROM met
  UNION ALL SELECT symbol, 'place.nation', CAST(nation AS VARCHAR) FROM wild UNION ALL SELECT symbol, 'place.ship.port', CAST(nation AS VARCHAR) FROM wild
  UNION ALL SELECT symbol, 'balance.usd.cents', usd FROM wild) WHERE value IS NOT NULL""",
    "landing_quarantine": BASE + """
SELECT s.s_name AS symbol, CASE WHEN s.s_acctbal < 1000 THEN q - 1 ELSE q END AS n_quantity, r AS n_returned, a AS n_sales, NULL AS text, NULL AS reason
FROM supplier s LEFT JOIN (
  SELECT symbol, count(*) FILTER (metric = 'quantity') AS q, count(*) FILTER (metric = 'returned') AS r, count(*) FILTER (metric = 'sales') AS a
  FROM pts WHERE freq = 'annual' AND symbol IN """ + _BEARING + """ GROUP BY symbol) p ON p.symbol = s.s_name
UNION ALL SELECT NULL, NULL, NULL, NULL, n_name, 'malformed json' FROM nation""",
})

# The paths of these documents: of all, of those with a small balance, of the others, and of the series by frequency and metric.
_PATHS = _WILD.rstrip() + """,
of_all AS (SELECT unnest([
    ('symbol', 'STRING'), ('metricType', 'STRING'), ('small', 'BOOLEAN'), ('nation', 'BIGINT'), ('profile', 'OBJECT'), ('profile.notes', 'ARRAY'),
    ('profile.notes[]', 'OBJECT'), ('profile.notes[].by', 'STRING'), ('profile.notes[].rank', 'BIGINT'), ('metric', 'OBJECT'), ('metric.place', 'OBJECT'),
    ('metric.place.nation', 'BIGINT'), ('metric.place.ship', 'OBJECT'), ('metric.place.ship.port', 'BIGINT'), ('metric.none', 'OBJECT'), ('metric.codes', 'ARRAY'),
    ('metric.codes[]', 'BIGINT'), ('metric.balance', 'OBJECT'), ('metric.balance.usd.cents', 'DECIMAL')]) AS x, (SELECT count(*) FROM wild) AS docs),
of_shipped AS (SELECT unnest([('metric.since', 'STRING'), ('metric.place.ship.first', 'STRING')]) AS x, (SELECT count(firstShip) FROM met) AS docs),
of_small AS (SELECT unnest([('code', 'STRING'), ('profile.mark', 'DECIMAL')]) AS x, (SELECT count(*) FROM wild WHERE small) AS docs),
of_others AS (SELECT unnest([('code', 'BIGINT'), ('profile.mark', 'BIGINT')]) AS x, (SELECT count(*) FROM wild WHERE NOT small) AS docs),
point AS (SELECT 'series.' || freq AS f, 'series.' || freq || '.' || metric AS m, symbol, CASE WHEN v >= 1e7 THEN 'DOUBLE' ELSE 'DECIMAL' END AS kind FROM pts),
found AS (
  SELECT x[1] AS path, x[2] AS kind, docs FROM (FROM of_all UNION ALL FROM of_shipped UNION ALL FROM of_small UNION ALL FROM of_others) WHERE docs > 0
  UNION ALL SELECT 'series', 'OBJECT', count(DISTINCT symbol) FROM point
  UNION ALL SELECT f, 'OBJECT', count(DISTINCT symbol) FROM point GROUP BY f
  UNION ALL SELECT m, 'ARRAY', count(DISTINCT symbol) FROM point GROUP BY m
  UNION ALL SELECT m || '[]', 'OBJECT', count(DISTINCT symbol) FROM point GROUP BY m
  UNION ALL SELECT m || '[].period', 'STRING', count(DISTINCT symbol) FROM point GROUP BY m
  UNION ALL SELECT m || '[].v', kind, count(DISTINCT symbol) FROM point GROUP BY m, kind)
"""
ORACLE.update({
    "schema_paths": _PATHS + "SELECT path, kind, docs FROM found",
    "schema_arrays": _PATHS + "SELECT replace(path, '[]', '') AS path, docs FROM found WHERE ends_with(path, '[]') AND kind = 'OBJECT'",
    "schema_leaves": _PATHS + (
        "SELECT replace(path, '[]', '') AS path, CASE WHEN ends_with(path, '.v') THEN 'double' WHEN ends_with(path, '.rank') THEN 'bigint' ELSE 'string' END AS type, "
        "max(docs) AS docs FROM found WHERE contains(path, '[].') GROUP BY path"),
})

_ONLY = ", ".join(f"CASE WHEN p_partkey % 200 = {k} THEN p_size END AS only_{k}" for k in range(200))
ORACLE.update({
    "ragged_union_many": (
        "SELECT p_partkey AS part, CASE p_partkey % 200 % 3 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN CAST(p_size AS VARCHAR) || '.5' ELSE p_brand END AS amount, "
        f"CAST(CASE WHEN p_partkey % 200 % 2 = 0 THEN p_size ELSE p_size + 0.5 END AS DOUBLE) AS level, CAST(p_partkey % 200 AS INTEGER) AS snapshot, {_ONLY} FROM part"),
    "lake_type_drift": (
        "SELECT s_name AS symbol, CAST(s_nationkey AS DOUBLE) AS level, CAST(CAST(floor(s_acctbal) AS INTEGER) AS VARCHAR) AS amount, DATE '2024-01-07' AS snapshot_date FROM supplier "
        "UNION ALL SELECT s_name, CAST(s_nationkey AS DOUBLE), CAST(floor(s_acctbal) + 0.5 AS VARCHAR), DATE '2024-01-14' FROM supplier "
        "UNION ALL SELECT s_name, s_nationkey + 0.25, s_name, DATE '2024-01-21' FROM supplier"),
    "stream_new_symbols_state": (
        "SELECT o_custkey, CAST(CASE WHEN min(CAST(o_orderdate AS DATE)) < DATE '1996-01-01' THEN 0 ELSE 1 END AS INTEGER) AS run FROM orders GROUP BY o_custkey "
        "UNION ALL SELECT NULL, 0 FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1995-01-01' AND CAST(o_orderdate AS DATE) < DATE '1996-01-01' HAVING count(*) > 0"),
    "stream_ingest_quarantine": (
        "SELECT 'good' AS route, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, count(*) AS observed FROM events WHERE event_type <> 'error' "
        "UNION ALL SELECT 'quarantine', count(*), NULL, count(*) FROM events WHERE event_type = 'error'"),
    "whole_file_scan": BASE + (
        "SELECT m.symbol AS path_symbol, m.symbol, true AS many_lines, count(*) FILTER (p.freq = 'annual') AS n_annual, "
        "count(*) FILTER (p.freq = 'quarterly') AS n_quarterly FROM met m JOIN pts p USING (symbol) GROUP BY m.symbol"),
    "bucketed_freq_full_outer": ORACLE["staged_freq_full_outer"],
})

ORACLE.update({
    "lake_metric_fact": BASE + (
        "SELECT symbol, TRY_CAST(firstShip AS FLOAT) AS firstShip, TRY_CAST(s_acctbal AS FLOAT) AS s_acctbal, "
        "TRY_CAST(s_nationkey AS FLOAT) AS s_nationkey, DATE '2024-01-07' AS snapshot_date FROM met"),
    "warehouse_metric_fact": ORACLE["fact_metric"],
    "manifest_per_symbol": BASE + (
        "SELECT m.symbol, DATE '2024-01-07' AS snapshot_date, m.symbol AS path_symbol, count(*) AS n_annual "
        "FROM met m JOIN pts p ON p.symbol = m.symbol AND p.freq = 'annual' GROUP BY m.symbol"),
})
