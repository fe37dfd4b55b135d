"""Sinks: dated landings, staging, lake append, catalog tables, manifests (K1-K9).

All writes run on the executors (no driver collect); partition columns make
the date (and optionally the entity) part of the path so reads prune them.
Re-running a date replaces only that date's partitions (dynamic partition
overwrite), which is the idempotent form of the reference's per-file replace.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import quoted
from ..functions.types import cast_to, widened
from ..session import per_entity_partitions
from . import folders

DATE_COL = "snapshot_date"


def with_snapshot(df: DataFrame, snapshot_date: str) -> DataFrame:
    return df.withColumn(DATE_COL, F.lit(snapshot_date).cast("date"))


def _files(df: DataFrame, partition_cols: Sequence[str], files: int | None) -> DataFrame:
    """Lay out rows for a partitioned write.

    Default: ``REBALANCE`` on the partition columns, so rows of one partition
    value land in few tasks (few files per folder) while AQE splits a hot
    value over several tasks instead of one task writing a third of the data.
    ``files=n``: at most ``n`` tasks (files) per partition value, by hashing
    the row into ``n`` salts; never a single-task ``coalesce(1)``.
    """
    if files is None:
        return df.hint("rebalance", *partition_cols) if partition_cols else df
    salt = (F.abs(F.xxhash64(*df.columns)) % files) if files > 1 else F.lit(0)
    return df.repartition(*[F.col(c) for c in partition_cols], salt) if partition_cols \
        else df.repartition(files)


def write_partitioned(df: DataFrame, path: str, fmt: str = "parquet",
                      partition_cols: Sequence[str] = (DATE_COL,), mode: str = "overwrite",
                      files: int | None = None, max_records_per_file: int | None = None, as_dealt: bool = False) -> str:
    """``as_dealt``: each task writes the rows it holds, without a shuffle. For a
    folder for each entity, of rows that lie by entity: there the cost is the
    number of folders, and AQE, which merges tasks by their bytes, would leave
    thousands of them to one task. On a mounted file system the tasks make the
    folders without Hadoop (:mod:`.folders`)."""
    if as_dealt and mode == "overwrite" and partition_cols and not max_records_per_file and folders.write(df, path, fmt, partition_cols):
        return path
    w = (df if as_dealt else _files(df, partition_cols, files)).write.format(fmt).mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if mode == "overwrite" and partition_cols:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.save(path)
    return path


def land_json(df: DataFrame, root: str, snapshot_date: str | None = None,
              per_symbol: bool = False) -> str:
    """Dated JSON landing (K1, K6, S10): ``<root>/snapshot_date=<d>[/symbol=<s>]/``.

    ``per_symbol`` adds the symbol as a partition column (one folder per
    entity, as the reference's one-file-per-entity layout); by default many
    entities share a file, which keeps file counts sane at scale. The folders
    are dealt by symbol over an explicit number of tasks; one symbol of a date
    has one file, so all its documents are written by one task, as a stream.
    """
    cols = [] if snapshot_date is not None else [DATE_COL]
    if per_symbol:
        cols.append("symbol")
        df = df.repartition(per_entity_partitions(df.sparkSession), *cols)
    path = root if snapshot_date is None else f"{root}/{DATE_COL}={snapshot_date}"
    write_partitioned(df, path, "json", cols, as_dealt=per_symbol)
    return root


def stage_path(root: str, snapshot_date: str, name: str) -> str:
    """Dated staging location ``<root>/<date>/<name>`` (K2)."""
    return f"{root.rstrip('/')}/{snapshot_date}/{name}"


def stage_options(fmt: str) -> dict[str, str]:
    """Options with which text comes back as it was written, by both sides."""
    csv = {"escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return csv if fmt == "csv" else {}


def stage_write(df: DataFrame, root: str, name: str, snapshot_date: str, fmt: str = "parquet") -> str:
    """Staging overwrite at the dated path (K2). Parquet by default (no Delta jar)."""
    path = stage_path(root, snapshot_date, name)
    df.write.format(fmt).mode("overwrite").save(path)
    return path


def stage_write_typed(typed: DataFrame, root: str, snapshot_date: str, fmt: str = "parquet") -> str:
    """All three staging tables in one pass (K2): the typed union written once,
    partitioned by ``type``, at ``<root>/<date>/typed``. One parse of the
    landing and one write job instead of three; reading one table back prunes
    to its ``type`` folder and its columns. Only Parquet files keep the column
    metadata (groups, metrics); for other formats the schema is written beside
    the table, at ``<root>/<date>/typed_columns``."""
    path = stage_path(root, snapshot_date, "typed")
    if fmt != "parquet":
        one = typed.sparkSession.createDataFrame([(typed.schema.json(),)], "value string")
        one.coalesce(1).write.mode("overwrite").text(stage_path(root, snapshot_date, "typed_columns"))
    typed.write.format(fmt).options(**stage_options(fmt)).mode("overwrite").partitionBy("type").save(path)
    return path


def lake_append(df: DataFrame, path: str, snapshot_date: str, fmt: str = "parquet") -> str:
    """Append a fact for one snapshot date (K3). Unlike the reference, rows
    carry ``snapshot_date`` so re-runs are distinguishable. The date is known,
    so the rows go straight to its folder, without a shuffle.

    A date has one set of columns: what is appended to it takes its types, and
    raises before anything is written if it does not fit in them.
    """
    known = _columns_of(df.sparkSession, path).get(snapshot_date)
    if known:
        old = T.StructType.fromJson(json.loads(known["columns"]))
        types = widened((f.name, f.dataType) for f in [*old, *df.schema])
        wide = [f.name for f in old if types[f.name] != f.dataType]
        if wide or known["fmt"] != fmt:
            raise ValueError(f"{path}, {snapshot_date}: other format, or types too narrow for what is appended ({wide}); replace the date instead")
        df = df.select(*[cast_to(F.col(quoted(f.name)), f.dataType, types[f.name]).alias(f.name) for f in df.schema])
        columns = T.StructType([T.StructField(n, t) for n, t in types.items()])
    else:
        columns = df.schema
    _note_columns(df.sparkSession, path, snapshot_date, fmt, columns)
    df.write.format(fmt).options(**stage_options(fmt)).mode("append").save(f"{path}/{DATE_COL}={snapshot_date}")
    return path


def lake_replace(df: DataFrame, path: str, snapshot_date: str, fmt: str = "parquet") -> str:
    """Idempotent variant of :func:`lake_append`: replaces that date only, by
    nothing if there are no rows, with columns and types of its own."""
    df.write.format(fmt).options(**stage_options(fmt)).mode("overwrite").save(f"{path}/{DATE_COL}={snapshot_date}")
    _note_columns(df.sparkSession, path, snapshot_date, fmt, df.schema)
    return path


# The column catalog of a lake table: beside its dates, one record per date with the format, names and types last written.
# Readers of the table's folder pass over it, as its name begins with an underscore.
_CATALOG = "_columns"
_CATALOG_SCHEMA = f"fmt string, columns string, {DATE_COL} string"


def _note_columns(spark: SparkSession, path: str, snapshot_date: str, fmt: str, schema: T.StructType) -> None:
    one = spark.createDataFrame([(fmt, schema.json())], "fmt string, columns string").coalesce(1)
    one.write.mode("overwrite").json(f"{path}/{_CATALOG}/{DATE_COL}={snapshot_date}")


def _columns_of(spark: SparkSession, path: str) -> dict[str, dict]:
    """Per date: format and columns. One small record a date."""
    try:
        rows = spark.read.schema(_CATALOG_SCHEMA).json(f"{path}/{_CATALOG}").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r[DATE_COL]: r.asDict() for r in rows}


def lake_read(spark: SparkSession, path: str) -> DataFrame:
    """A lake table over all its dates, with the columns of all of them (K3).

    Where a column's type differs between dates, values are cast as they are
    read to the type that holds all (whole numbers, double, string). Dates of
    one format and one set of columns are one scan, so the plan grows with the
    number of different sets, not with the dates. A table without a catalog is
    Parquet whose types agree.
    """
    known = _columns_of(spark, path)
    if not known:
        return spark.read.option("mergeSchema", "true").parquet(path)
    sets: dict[tuple[str, str], list[str]] = {}
    for date, x in sorted(known.items()):
        sets.setdefault((x["fmt"], x["columns"]), []).append(date)
    schemas = {key: T.StructType.fromJson(json.loads(key[1])) for key in sets}
    types = widened((f.name, f.dataType) for s in schemas.values() for f in s)
    parts = []
    for (fmt, columns), dates in sets.items():
        schema = schemas[fmt, columns]
        full = T.StructType([*schema, T.StructField(DATE_COL, T.DateType())])
        rows = spark.read.format(fmt).options(**stage_options(fmt)).option("basePath", path).schema(full)
        rows = rows.load([f"{path}/{DATE_COL}={d}" for d in dates])
        parts.append(rows.select(*[cast_to(F.col(quoted(f.name)), f.dataType, types[f.name]).alias(f.name, metadata=f.metadata) for f in schema], DATE_COL))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*[quoted(n) for n in types], DATE_COL)


def bucketed_save(df: DataFrame, name: str, keys: Sequence[str], buckets: int, location: str) -> str:
    """Catalog table ``name`` in ``buckets`` by ``keys``, sorted within each: tables of equal keys and buckets join
    on these without a shuffle (J3, S7). The one shuffle of the keys is paid when the table is written."""
    by = df.repartition(buckets, *[F.col(k) for k in keys])
    by.write.format("parquet").mode("overwrite").option("path", location).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return name


def warehouse_save(spark: SparkSession, df: DataFrame, database: str, table: str,
                   location: str | None = None) -> str:
    """Catalog table ``<database>.<table>`` (K4), replaced on each run.

    With a ``location`` the table's files are at ``<location>/<table>``,
    wherever the database (which may exist already) has its folder.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.{table}"
    w = df.write.mode("overwrite").format("parquet")
    (w.option("path", f"{location.rstrip('/')}/{table}") if location else w).saveAsTable(name)
    return name


def write_selected(outputs: dict[str, DataFrame], selection: Sequence[str], writer) -> list[str]:
    """Materialise only the selected outputs (K9); unselected plans never run."""
    unknown = set(selection) - set(outputs)
    if unknown:
        raise KeyError(f"unknown outputs: {sorted(unknown)}")
    return [writer(name, outputs[name]) for name in selection]


def manifest(files: DataFrame) -> DataFrame:
    """Per landed record: which file holds it (K8), from the file-source metadata."""
    return files.select("symbol", DATE_COL, F.col("_metadata.file_path").alias("file_path")).distinct()
