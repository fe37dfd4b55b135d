"""Reading landed and staged data back."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import CORRUPT, JSON_OPTIONS, bad_values, malformed
from ..functions.keys import path_key
from ..functions.schema import TYPE_ANNUAL, TYPE_QUARTERLY, group_of, quoted
from ..functions.types import VARIANT_TYPES, widened
from ..operators import nested
from ..session import per_entity_partitions
from ..sinks.folders import NO_VALUE
from ..sinks.writers import DATE_COL, stage_options, stage_path

BAD_VALUES = "_bad_values"
FOLDER_TASKS = 4  # fixed value: tasks that list or read entities' folders, for each of a per-entity stage


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
              options: dict | None = None) -> DataFrame:
    """Landed JSON with a declared schema: no inference pass over the files."""
    opts = dict(JSON_OPTIONS)
    opts["multiLine"] = "false"  # landings hold one record per line
    opts.update(options or {})
    r = spark.read.schema(schema).options(**opts)
    return r.json(list(paths) if not isinstance(paths, str) else paths)


def in_few_tasks(spark: SparkSession, read: Callable[[], DataFrame]) -> DataFrame:
    """What ``read()`` reads of a folder for each entity, in ``FOLDER_TASKS`` times as many tasks as per-entity stages have.

    Spark lists such folders by a task for each, up to 10,000, and reads a few
    files a task, as each counts as ``openCostInBytes``: there starting tasks
    takes longer than their work. All folders are listed and all files read;
    a task's part of the listing is small beside the driver's memory.
    """
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    n, most = FOLDER_TASKS * per_entity_partitions(spark), spark.conf.get(key)
    spark.conf.set(key, str(min(n, int(most))))
    try:
        rows = read()
    finally:
        spark.conf.set(key, most)
    return rows.coalesce(n)


def _plain(c: Column) -> Column:
    """Text of an URL, or of the name of a folder."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def read_folders(spark: SparkSession, read: Callable[[T.StructType, dict], DataFrame], schema: T.StructType, columns: Sequence[str],
                 metadata: bool = False) -> DataFrame:
    """Rows of ``schema`` from files in folders ``<column>=<value>/...``, one for each entity; ``read`` gets the schema
    of the files and the options to read them with. ``metadata`` keeps the column ``_metadata``.

    The values come from the files' paths: what Spark does in the driver to
    find them takes time with the square of the folders.
    """
    files = T.StructType([f for f in schema if f.name not in columns])
    end, values = "/[^/]*$", {}
    for c in reversed(columns):
        value = F.regexp_extract(_plain(F.col("_metadata.file_path")), f"/{c}=([^/]*){end}", 1)
        values[c] = F.nullif(_plain(value), F.lit(NO_VALUE)).cast(schema[c].dataType).alias(c)
        end = f"/{c}=[^/]*{end}"
    return in_few_tasks(spark, lambda: read(files, {"recursiveFileLookup": "true"}).select(
        *map(quoted, files.names), *[values[c] for c in columns], *(["_metadata"] if metadata else [])))


def with_partitions(schema: T.StructType, *extra: T.StructField) -> T.StructType:
    return T.StructType(list(schema.fields) + list(extra))


def scan_date(spark: SparkSession, root: str, schema: T.StructType, snapshot_date: str,
              options: dict | None = None, per_symbol: bool = False) -> DataFrame:
    """One date prefix of a dated landing (S3). Only that date's folder is
    listed; a date without a folder gives no rows. ``per_symbol``: of a landing
    with a folder for each symbol, with the column ``_metadata`` of the files."""
    full, path = with_partitions(schema, T.StructField(DATE_COL, T.DateType())), f"{root.rstrip('/')}/{DATE_COL}={snapshot_date}"
    try:
        if per_symbol:
            df = read_folders(spark, lambda s, o: read_json(spark, path, s, {**(options or {}), **o}), full, [DATE_COL, "symbol"], metadata=True)
        else:
            df = read_json(spark, path, full, {"basePath": root, **(options or {})})
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
    return df.filter(F.col(DATE_COL) == F.lit(snapshot_date).cast("date"))


def scan_date_flagged(spark: SparkSession, root: str, schema: T.StructType, snapshot_date: str) -> DataFrame:
    """:func:`scan_date` with the text of records that are no JSON object in ``_corrupt_record`` (Q1).

    A value that does not fit its declared type is null and costs nothing else
    of its record; ``_bad_values`` counts them.
    """
    rows = scan_date(spark, root, with_partitions(schema, T.StructField(CORRUPT, T.StringType())), snapshot_date,
                     {"columnNameOfCorruptRecord": CORRUPT})
    return rows.withColumn(BAD_VALUES, bad_values(F.col(CORRUPT))).withColumn(CORRUPT, malformed(F.col(CORRUPT)))


def scan_date_variant(spark: SparkSession, root: str, snapshot_date: str) -> DataFrame:
    """The records of one date, whole, as VARIANT column ``doc``; no rows without a folder, null where a line is no JSON."""
    path = f"{root.rstrip('/')}/{DATE_COL}={snapshot_date}"
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    return lines.select(F.try_parse_json("value").alias("doc"))


def whole_files(spark: SparkSession, paths: str | Sequence[str], key: str = "path_symbol") -> DataFrame:
    """One document per file, over as many lines as it has (S5, S11): ``key`` from the file's place, its ``file_path`` as
    in a manifest, and its text ``doc``.

    The key is the value of the folder ``symbol=<value>`` that holds the file,
    else the file's name before its first dot. A file is one row, so it should
    be of a document's size; many small documents belong in a landing of lines.
    """
    rows = spark.read.text(paths, wholetext=True, recursiveFileLookup=True)
    path = _plain(F.col("_metadata.file_path"))
    folder = F.regexp_extract(path, "/symbol=([^/]+)/[^/]*$", 1)  # whose value is escaped in turn
    return rows.select(F.when(folder != "", _plain(folder)).otherwise(path_key(path)).alias(key), F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("doc"))


def read_with_fallback(spark: SparkSession, path: str, backcompat: str | None,
                       schema: T.StructType) -> DataFrame:
    """Read ``path``; if it does not exist, read ``backcompat`` instead."""
    try:
        df = read_json(spark, path, schema)
        df.schema  # path resolution happens at analysis  # noqa: B018
        return df
    except AnalysisException as e:
        if backcompat is None or "PATH_NOT_FOUND" not in str(e):
            raise
        return read_json(spark, backcompat, schema)


def read_ragged(spark: SparkSession, paths: str | Sequence[str], partitions: Sequence[T.StructField] = ()) -> DataFrame:
    """Any number of snapshots of JSON lines whose columns differ, as one frame with the columns of all.

    Two scans, whatever the number of snapshots: one reads every record as a
    VARIANT and aggregates the names and kinds that occur (the driver gets
    these distinct pairs), the other reads the records with the merged columns.
    Types widen along ``functions.types``: whole numbers, double, string;
    objects and arrays are JSON text. ``partitions``: folders' columns.
    """
    folders = T.StructType(list(partitions))
    base = spark.read.schema(T.StructType([T.StructField("value", T.StringType()), *folders])).text(paths)
    each = base.select(F.explode(nested.fields(F.try_parse_json("value"))).alias("k", "v")).select("k", nested.kind(F.col("v")).alias("kind"))
    found = sorted(map(tuple, each.distinct().collect()))
    merged = T.StructType([T.StructField(k, t) for k, t in widened((k, VARIANT_TYPES.get(kind, T.StringType())) for k, kind in found).items()])
    return read_json(spark, paths, T.StructType([*merged, *[f for f in folders if f.name not in merged.names]]))


def stage_read(spark: SparkSession, root: str, name: str, snapshot_date: str,
               fmt: str = "parquet") -> DataFrame:
    """Staged table of one date."""
    return spark.read.format(fmt).load(stage_path(root, snapshot_date, name))


def stage_read_typed(spark: SparkSession, root: str, snapshot_date: str, fmt: str = "parquet") -> DataFrame:
    """The one-pass typed staging of one date (see ``writers.stage_write_typed``).

    Raises if no column tells its group but there are series rows, whose values
    would else be lost.
    """
    path, reader = stage_path(root, snapshot_date, "typed"), spark.read.format(fmt).options(**stage_options(fmt))
    if fmt != "parquet":
        try:
            columns = spark.read.text(stage_path(root, snapshot_date, "typed_columns")).first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            raise ValueError(f"no column groups beside {path}: write the staging again") from e
        reader = reader.schema(T.StructType.fromJson(json.loads(columns)))
    typed = reader.load(path)
    if not any(group_of(f) for f in typed.schema.fields):
        if not typed.filter(F.col("type").isin(TYPE_QUARTERLY, TYPE_ANNUAL)).isEmpty():
            raise ValueError(f"series rows, but no column groups in {path}: write the staging again")
    return typed


def with_path_key(df: DataFrame, name: str = "path_symbol") -> DataFrame:
    """Entity key from each record's source file name."""
    return df.withColumn(name, path_key(F.col("_metadata.file_path")))
