"""Incremental pickup of new landings (S8) and new keys (J4, streaming form).

The reference re-runs a weekly job over everything; here new files are found
by the Structured Streaming file source and processed once: the checkpoint
records which files were consumed, so a second ``availableNow`` run over the
same landing processes nothing and the file sink gains no duplicates.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..functions.json import CORRUPT, JSON_OPTIONS, malformed, parse_json


def landing_stream(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "json",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    opts = dict(JSON_OPTIONS) if fmt == "json" else {}
    opts["multiLine"] = "false"
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    return spark.readStream.schema(schema).format(fmt).options(**opts).load(root)


def ingest_available(stream: DataFrame, sink_path: str, checkpoint: str,
                     partition_cols: Sequence[str] = ()) -> None:
    """Process everything available now into a parquet sink, then stop."""
    w = (stream.writeStream.format("parquet").option("path", sink_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append"))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    q = w.start()
    q.awaitTermination()


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys, null keys included."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def track_new_keys(stream: DataFrame, keys: Sequence[str], key_table: str, checkpoint: str) -> None:
    """Append to ``key_table`` the keys never seen before.

    State lives in the key table, not in the streaming state store, so it does
    not grow in executor memory. Each micro-batch de-duplicates its keys and
    (a null key counts as one) first finds which of them the table already has with a semi join whose
    build side is the batch (AQE broadcasts it when its runtime size is small,
    so the growing table is scanned but never shuffled); the anti join that
    follows only meets batch-sized inputs. New keys go into a folder named by
    the batch id in overwrite mode, so a replayed batch replaces its own
    output instead of duplicating it.
    """
    k = list(keys)
    spark = stream.sparkSession

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        keys_in_batch = batch.select(*k).distinct().persist()  # used by both joins
        fresh = keys_in_batch
        try:
            table = spark.read.parquet(key_table).filter(F.col("batch_id") != batch_id).select(*k)
            seen = table.join(keys_in_batch, _same(table, keys_in_batch, k), "left_semi").distinct()
            fresh = keys_in_batch.join(seen, _same(keys_in_batch, seen, k), "left_anti")
        except AnalysisException as e:  # first batch: no table yet
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        fresh.write.mode("overwrite").parquet(f"{key_table}/batch_id={batch_id}")
        keys_in_batch.unpersist()

    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_seen(stream: DataFrame, keys: Sequence[str], sink_path: str, checkpoint: str) -> None:
    """Append to ``sink_path`` each key when it is first seen, remembered in the stream's own state.

    The state is keyed by the hash partitions of the keys and kept in RocksDB:
    on an executor's disk while it runs, with changelogs in the checkpoint
    folder, from which a later run goes on. It grows with the distinct keys,
    not with the rows; a null key is a key like any other. Compared with
    :func:`track_new_keys` no table is scanned in a batch, and the batches of
    one state have a fixed number of partitions: that of the first run.
    """
    spark = stream.sparkSession
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        fresh = stream.select(*keys).dropDuplicates(list(keys))
        ingest_available(fresh, sink_path, checkpoint)
    finally:
        spark.conf.set(STATE_STORE, before)


ROUTE, GOOD, BAD = "route", "good", "quarantine"


class Progress(StreamingQueryListener):
    """Sums, over a stream's batches, what they observed under a name (A3)."""

    def __init__(self, name: str):
        self.name, self.totals, self.batches, self.over = name, {}, 0, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None and event.progress.numInputRows:
            self.batches += 1
            for k, v in row.asDict().items():
                self.totals[k] = self.totals.get(k, 0) + (v or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.over.set()


def ingest_routed(spark: SparkSession, root: str, schema: T.StructType, sink_path: str, checkpoint: str,
                  max_files_per_trigger: int | None = None) -> Progress:
    """Lines of JSON into a Parquet sink with a folder for good records and one for lines that are no JSON object.

    One pass inside the stream: a line is parsed once and goes to the route it
    belongs to, with its fields or with its text. The counts of both come from
    an observation on the batches themselves; ``Progress`` holds their sums.
    """
    lines = landing_stream(spark, root, T.StructType([T.StructField("value", T.StringType())]), "text", max_files_per_trigger)
    noted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.inline(F.array(F.struct(parse_json(F.col("value"), noted, {"columnNameOfCorruptRecord": CORRUPT}).alias("p"))))
    rows = lines.select(parsed).select("p.*").withColumn(CORRUPT, malformed(F.col(CORRUPT)))
    bad = F.col(CORRUPT).isNotNull()
    name = f"routes_{uuid.uuid4().hex[:8]}"
    rows = rows.withColumn(ROUTE, F.when(bad, BAD).otherwise(GOOD))
    rows = rows.observe(name, F.count_if(~bad).alias(GOOD), F.count_if(bad).alias(BAD))
    progress = Progress(name)
    spark.streams.addListener(progress)
    try:
        ingest_available(rows, sink_path, checkpoint, [ROUTE])
        if not progress.over.wait(60):  # events come on a thread of their own
            raise TimeoutError("the stream has ended, but its listener has not been told")
    finally:
        spark.streams.removeListener(progress)
    return progress


def read_route(spark: SparkSession, sink_path: str, schema: T.StructType, route: str) -> DataFrame:
    """One route of :func:`ingest_routed`: the fields, or ``text``."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType()), T.StructField(ROUTE, T.StringType())])
    rows = spark.read.schema(full).parquet(sink_path).filter(F.col(ROUTE) == route)
    return rows.select(F.col(CORRUPT).alias("text")) if route == BAD else rows.select(*schema.names)
