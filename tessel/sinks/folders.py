"""A folder for each entity in a file system that all machines mount (``file:``).

Without its native library Hadoop starts a process (``chmod``) there for every
folder, file and checksum it makes: three an entity, which was 70 % of the time
of such a write. Here the tasks make them by themselves, as Spark's
writer does: the same folders and file names, checksum files, modes, Parquet
metadata and commit. Each attempt of a task writes into a folder of its own
below a hidden one; when all tasks have ended, the folders of those that count
are moved to their places, so a failed write or a task tried again leaves
nothing. Another file system, or a type not named below, is left to Spark's
writer.
"""

from __future__ import annotations

import os
import re
import shutil
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from itertools import groupby

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import quoted

# Spark's escapes in names of folders and its name for no value; suffixes of compressed Parquet files;
# types that Arrow writes to Parquet as Spark does.
_ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_CODECS = {"snappy": ".snappy", "gzip": ".gz", "zstd": ".zstd", "none": "", "uncompressed": ""}
_TYPES = (T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(),
          T.BinaryType(), T.DateType(), T.TimestampNTZType())  # and decimals


def _same_in_arrow(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return len(t.fields) > 0 and all(_same_in_arrow(f.dataType) for f in t)
    if isinstance(t, T.MapType):
        return _same_in_arrow(t.keyType) and _same_in_arrow(t.valueType)
    return _same_in_arrow(t.elementType) if isinstance(t, T.ArrayType) else isinstance(t, T.DecimalType) or t in _TYPES


def folder_name(column: str, value: str | None) -> str:
    """``<column>=<value>``, escaped as Spark does."""
    plain = lambda s: _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", s)
    return f"{plain(column)}={plain(value) if value else NO_VALUE}"


class _Checked:
    """A new file for writing, with Hadoop's checksums of its blocks beside it."""

    BLOCK = 512
    closed = False

    def __init__(self, path: bytes):
        self.file = open(path, "xb")  # noqa: SIM115
        self.sums_at = os.path.join(os.path.dirname(path), b"." + os.path.basename(path) + b".crc")
        self.sums, self.rest = bytearray(b"crc\0" + struct.pack(">i", self.BLOCK)), b""

    def write(self, data) -> int:
        self.file.write(data)
        rest = self.rest + bytes(data)
        whole = len(rest) - len(rest) % self.BLOCK
        for i in range(0, whole, self.BLOCK):
            self.sums += struct.pack(">I", zlib.crc32(rest[i:i + self.BLOCK]))
        self.rest = rest[whole:]
        return len(data)

    def flush(self) -> None:
        self.file.flush()

    def close(self) -> None:
        if not self.closed:
            self.closed = True
            self.file.close()
            with open(self.sums_at, "xb") as f:
                f.write(self.sums + (struct.pack(">I", zlib.crc32(self.rest)) if self.rest else b""))


class _Lines(_Checked):
    """Texts, one a line."""

    def write_rows(self, rows) -> None:
        import pyarrow as pa
        self.write(b"".join(x + b"\n" for x in rows.column(0).cast(pa.binary()).to_pylist()))


class _Parquet(_Checked):
    def __init__(self, path: bytes, schema, codec: str, notes: dict[str, str]):
        import pyarrow.parquet as pq
        super().__init__(path)
        self.parquet = pq.ParquetWriter(self, schema, compression=codec, store_schema=False, write_page_checksum=True, store_decimal_as_integer=True)
        self.parquet.add_key_value_metadata(notes)

    def write_rows(self, rows) -> None:
        self.parquet.write_batch(rows)

    def close(self) -> None:
        if not self.closed:
            self.parquet.close()
            super().close()


def _task(staging: bytes, job: str, names: Sequence[str], columns: Sequence[str], encoding: str, umask: int, codec: str | None, notes: dict[str, str]):
    """For mapInArrow over rows sorted by their last columns, the values of ``columns``: writes a file for each run of
    equal values, and returns the folder of the attempt. ``codec``: None for lines of text, else of columns ``names``."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        task, old = TaskContext.get(), os.umask(umask)
        attempt = os.path.join(staging, b"%d" % task.taskAttemptId())
        suffix = ".json" if codec is None else f"{_CODECS[codec]}.parquet"
        out, last = None, None

        def opened(values, schema):
            folder = os.path.join(attempt, *[folder_name(c, v).encode(encoding, "replace") for c, v in zip(columns, values, strict=True)])
            os.makedirs(folder, exist_ok=True)
            for n in range(1 << 30):  # more than one where the encoding makes one of different values
                path = os.path.join(folder, f"part-{task.partitionId():05d}-{job}.c{n:03d}{suffix}".encode())
                if not os.path.exists(path):
                    return _Lines(path) if codec is None else _Parquet(path, schema, "none" if codec == "uncompressed" else codec, notes)

        try:
            for batch in batches:
                k = batch.num_columns - len(columns)
                rows, at = batch.select(range(k)), 0
                rows = rows if codec is None else rows.rename_columns(names)
                for values, same in groupby(zip(*[c.to_pylist() for c in batch.columns[k:]], strict=True)):
                    n = sum(1 for _ in same)
                    if out is None or values != last:
                        if out is not None:
                            out.close()
                        out, last = opened(values, rows.schema), values
                    out.write_rows(rows.slice(at, n))
                    at += n
            if out is not None:
                out.close()
                yield pa.RecordBatch.from_pydict({"attempt": [attempt]}, pa.schema([("attempt", pa.binary())]))
        finally:
            os.umask(old)
    return run


def _leaves(top: bytes, depth: int) -> Iterator[bytes]:
    """Folders ``depth`` levels below ``top``, from there."""
    with os.scandir(top) as found:
        for x in found:
            yield from ([x.name] if depth == 1 else (os.path.join(x.name, y) for y in _leaves(x.path, depth - 1)))


def _moved(attempt: bytes, place: bytes, depth: int, umask: int) -> None:
    """An attempt's folders to their places; one that is there already, from another task, gets the files. Again, or by
    two at once, it moves what is left."""
    old = os.umask(umask)
    try:
        parents = set()
        for leaf in list(_leaves(attempt, depth)):
            source, to = os.path.join(attempt, leaf), os.path.join(place, leaf)
            if (parent := os.path.dirname(to)) not in parents:
                os.makedirs(parent, exist_ok=True)
                parents.add(parent)
            try:
                os.rename(source, to)
            except FileNotFoundError:
                continue  # another try of this task was here
            except OSError:
                if not os.path.isdir(to):
                    raise
                for x in os.listdir(source):
                    try:
                        os.replace(os.path.join(source, x), os.path.join(to, x))
                    except FileNotFoundError:
                        continue
    finally:
        os.umask(old)


def write(df: DataFrame, path: str, fmt: str, columns: Sequence[str]) -> bool:
    """Each task writes the rows it holds, a file for each of its values of ``columns``; folders that are there are
    replaced, others left (dynamic partition overwrite). False, and nothing done, if this is for Spark's writer."""
    spark = df.sparkSession
    data = T.StructType([f for f in df.schema if f.name not in columns])
    codec = spark.conf.get("spark.sql.parquet.compression.codec").lower() if fmt == "parquet" else None
    if fmt not in ("parquet", "json") or not data.fields or not set(columns) <= set(df.columns) or (codec and (codec not in _CODECS or not _same_in_arrow(data))):
        return False
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:  # sessions without a local SparkContext (e.g. Spark Connect)
        return False
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(conf)
    if fs.getUri().getScheme() != "file":
        return False
    encoding = jvm.System.getProperty("sun.jnu.encoding") or "UTF-8"
    umask = jvm.org.apache.hadoop.fs.permission.FsPermission.getUMask(conf).toShort()
    root = fs.makeQualified(place).toUri().getPath().encode(encoding)
    job = str(uuid.uuid4())
    staging = os.path.join(root, f".spark-staging-{job}".encode())
    keys = [f"_folder_{i}" for i in range(len(columns))]
    held = [F.col(quoted(f.name)) for f in data]
    held = [F.to_json(F.struct(*held))] if codec is None else held
    held = [c.alias(f"_{i}") for i, c in enumerate(held)]  # mapInArrow takes no names with dots
    rows = df.select(*held, *[F.nullif(F.col(quoted(c)).cast("string"), F.lit("")).alias(k) for c, k in zip(columns, keys, strict=True)])
    notes = {"org.apache.spark.version": spark.version, "org.apache.spark.sql.parquet.row.metadata": data.json()}
    task = _task(staging, job, data.names, list(columns), encoding, umask, codec, notes)
    old, replaces = os.umask(umask), os.path.isdir(root)
    try:
        os.makedirs(root, exist_ok=True)
    finally:
        os.umask(old)
    depth = len(columns)
    try:
        attempts = [bytes(r.attempt) for r in rows.sortWithinPartitions(*keys).mapInArrow(task, "attempt binary").collect()]
        if replaces:
            for to in {os.path.join(root, x) for a in attempts for x in _leaves(a, depth)}:
                if os.path.isdir(to):
                    shutil.rmtree(to)
        if attempts:
            spark.sparkContext.parallelize(attempts, len(attempts)).foreach(lambda a: _moved(a, root, depth, umask))
    finally:
        shutil.rmtree(staging, ignore_errors=True)
    return True
