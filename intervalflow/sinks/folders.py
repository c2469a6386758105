"""Layouts of very many small files on a machine's own disk (``file:``), as a folder for each meter and day is.

Without its native library, Hadoop's local file system starts a ``chmod`` process for each folder and each file that it makes, and a
scan lists every file on the driver and opens each with the cost of a large one.  Here tasks make, list and read the folders with
plain file calls and Arrow.  The folders, their names and the Parquet files in them are those that Spark writes, so either
side reads and replaces what the other wrote; other stores and types go through Spark's own writer and reader (:func:`fits`).
"""

from __future__ import annotations

import os
import re
import sys
import uuid
from typing import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_path
from . import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this package

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_PLAIN = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.DateType,
          T.TimestampType, T.TimestampNTZType, T.BinaryType)
#: Characters that Spark escapes in folder names.
_ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")
_CODECS = {"uncompressed": "none", "lz4_raw": "lz4", "lz4raw": "lz4"}
#: Folders or files that a task names at once.
_NAMES = 1_000


def local(spark: SparkSession, root: str) -> str | None:
    """The path of ``root`` on the machine's own file system; None if it lies on another store."""
    fs, path = files._at(spark, root)
    uri = fs.makeQualified(path).toUri()
    return uri.getPath().rstrip("/") if uri.getScheme() == "file" else None


def fits(spark: SparkSession, root: str, schema: T.StructType, partition_cols: Sequence[str]) -> bool:
    return bool(set(schema.fieldNames()) - set(partition_cols)) and all(type(f.dataType) in _PLAIN for f in schema) and local(spark, root) is not None


def _folder(names: Sequence[str], value: str) -> str:
    plain = [_ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", x) for x in (*names, *value.split("\0"))]
    return "/".join(f"{n}={v or NO_VALUE}" for n, v in zip(plain[:len(names)], plain[len(names):], strict=True))


def _named(rows: list[tuple], names: Sequence[str], kinds: Sequence[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list(names))


def write(df: DataFrame, root: str, partition_cols: Sequence[str], replace: bool, max_records_per_file: int) -> None:
    """Write ``df``, whose rows of one folder lie in one task and one after another, below ``root``; ``replace`` drops the files that these
    folders had.  Tasks write all files to a staging folder, a task's attempt into its own; when every task has ended, a second job moves them to
    their places, which a repeated task of it does not do twice.  A failed first job leaves the lake as it was."""
    spark, job = df.sparkSession, uuid.uuid4().hex
    base = local(spark, root)
    stage, levels = f"{base}/.staging-{job}", list(partition_cols)
    codec = spark.conf.get("spark.sql.parquet.compression.codec").lower()
    codec = _CODECS.get(codec, codec)
    # One text of all partition values; Spark stores an empty one like null.
    values = F.concat_ws("\0", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in levels])
    data = [c for c in df.columns if c not in levels]

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        own = str(task.taskAttemptId())
        os.makedirs(f"{stage}/{own}", exist_ok=True)
        kinds = (pa.string(), pa.list_(pa.string()), pa.int32())
        value, out, n, number, names, done = None, None, 0, 0, [], []
        for batch in batches:
            rows = batch.select(data)
            runs, start = pc.run_end_encode(batch.column(0)), 0
            for v, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if v != value:
                    if out is not None:
                        out.close()
                        done.append((_folder(levels, value), names, task.partitionId()))
                    value, out, names = v, None, []
                while start < end:
                    if out is not None and n >= max_records_per_file:
                        out.close()
                        out = None
                    if out is None:
                        names.append(f"{own}/{number}")
                        out, n, number = pq.ParquetWriter(f"{stage}/{own}/{number}", rows.schema, compression=codec, use_dictionary=False, store_schema=False,
                                                          store_decimal_as_integer=True), 0, number + 1
                    piece = rows.slice(start, min(end - start, max_records_per_file - n))
                    out.write_batch(piece)
                    n, start = n + piece.num_rows, start + piece.num_rows
            if len(done) >= _NAMES:
                yield _named(done, ("folder", "staged", "part"), kinds)
                done = []
        if out is not None:
            out.close()
            done.append((_folder(levels, value), names, task.partitionId()))
        if done:
            yield _named(done, ("folder", "staged", "part"), kinds)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, parts, part in zip(*(c.to_pylist() for c in batch.columns)):
                to, names = f"{base}/{folder}", [f"part-{part:05d}-{job}.c{i:03d}.parquet" for i in range(len(parts))]
                os.makedirs(to, exist_ok=True)
                for at, name in zip(parts, names):
                    try:
                        os.rename(f"{stage}/{at}", f"{to}/{name}")
                    except FileNotFoundError:  # an earlier attempt of this task moved it
                        if not os.path.exists(f"{to}/{name}"):
                            raise
                for old in [e.path for e in os.scandir(to) if e.name not in names and e.is_file()] if replace else []:
                    try:
                        os.remove(old)
                    except FileNotFoundError:
                        pass
            yield _named([(batch.num_rows,)], ["n"], [pa.int64()])

    listing = scratch_path(spark, "folders")
    try:
        df.select(values.alias("_values"), *data).mapInArrow(lay, "folder string, staged array<string>, part int").write.parquet(listing)
        made = spark.read.schema("folder string, staged array<string>, part int").parquet(listing)
        made.repartition(2 * spark.sparkContext.defaultParallelism).mapInArrow(move, "n long").agg(F.sum("n")).collect()
    finally:
        files.delete(spark, f"{root.rstrip('/')}/.staging-{job}")
        files.delete(spark, listing)
    files.write_text(spark, f"{root.rstrip('/')}/_SUCCESS", "")
    spark.catalog.refreshByPath(root)


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _entries(folder: str) -> list[os.DirEntry]:
    with os.scandir(folder) as found:
        return sorted((e for e in found if not _hidden(e.name)), key=lambda e: e.name)


def _first_file(folder: str, under: tuple[str, ...] = ()) -> tuple[str, ...] | None:
    """The folders above some file; None if there is no file."""
    return next((at for e in _entries(folder) if (at := _first_file(e.path, (*under, e.name)) if e.is_dir() else under) is not None), None)


def _below(base: str, under: str, levels: Sequence[str], depth: int) -> Iterator[str]:
    """What lies ``depth`` levels below ``base``: its folders, or the files if ``depth`` is beyond the last level."""
    at = under.count("/") + 1 if under else 0
    for e in _entries(f"{base}/{under}"):
        to = f"{under}/{e.name}" if under else e.name
        if e.is_dir() != (at < len(levels)) or at < len(levels) and e.name.partition("=")[0] != levels[at]:
            raise ValueError(f"{base}/{to}: not in the layout {'/'.join(levels)}")
        if at + 1 < depth:
            yield from _below(base, to, levels, depth)
        else:
            yield to


def _rows(path: str, want: pa.Schema) -> pa.Table:
    if not os.path.getsize(path):  # Spark passes over empty files
        return want.empty_table()
    with pq.ParquetFile(path, coerce_int96_timestamp_unit="us") as f:
        stored = {n.lower(): n for n in f.schema_arrow.names}
        has = [stored[n.lower()] for n in want.names if n.lower() in stored]
        got = f.read(columns=has, use_threads=False).select(has)
    if got.schema.equals(want):
        return got
    columns = {n.lower(): c for n, c in zip(got.column_names, got.columns)}
    return pa.table([columns[f.name.lower()].cast(f.type) if f.name.lower() in columns else pa.nulls(got.num_rows, f.type) for f in want], want)


def read(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame | None:
    """The lake at ``root``, listed and read by tasks; None if Spark's reader has to do it.  Conditions on the partition columns hold
    before files are opened.  A file outside of the layout is an error, not left out."""
    base = local(spark, root)
    under = _first_file(base) if base else None
    levels = [n.partition("=")[0] for n in under or ()]
    if not levels or len({*levels}) < len(levels) or not {*levels} <= {*schema.fieldNames()} or not fits(spark, root, schema, levels):
        return None
    stored = T.StructType([f for f in schema if f.name not in levels])
    want, top = to_arrow_schema(stored), min(2, len(levels))

    def listed(depth: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = []
            for batch in batches:
                for at in batch.column(0).to_pylist():
                    for name in _below(base, at, levels, depth):
                        found.append(name)
                        if len(found) == _NAMES:
                            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["path"])
                            found = []
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["path"])
        return run

    @F.arrow_udf(T.ArrayType(stored))
    def rows(paths: pa.Array) -> pa.Array:
        tables = [_rows(f"{base}/{p}", want) for p in paths.to_pylist()]
        ends = pa.array([0, *(t.num_rows for t in tables)], pa.int32())
        whole = pa.concat_tables([want.empty_table(), *tables]).combine_chunks()
        columns = [pa.concat_arrays([pa.array([], f.type), *c.chunks]) for f, c in zip(want, whole.columns)]
        return pa.ListArray.from_arrays(pc.cumulative_sum(ends), pa.StructArray.from_arrays(columns, fields=list(want)))

    def value(name: str) -> F.Column:
        text = F.regexp_extract("path", f"(?:^|/){re.escape(name)}=([^/]*)/", 1)
        plain = F.when(F.contains(text, F.lit("%")), F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))).otherwise(text)
        return F.when(text != NO_VALUE, plain).cast(schema[name].dataType).alias(name)

    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    folders = spark.range(0, 1, 1, 1).select(F.lit("").alias("path")).mapInArrow(listed(top), "path string")
    found = folders.repartition(tasks).mapInArrow(listed(len(levels) + 1), "path string")
    return found.select(*[value(c) for c in levels], F.explode(rows("path")).alias("_row")).select("_row.*", *levels)
