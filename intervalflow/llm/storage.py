"""Intermediate tables and files in the shared folder of the session (``spark.checkpoint.dir``)."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from intervalflow.session import scratch_path


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back: lineage ends here, the job survives lost
    executors, and the planner knows the table's size."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for t in tables:
        for f in {x.rsplit("/", 1)[0] for x in t.inputFiles()}:
            if "-scratch/" in f:
                _delete(spark, f)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def collected(df: DataFrame, tag: str) -> pa.Table:
    """The rows of ``df``, of which there must be a bounded number, in this process.  Tasks write them to the shared folder and the files are
    read here one at a time, in the order of the partitions: ``toArrow`` has all rows on the heap of the driver's JVM on their way, several
    times over.  It is used only where Arrow does not know the folder's store.  Who is done with the rows calls ``release``."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    try:
        files, folder = open_path(qualified(spark, path))
        names = [f.path for f in files.get_file_info(pafs.FileSelector(folder)) if f.base_name.startswith("part-")]
    except (ValueError, OSError, NotImplementedError):
        got = spark.read.schema(df.schema).parquet(path).toArrow()
    else:
        got = pa.concat_tables([_read(files, x) for x in sorted(names, key=lambda x: (len(x), x))])
    _delete(spark, path)
    release()
    return got


def release() -> None:
    """Give memory that Arrow has freed in this process back to the system; its allocator keeps it otherwise."""
    pa.default_memory_pool().release_unused()


def _read(files: pafs.FileSystem, name: str) -> pa.Table:
    with files.open_input_file(name) as f:
        return pq.ParquetFile(f).read(use_threads=False)


#: Hadoop's names of stores that Arrow knows by another one.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme and host that Spark resolves it with: a path without a scheme lies on the session's default file system,
    which need not be the machine's own."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a qualified path, and the path on it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    if not rest.startswith("//"):
        raise ValueError(f"not a qualified path: {path}")
    return pafs.FileSystem.from_uri(f"{_ARROW_SCHEMES.get(scheme, scheme)}:{rest}")
