"""Small files and folders on the session's file systems, through Hadoop's interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if there is no such folder."""
    fs, p = _at(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; readers of the final name see all of it or nothing."""
    folder, name = path.rsplit("/", 1)
    fs, draft = _at(spark, f"{folder}/.{name}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.rename(draft, _at(spark, path)[1]) and not fs.exists(_at(spark, path)[1]):
        raise OSError(f"cannot write {path}")
