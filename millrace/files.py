"""Thin access to the Hadoop file system that Spark itself uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty if it is missing, any other error raises."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def create_text(spark: SparkSession, path: str, lines: list[str]) -> None:
    """Write a text file that must not exist yet.

    The lines go to a hidden file first; renaming it, which does not overwrite, is the
    commit point: readers see all or nothing, and of two writers one fails.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder, _, name = path.rpartition("/")
    fs, hidden = _fs(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    try:
        for start in range(0, len(lines), 2000):
            out.write(bytearray(("\n".join(lines[start : start + 2000]) + "\n").encode("utf-8")))
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    context.rename(hidden, jvm.org.apache.hadoop.fs.Path(path), options)


def first_line(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = spark._jvm.java.io.InputStreamReader(stream, "UTF-8")
        return spark._jvm.java.io.BufferedReader(reader).readLine()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)
