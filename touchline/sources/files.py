"""Small file operations of the driver on any store that Spark reaches (Hadoop
file systems): listing folders, and records that appear whole or not at all."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``, sorted; none if it doesn't exist."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where))


def folder_state(spark: SparkSession, path: str) -> list:
    """Number of files, bytes and time of the last change of a folder."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return []
    held = fs.getContentSummary(where)
    return [held.getFileCount(), held.getLength(), fs.getFileStatus(where).getModificationTime()]


def read_record(spark: SparkSession, path: str) -> dict:
    fs, where = _open(spark, path)
    stream = fs.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_record(spark: SparkSession, path: str, record: dict) -> None:
    """Written aside and renamed, so that a reader sees all of it or nothing;
    FileExistsError if there is one of that name."""
    fs, where = _open(spark, path)
    folder, _, name = path.rpartition("/")
    _, aside = _open(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(json.dumps(record, indent=1, sort_keys=True).encode()))
    finally:
        stream.close()
    if fs.exists(where) or not fs.rename(aside, where):
        fs.delete(aside, False)
        raise FileExistsError(path)


def move_folder(spark: SparkSession, path: str, target: str) -> None:
    fs, where = _open(spark, path)
    if not fs.rename(where, _open(spark, target)[1]):
        raise OSError(f"cannot move {path} to {target}")


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.delete(where, True)
