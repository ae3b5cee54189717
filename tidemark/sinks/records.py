"""Small numbered JSON records beside a table: the next number goes to one writer only."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

# So many records before the latest one stay, for whoever wants to look back.
KEPT = 100
NUMBERED = re.compile(r"^(\d{20})\.json$")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_path(spark, path))


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies directly in a folder; nothing if there is none."""
    fs, at = file_system(spark, folder), _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def found(spark: SparkSession, pattern: str) -> bool:
    """Whether a glob pattern finds anything."""
    return bool(file_system(spark, pattern).globStatus(_path(spark, pattern)))


def delete(spark: SparkSession, pattern: str) -> None:
    """Delete what a glob pattern finds, with all it holds."""
    fs = file_system(spark, pattern)
    for status in fs.globStatus(_path(spark, pattern)) or ():
        fs.delete(status.getPath(), True)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    file_system(spark, path).create(_path(spark, path), True).close()


def latest(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """The highest number and its record; (0, None) before the first."""
    number = max((int(m[1]) for m in map(NUMBERED.match, names(spark, folder)) if m), default=0)
    if not number:
        return 0, None
    stream = file_system(spark, folder).open(_path(spark, f"{folder}/{number:020d}.json"))
    try:
        return number, json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def put(spark: SparkSession, folder: str, number: int, record: dict) -> bool:
    """Store a record under `number`; False if somebody has taken the number.

    The record is written aside and renamed without overwriting, so it appears whole or not at all.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    aside, final = _path(spark, f"{folder}/.{uuid.uuid4().hex}"), _path(spark, f"{folder}/{number:020d}.json")
    fs = file_system(spark, folder)
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(json.dumps(record).encode()))
    finally:
        stream.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(final), options)
    except Exception:
        fs.delete(aside, False)
        if fs.exists(final):
            return False
        raise
    fs.delete(_path(spark, f"{folder}/{number - KEPT:020d}.json"), False)
    return True
