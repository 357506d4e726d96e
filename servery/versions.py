"""Folders whose contents are named by a pointer.

Readers of a folder that changes while it is read need to know which of its parts belong together.
Each change writes its parts under new names and then one small file of the next number, which
names all that counts from now on; the largest number is the pointer. It appears by a rename to
a name that was not there before, whole or not at all. Parts that fell out of use are deleted
some versions later, when readers of the older pointers are done, so a folder stays bounded.
"""

from __future__ import annotations

import json
import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Versions for which parts are kept that are no longer named.
GRACE = 5
_FOLDER, _NAME = "_versions", re.compile(r"(\d{20})\.json")


def _located(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds; nothing if it is not there."""
    fs, path = _located(spark, folder)
    return [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, read by the driver."""
    fs, target = _located(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    found = map(_NAME.fullmatch, file_names(spark, f"{folder}/{_FOLDER}"))
    return sorted(int(m[1]) for m in found if m)


def current_version(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """The number and contents of the pointer; -1 and nothing before the first."""
    while numbers := _numbers(spark, folder):
        try:
            return numbers[-1], json.loads(read_text(spark, f"{folder}/{_FOLDER}/{numbers[-1]:020d}.json"))
        except Py4JJavaError as gone:
            # Several versions came while the list was read, and took this one away.
            if "FileNotFoundException" not in str(gone.java_exception) or _numbers(spark, folder)[-1:] == numbers[-1:]:
                raise
    return -1, {}


def publish_version(spark: SparkSession, folder: str, contents: dict, unused: list[str], grace: int = GRACE) -> int:
    """Makes ``contents`` the next version. ``unused`` are parts, relative to the folder, that it
    names no longer; they and older pointers go ``grace`` versions later. One writer at a time."""
    last, before = current_version(spark, folder)
    number = last + 1
    retired = before.get("_retired", []) + [[number, part] for part in unused]
    due = [part for since, part in retired if since + grace <= number]
    value = contents | {"_retired": [r for r in retired if r[0] + grace > number]}
    fs, part = _located(spark, f"{folder}/{_FOLDER}/.{number}.tmp")
    stream = fs.create(part, True)
    stream.write(bytearray(json.dumps(value).encode()))
    stream.close()
    _, target = _located(spark, f"{folder}/{_FOLDER}/{number:020d}.json")
    if not fs.rename(part, target):
        raise OSError(f"version {number} of {folder} is there already: two writers?")
    for old in due:
        fs.delete(_located(spark, f"{folder}/{old}")[1], True)
    for old in _numbers(spark, folder):
        if old + grace <= number:
            fs.delete(_located(spark, f"{folder}/{_FOLDER}/{old:020d}.json")[1], False)
    return number
