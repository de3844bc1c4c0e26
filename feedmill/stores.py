"""Small files and folders of the session's own file systems, from the driver."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def place(spark: SparkSession, path: str):
    """A path of the file system's own kind, and that file system."""
    jvm = spark._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    there, store = place(spark, path)
    return store.exists(there)


def delete(spark: SparkSession, path: str) -> bool:
    there, store = place(spark, path)
    return store.delete(there, True)


def read_json(spark: SparkSession, path: str) -> dict | None:
    """A small JSON file; None if there is none, or only a part of one."""
    there, store = place(spark, path)
    if not store.exists(there):
        return None
    stream = store.open(there)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except json.JSONDecodeError:
        return None
    finally:
        stream.close()


def create_json(spark: SparkSession, path: str, value: dict, renew: bool = False) -> bool:
    """Make a small JSON file; False if another writer made it first. ``renew`` replaces a part of one."""
    from py4j.protocol import Py4JJavaError

    there, store = place(spark, path)
    try:
        stream = store.create(there, renew)
    except Py4JJavaError:
        if store.exists(there):
            return False
        raise
    try:
        stream.write(bytearray(json.dumps(value).encode()))
    finally:
        stream.close()
    return True
