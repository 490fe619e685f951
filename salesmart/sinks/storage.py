"""Small file operations through Hadoop's file system API, on whatever file system a path names."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    """(file system, path) on the JVM side."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(conf), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none when it is not there."""
    fs, where = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(where)] if fs.exists(where) else []


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False when it is there already (the file system decides, not a check before)."""
    fs, where = _fs(spark, path)
    try:
        out = fs.create(where, False)
    except Py4JJavaError as exc:
        # file systems name a file that is there by either exception
        if exc.java_exception.getClass().getSimpleName() in ("FileAlreadyExistsException", "RemoteException") or (
            "already exists" in str(exc.java_exception.getMessage())
        ):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_small(spark: SparkSession, path: str) -> str:
    """A small text file's content."""
    return "\n".join(r.value for r in spark.read.text(path).collect())


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def move(spark: SparkSession, source: str, target: str, replace: bool = False) -> bool:
    """Rename ``source`` to ``target``; False when there is no source. ``replace`` removes an older target."""
    fs, a = _fs(spark, source)
    _, b = _fs(spark, target)
    if not fs.exists(a):
        return False
    if replace and fs.exists(b):
        fs.delete(b, True)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"could not move {source} to {target}")
    return True
