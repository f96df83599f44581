"""Small file-system helpers over Hadoop's FileSystem (works for any scheme
the cluster is configured for: hdfs://, s3a://, abfss://, file:)."""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def uri(spark: SparkSession, path: str) -> str:
    """The whole URI of a path, as libraries other than Hadoop read it (``file:///...``)."""
    fs, p = _fs(spark, path)
    return re.sub(r"^file:/+", "file:///", fs.makeQualified(p).toUri().toString())


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs(spark, src)
    jvm = spark.sparkContext._jvm
    return bool(fs.rename(p, jvm.org.apache.hadoop.fs.Path(dst)))


def replace_empty(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename a folder to one that is absent or empty; False if it has entries."""
    fs, p = _fs(spark, dst)
    if fs.exists(p):
        if len(fs.listStatus(p)):
            return False
        fs.delete(p, False)
    mkdirs(spark, p.getParent().toString())
    if not rename(spark, src, dst):
        raise OSError(f"could not move {src} to {dst}")
    return True


def rename_all(spark: SparkSession, moves: list[tuple[str, str]], threads: int = 8) -> None:
    """Rename many files of one file system; raises if one can't be moved."""
    if not moves:
        return
    fs, _ = _fs(spark, moves[0][1])
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # looked up once: each lookup is some calls

    def move(pair: tuple[str, str]) -> None:
        if not fs.rename(path(pair[0]), path(pair[1])):
            raise OSError(f"could not move {pair[0]} to {pair[1]}")

    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(move, moves))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole under a name that must be new; False if it exists."""
    fs, p = _fs(spark, path)
    part = p.suffix(f".{uuid.uuid4().hex}.tmp")
    fs.mkdirs(p.getParent())
    out = fs.create(part, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.exists(p) and fs.rename(part, p):
        return True
    fs.delete(part, False)
    return False
