"""Folders and small files of a shared file system, through Hadoop's FileSystem."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    jvm = spark._jvm  # Hadoop FileSystem API through the gateway
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` (none if it is missing)."""
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, put in the place of an older one in one step."""
    fs, p = file_system(spark, f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    target = file_system(spark, path)[1]
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files.rename(p, target, options)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path`` (none if it is missing)."""
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile()) if fs.exists(p) else []
