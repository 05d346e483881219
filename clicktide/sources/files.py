"""Folders and small files, through the session's Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, location: str):
    """The file system of a location, and the location as its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, location: str) -> bool:
    fs, path = file_system(spark, location)
    return fs.exists(path)


def _children(spark: SparkSession, location: str) -> list:
    fs, path = file_system(spark, location)
    return list(fs.listStatus(path)) if fs.exists(path) else []


def folder_names(spark: SparkSession, location: str) -> list[str]:
    return [s.getPath().getName() for s in _children(spark, location) if s.isDirectory()]


def file_names(spark: SparkSession, location: str) -> list[str]:
    return [s.getPath().getName() for s in _children(spark, location) if s.isFile()]


def data_files(spark: SparkSession, location: str) -> dict[str, int]:
    """The files of a folder that hold data, with their bytes."""
    files = {s.getPath().getName(): s.getLen() for s in _children(spark, location) if s.isFile()}
    return {name: size for name, size in files.items() if name[0] not in "_."}


def make_folder(spark: SparkSession, location: str) -> None:
    fs, path = file_system(spark, location)
    fs.mkdirs(path)


def put_text(spark: SparkSession, location: str, text: str) -> None:
    """Write a small file; it must not exist."""
    fs, path = file_system(spark, location)
    out = fs.create(path, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, location: str) -> str:
    """A small file's text."""
    fs, path = file_system(spark, location)
    stream = fs.open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def renamed_once(spark: SparkSession, draft: str, location: str) -> None:
    """Give a finished file its name; ``FileExistsError`` if that is taken."""
    fs, target = file_system(spark, location)
    if fs.exists(target) or not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(draft), target):
        raise FileExistsError(location)


def remove(spark: SparkSession, location: str) -> None:
    fs, path = file_system(spark, location)
    fs.delete(path, True)
