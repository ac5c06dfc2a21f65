"""The few file-system calls that DataFrame readers and writers do not offer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _system(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def _children(spark: SparkSession, path: str) -> list:
    return list(_system(spark, path).listStatus(_path(spark, path)))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    return [s.getPath().getName() for s in _children(spark, path) if s.isDirectory()]


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Files of a folder that are not markers and not empty."""
    files = [s for s in _children(spark, path) if s.isFile() and s.getLen() > 0]
    names = [s.getPath().getName() for s in files]
    return [n for n in names if not n.startswith(("_", "."))]


def file_stamps(spark: SparkSession, path: str, suffix: str) -> list[tuple[str, int, int]]:
    """Name, time of the last change in ms and length of the files of a folder, empty ones too."""
    files = [s for s in _children(spark, path) if s.isFile()]
    found = [(s.getPath().getName(), s.getModificationTime(), s.getLen()) for s in files]
    return [f for f in found if f[0].endswith(suffix) and not f[0].startswith(("_", "."))]


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a UTF-8 file without its byte order mark; None for an empty file."""
    jvm = spark._jvm
    stream = _system(spark, path).open(_path(spark, path))
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
    finally:
        stream.close()
    return None if line is None else line.removeprefix("\ufeff")


def make_folder(spark: SparkSession, path: str) -> None:
    _system(spark, path).mkdirs(_path(spark, path))


def move(spark: SparkSession, source: str, target: str) -> None:
    system = _system(spark, target)
    system.mkdirs(_path(spark, target).getParent())
    if not system.rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)
