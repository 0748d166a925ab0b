"""Files of a storage folder: their names, times and sizes, and moving them. Contents are left to Spark's readers."""

from __future__ import annotations

from hashlib import sha256
from typing import NamedTuple
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Source(NamedTuple):
    """One version of a file: its path below the listed folder, when it was written (ms) and its length."""

    path: str
    modified: int
    length: int


def _system(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(place)


def folder_prefix(spark: SparkSession, root: str) -> str:
    """What the paths of all files below `root` begin with, scheme aside."""
    return _system(spark, root)[1].toUri().getPath().rstrip("/") + "/"


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _system(spark, path)
    return system.exists(place)


def list_sources(spark: SparkSession, root: str, suffix: str = ".csv") -> list[Source]:
    """Every file below `root` that ends in `suffix` in any letter case, empty and nested ones too; hidden
    files (a leading dot or underscore in any part) are not data. In the order of arrival."""
    system, place = _system(spark, root)
    if not system.exists(place):
        return []
    found, names = [], system.listFiles(place, True)
    prefix = folder_prefix(spark, root)
    while names.hasNext():
        status = names.next()
        path = status.getPath().toUri().getPath().removeprefix(prefix)
        if path.lower().endswith(suffix) and not any(part[0] in "._" for part in path.split("/")):
            found.append(Source(path, status.getModificationTime(), status.getLen()))
    return sorted(found, key=lambda source: (source.modified, source.path))


def is_unchanged(spark: SparkSession, root: str, source: Source) -> bool:
    system, place = _system(spark, f"{root}/{source.path}")
    if not system.exists(place):
        return False
    status = system.getFileStatus(place)
    return (status.getModificationTime(), status.getLen()) == (source.modified, source.length)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename within one store; an earlier file of the target's name is replaced."""
    system, place = _system(spark, path)
    _, goal = _system(spark, target)
    system.mkdirs(goal.getParent())
    if system.exists(goal):
        system.delete(goal, True)
    if not system.rename(place, goal):
        raise OSError(f"{path} could not be moved to {target}")


def delete(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.delete(place, True)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, nothing for an empty one."""
    system, place = _system(spark, path)
    jvm = spark._jvm
    stream = system.open(place)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def fingerprint(spark: SparkSession, path: str) -> str | None:
    """A digest of the names, times and lengths of a file or of all files below a folder; nothing where there is none."""
    system, place = _system(spark, path)
    if not system.exists(place):
        return None
    found, listed = [], system.listFiles(place, True)
    while listed.hasNext():
        status = listed.next()
        found.append(f"{status.getPath()} {status.getModificationTime()} {status.getLen()}")
    return sha256("\n".join(sorted(found)).encode()).hexdigest()


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies directly in a folder; nothing where there is none."""
    system, place = _system(spark, folder)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of names and numbers."""
    system, place = _system(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.hadoop.shaded.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all; false where its name is taken. The name appears by a rename that
    replaces nothing, so a reader never sees a part and of two writers one wins."""
    jvm = spark._jvm
    system, place = _system(spark, path)
    if system.exists(place):
        return False
    waiting = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid4().hex}.tmp")
    stream = system.create(waiting, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(waiting, place, plain)
    except Py4JJavaError as error:
        system.delete(waiting, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True
