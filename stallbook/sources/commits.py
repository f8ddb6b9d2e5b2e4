"""Numbered commits of a table folder: small JSON files, each made only if its number is still free.

A writer notes the last number before it reads, and commits the next one. Of two writers that started from the same
commit one succeeds; the other gets ``Conflict`` and has changed nothing that a reader sees.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import datetime, timedelta, timezone
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_FOLDER = "_commits"


class Conflict(RuntimeError):
    """Another writer has committed since this one began."""


def _files(spark: SparkSession, path: str):
    """Hadoop's file system and path objects, so that every scheme Spark knows works here too."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, files.makeQualified(place)


def listed(spark: SparkSession, path: str) -> list:
    """What lies in a folder, as Hadoop's file statuses; nothing where there is none."""
    files, place = _files(spark, path)
    return list(files.listStatus(place)) if files.exists(place) else []


def _path(root: str, number: int) -> str:
    return f"{root}/{_FOLDER}/{number:012d}.json"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the commits that are there, in order."""
    names = [status.getPath().getName() for status in listed(spark, f"{root}/{_FOLDER}")]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0].isdigit())


def last(spark: SparkSession, root: str) -> int:
    """The number of the last commit, 0 before the first."""
    return max(numbers(spark, root), default=0)


def read(spark: SparkSession, root: str, number: int | None = None) -> dict:
    """What a commit says, the last one unless told otherwise."""
    found = last(spark, root) if number is None else number
    if not found:
        raise RuntimeError(f"nothing is committed under {root}")
    files, place = _files(spark, _path(root, found))
    stream = files.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _renamed_if_absent(spark: SparkSession, source: str, target: str) -> None:
    files, old = _files(spark, source)
    _, new = _files(spark, target)
    if new.toUri().getScheme() == "file":
        # A local rename replaces its target; a link never does.
        paths = spark._jvm.java.nio.file.Paths
        spark._jvm.java.nio.file.Files.createLink(paths.get(new.toUri()), paths.get(old.toUri()))
        files.delete(old, False)
        return
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    option = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    context.rename(old, new, spark.sparkContext._gateway.new_array(option, 0))


def commit(spark: SparkSession, root: str, number: int, content: dict) -> None:
    """Make ``content`` commit ``number``; ``Conflict`` if that number is taken."""
    if last(spark, root) >= number:
        raise Conflict(f"commit {number} of {root} was made by another writer")
    draft = f"{root}/{_FOLDER}/draft-{uuid4().hex}"
    files, place = _files(spark, draft)
    stream = files.create(place)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    try:
        _renamed_if_absent(spark, draft, _path(root, number))
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        raise Conflict(f"commit {number} of {root} was made by another writer") from None
    finally:
        files.delete(place, False)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


def remove_unnamed(spark: SparkSession, root: str, prefix: str, named: Iterable[str], older_than: timedelta) -> list[str]:
    """Delete the folders under ``root`` that begin with ``prefix`` and that no one needs; returns their names.

    Folders younger than ``older_than`` stay, since a writer may be about to commit them.
    """
    needed, gone = set(named), []
    before = (datetime.now(timezone.utc) - older_than).timestamp() * 1000
    for status in listed(spark, root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix) and name not in needed \
                and status.getModificationTime() <= before:
            remove(spark, f"{root}/{name}")
            gone.append(name)
    return sorted(gone)
