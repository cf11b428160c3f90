"""Snapshots: folders of rows that become visible together.

Writers put rows into new folders that nobody reads yet. A snapshot is one small file,
``<root>/_snapshots/<version>.json``, that lists the folders of every name; it is written aside and
renamed to the next version. The rename never replaces a file, so of two writers that start from
the same version one fails with ``SnapshotConflict`` and starts over from what the other made
visible. Readers take the highest version: they see all of a commit or nothing of it, and a writer
that stops half-way leaves folders that no snapshot lists.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Stored copies are written once and read column by column; smaller files than by the default codec.
CODEC = "zstd"
#: Attempts of a writer that meets other writers.
ATTEMPTS = 20
Folders = dict[str, list[str]]


class SnapshotConflict(RuntimeError):
    """Another writer has taken the version."""


def _folder(spark: SparkSession, root: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/_snapshots")
    return jvm, path, path.getFileSystem(conf)


def latest(spark: SparkSession, root: str) -> tuple[int, Folders]:
    """(version, folders by name); version 0 without folders where nothing was committed."""
    jvm, path, fs = _folder(spark, root)
    if not fs.exists(path):
        return 0, {}
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    version = max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)
    if not version:
        return 0, {}
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(path, f"{version:010d}.json"))
    try:
        return version, json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, version: int, folders: Folders) -> None:
    """Make ``folders`` the snapshot ``version``."""
    jvm, path, fs = _folder(spark, root)
    aside = jvm.org.apache.hadoop.fs.Path(path, f".{uuid.uuid4().hex}.tmp")
    target = jvm.org.apache.hadoop.fs.Path(path, f"{version:010d}.json")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(folders).encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # without OVERWRITE
    try:
        files.rename(aside, target, plain)
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if fs.exists(target):
            raise SnapshotConflict(f"version {version} of {root} is taken") from e
        raise


def update(spark: SparkSession, root: str, change: Callable[[Folders], Folders], attempts: int = ATTEMPTS) -> Folders:
    """Commit ``change(folders)`` on the latest snapshot; ``change`` runs again on what other
    writers made visible meanwhile. Returns the committed folders; none are committed if
    nothing changes."""
    for last in range(attempts - 1, -1, -1):
        version, folders = latest(spark, root)
        new = change({k: list(v) for k, v in folders.items()})
        if new == folders:
            return folders
        try:
            commit(spark, root, version + 1, new)
            return new
        except SnapshotConflict:
            if not last:
                raise
    raise ValueError("attempts must be positive")
