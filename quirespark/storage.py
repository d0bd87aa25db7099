"""Files of a store on any file system: the driver goes through Hadoop's, tasks through Arrow's."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists where the session's paths point to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at))


def version(spark: SparkSession, path: str) -> str | None:
    """Hash of path, length and modification time of all files below ``path``; None where there are none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(at):
        return None
    seen, files = [], system.listFiles(at, True)
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath().toString()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest() if seen else None


def system(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a folder that all tasks share: a URI, or a path of a mounted disk."""
    return arrow_fs.FileSystem.from_uri(folder) if "://" in folder else (arrow_fs.LocalFileSystem(), os.path.abspath(folder))


def walk(folder: str) -> Iterator[tuple[str, str]]:
    """(relative path, full path) of the files below a folder, sorted; nothing where it does not exist."""
    files, base = system(folder)
    found = files.get_file_info(arrow_fs.FileSelector(base, recursive=True, allow_not_found=True))
    for path in sorted(f.path for f in found if f.is_file):
        yield os.path.relpath(path, base), path
