"""Replacing a table or report as a whole.

What is written goes to a folder beside the target. Only when all of its tasks
are done does it take the target's place, by renaming, so that a failed job
leaves the old table as it was, and a job may read the table that it replaces.
The old folder is renamed first and deleted last. If a program dies between the
two renames, the next one that looks at the target finds the finished folder by
its mark and completes the step, or else puts the old one back.

A frame that was read from the target before it was replaced can't be computed
any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

#: Names of a folder that is being written, and of one that was replaced, follow the target's.
NEW, OLD = ".new-", ".old-"

#: The file that Spark leaves in a folder whose tasks are all done.
DONE = "_SUCCESS"


def _path(spark: SparkSession, path: str) -> Any:
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str) -> Any:
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_path(spark, path))


def _beside(spark: SparkSession, path: str, mark: str) -> list[str]:
    """Folders beside ``path`` that carry its name and ``mark``, by age, oldest first."""
    target = _path(spark, path)
    files = _files(spark, path)
    if target.getParent() is None or not files.exists(target.getParent()):
        return []
    found = [s for s in files.listStatus(target.getParent()) if s.getPath().getName().startswith(target.getName() + mark)]
    return [s.getPath().toString() for s in sorted(found, key=lambda s: s.getModificationTime())]


def _rename(spark: SparkSession, source: str, target: str) -> None:
    if not _files(spark, target).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"{source} could not take the place of {target}")


def _delete(spark: SparkSession, path: str) -> None:
    _files(spark, path).delete(_path(spark, path), True)


def restore(spark: SparkSession, path: str) -> None:
    """Complete or undo the replacement of ``path`` that a program died in, if one did."""
    path = path.rstrip("/")
    if exists(spark, path):
        return
    old = _beside(spark, path, OLD)
    if not old:
        return
    done = [folder for folder in _beside(spark, path, NEW) if exists(spark, f"{folder}/{DONE}")]
    _rename(spark, (done or old)[-1], path)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """What ``write`` writes to the path it is given, in place of ``path``; returns ``path``.

    One program at a time may replace a path.
    """
    target = path.rstrip("/")
    restore(spark, target)
    mark = uuid.uuid4().hex
    new, old = f"{target}{NEW}{mark}", f"{target}{OLD}{mark}"
    try:
        write(new)
    except BaseException:
        _delete(spark, new)
        raise
    if exists(spark, target):
        _rename(spark, target, old)
    try:
        _rename(spark, new, target)
    except BaseException:
        restore(spark, target)
        raise
    for left in [*_beside(spark, target, OLD), *_beside(spark, target, NEW)]:
        _delete(spark, left)
    return path


def replace_file(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """The one file that ``write`` leaves in the folder it is given, in place of the file ``path``."""
    folder = f"{path}{NEW}{uuid.uuid4().hex}"
    try:
        write(folder)
        (part,) = [s.getPath().toString() for s in _files(spark, folder).listStatus(_path(spark, folder)) if s.getPath().getName().startswith("part-")]
        if exists(spark, path):
            _delete(spark, path)
        _rename(spark, part, path)
    finally:
        _delete(spark, folder)
    return path
