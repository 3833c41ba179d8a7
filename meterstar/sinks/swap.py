"""Replacing a table by renaming folders, so that a run that dies loses nothing.

A table's new rows are written to `<name>_next`, whose `_SUCCESS` file says that they are all
there. The swap is two renames: the table to `<name>_old`, the new folder to the table's name;
the old folder goes last. What a dead run left is told by which of the three folders exist:

| table | next, complete | old | the run died | recovery |
|---|---|---|---|---|
| yes | any or none | no | while writing | the new folder goes |
| yes | no | yes | before the old folder went | the old folder goes |
| no | yes | any or none | between the renames | the new folder takes the name |
| no | no | yes | between them, and the new one is lost | the old one takes its name back |
"""

from __future__ import annotations

from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

COMPLETE = "_SUCCESS"
NEXT, OLD = "_next", "_old"


class SwapError(RuntimeError):
    """The file system refused a rename or a removal."""


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    files, path = _files(spark, folder)
    return files.exists(path(folder))


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder if it is there; fail if it stays."""
    files, path = _files(spark, folder)
    if files.exists(path(folder)) and not files.delete(path(folder), True):
        raise SwapError(f"cannot delete {folder}")


def rename_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a name that is free.

    File systems answer false instead of failing, or move the folder into one that has the
    name already; neither may pass for success.
    """
    files, path = _files(spark, source)
    if files.exists(path(target)):
        raise SwapError(f"cannot rename {source}: {target} is there")
    try:
        renamed = files.rename(path(source), path(target))
    except Py4JJavaError as error:
        raise SwapError(f"cannot rename {source} to {target}") from error
    if not renamed:
        raise SwapError(f"cannot rename {source} to {target}")


def recover_table(spark: SparkSession, table: str) -> None:
    """Finish, or take back, what a dead swap of the folder `table` left; else do nothing."""
    fresh, old = table + NEXT, table + OLD
    if exists(spark, table):
        remove_folder(spark, fresh)
    elif exists(spark, f"{fresh}/{COMPLETE}"):
        rename_folder(spark, fresh, table)
    elif exists(spark, old):
        rename_folder(spark, old, table)
        remove_folder(spark, fresh)
    if exists(spark, table):
        remove_folder(spark, old)


def swap_in(spark: SparkSession, table: str) -> None:
    """Give the complete folder `<table>_next` the table's name; the table's folder goes."""
    fresh, old = table + NEXT, table + OLD
    if not exists(spark, f"{fresh}/{COMPLETE}"):
        raise SwapError(f"{fresh} is not complete")
    if exists(spark, table):
        remove_folder(spark, old)
        rename_folder(spark, table, old)
    rename_folder(spark, fresh, table)
    remove_folder(spark, old)


# Partitions of a table wait in a folder of their own, outside of what readers list.
PARTS, PARTS_OLD = "_parts", "_parts_old"


def _leaves(spark: SparkSession, folder: str, below: str = "") -> Iterator[str]:
    """The partition folders under `folder` that hold files, as relative paths."""
    files, path = _files(spark, folder)
    some = False
    for status in files.listStatus(path(f"{folder}/{below}" if below else folder)):
        name = status.getPath().getName()
        if status.isDirectory() and "=" in name:
            yield from _leaves(spark, folder, f"{below}/{name}" if below else name)
        elif not name.startswith(("_", ".")):
            some = True
    if some and below:
        yield below


def swap_parts(spark: SparkSession, table: str) -> list[str]:
    """Let the complete partitions in `<table>_parts` replace those of the table; their names.

    Each partition is swapped by two renames. After a run that died on the way, the partitions
    still waiting are those not yet swapped, and the same call goes on with them.
    """
    fresh, old = table + PARTS, table + PARTS_OLD
    if not exists(spark, f"{fresh}/{COMPLETE}"):
        raise SwapError(f"{fresh} is not complete")
    swapped = list(_leaves(spark, fresh))
    for part in swapped:
        if exists(spark, f"{table}/{part}"):
            remove_folder(spark, f"{old}/{part}")
            _make_parent(spark, f"{old}/{part}")
            rename_folder(spark, f"{table}/{part}", f"{old}/{part}")
        _make_parent(spark, f"{table}/{part}")
        rename_folder(spark, f"{fresh}/{part}", f"{table}/{part}")
    remove_folder(spark, fresh)
    remove_folder(spark, old)
    return swapped


def recover_parts(spark: SparkSession, table: str) -> None:
    """Finish a dead `swap_parts`; partitions that were not written to the end go."""
    if exists(spark, f"{table}{PARTS}/{COMPLETE}"):
        swap_parts(spark, table)
    else:
        remove_folder(spark, table + PARTS)
        remove_folder(spark, table + PARTS_OLD)


def _make_parent(spark: SparkSession, folder: str) -> None:
    files, path = _files(spark, folder)
    files.mkdirs(path(folder).getParent())
