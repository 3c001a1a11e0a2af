"""Putting finished folders in place, on the file system that Spark itself uses.

A table is written to a hidden folder beside its place and moved there when it is
whole, so no reader and no crash sees a table that is part old and part new. What it
replaces is kept under a hidden name until the new one is in place; ``restore`` puts
it back if a run ended between the two. A name that holds ``=`` is never hidden from Spark, so
hidden names of date folders are written without it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _parts(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, name


_REPLACED, _EQUALS = "_replaced-", "%3D"


def staging_path(path: str) -> str:
    """A new hidden folder beside the path."""
    parent, name = _parts(path)
    return f"{parent}/_staged-{name.replace('=', _EQUALS)}-{uuid.uuid4().hex}"


def _replaced_path(path: str) -> str:
    parent, name = _parts(path)
    return f"{parent}/{_REPLACED}{name.replace('=', _EQUALS)}"


def exists(spark: SparkSession, path: str) -> bool:
    files, place = at(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = at(spark, path)
    files.delete(place, True)


def restore(spark: SparkSession, path: str) -> None:
    """Puts back what a run that ended midway had moved out of the way."""
    files, place = at(spark, path)
    old = at(spark, _replaced_path(path))[1]
    if files.exists(old):
        if files.exists(place):
            files.delete(old, True)
        elif not files.rename(old, place):
            raise OSError(f"could not move {old} to {path}")


def restore_all(spark: SparkSession, folder: str) -> None:
    """Puts back whatever runs that ended midway had moved out of the way in a folder."""
    files, place = at(spark, folder)
    if files.exists(place):
        for status in files.listStatus(place):
            name = status.getPath().getName()
            if name.startswith(_REPLACED):
                restore(spark, f"{folder.rstrip('/')}/{name.removeprefix(_REPLACED).replace(_EQUALS, '=')}")


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Moves a finished folder to the path, in place of what is there."""
    restore(spark, path)
    files, place = at(spark, path)
    old, new = at(spark, _replaced_path(path))[1], at(spark, staged)[1]
    if files.exists(place):
        if not files.rename(place, old):
            raise OSError(f"could not move {path}")
    else:
        files.mkdirs(place.getParent())
    if not files.rename(new, place):
        raise OSError(f"could not move {staged} to {path}")
    files.delete(old, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder that is not hidden; none if there is no folder."""
    files, place = at(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.getPath().getName()[0] not in "._")
