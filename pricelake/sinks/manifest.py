"""Versions of a stored table that is kept in parts: small manifests, written once each, say which folders are the table.

A writer puts its files into a folder of its own and then creates the next manifest, which fails if another writer was faster. So a reader sees the
old table or the new one, a writer that dies leaves nothing that is read, and two writers never mix.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_manifests"


class Conflict(RuntimeError):
    """Another writer has changed the table since it was read."""


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and a function that makes paths below it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), lambda *parts: hadoop.Path("/".join((path, *parts)))


def new_folder(number: int) -> str:
    """A folder for the files of manifest `number`, which no other writer has."""
    return f"version={number:09d}-{uuid.uuid4().hex[:12]}"


def number_of(folder: str) -> int:
    return int(folder.split("=")[1].split("-")[0])


def _names(fs, folder) -> list[str]:
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def _read(spark: SparkSession, fs, path) -> dict | None:
    """None for a manifest whose writer died while it wrote."""
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except json.JSONDecodeError:
        return None
    finally:
        stream.close()


def manifests(spark: SparkSession, root: str, most: int = 1) -> list[tuple[int, dict]]:
    """The newest complete manifests with their numbers, newest first."""
    fs, at = file_system(spark, root)
    out = []
    for name in sorted((n for n in _names(fs, at(FOLDER)) if n.endswith(".json") and not n.startswith(".")), reverse=True):
        content = _read(spark, fs, at(FOLDER, name))
        if content is not None:
            out.append((int(name.split(".")[0]), content))
        if len(out) == most:
            break
    return out


def latest(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """(number the next manifest must have, newest complete manifest or None)."""
    fs, at = file_system(spark, root)
    numbers = [int(n.split(".")[0]) for n in _names(fs, at(FOLDER)) if n.endswith(".json") and not n.startswith(".")]
    found = manifests(spark, root)
    return max(numbers, default=0) + 1, found[0][1] if found else None


def commit(spark: SparkSession, root: str, number: int, content: dict) -> None:
    """Make `content` the table. `content["parts"]` maps the name of a part to its folders below `root`."""
    fs, at = file_system(spark, root)
    fs.mkdirs(at(FOLDER))
    try:
        stream = fs.create(at(FOLDER, f"{number:09d}.json"), False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise Conflict(f"{root} has changed: manifest {number} exists") from None
        raise
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()


def folders(content: dict) -> set[str]:
    return {f for found in content["parts"].values() for f in found} | set(content.get("gone", ()))


def clean(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the folders that none of the newest `keep` manifests names, and older manifests; returns what was removed.

    Folders of writers at work have numbers beyond the newest manifest and stay.
    """
    fs, at = file_system(spark, root)
    kept = manifests(spark, root, keep)
    if not kept:
        return []
    newest, used = kept[0][0], set().union(*(folders(c) for _, c in kept))
    removed = []
    for version in (n for n in _names(fs, at()) if n.startswith("version=") and number_of(n) <= newest):
        inner = [f"{version}/{n}" for n in _names(fs, at(version)) if "=" in n]
        gone = [n for n in inner if n not in used]
        if version not in used and len(gone) == len(inner):
            gone = [version]
        for folder in gone:
            fs.delete(at(folder), True)
            removed.append(folder)
    for name in _names(fs, at(FOLDER)):
        if name.endswith(".json") and not name.startswith(".") and int(name.split(".")[0]) < kept[-1][0]:
            fs.delete(at(FOLDER, name), False)
    return removed
