"""Tables whose parts are replaced together: a list of folders, swapped last.

A table is a folder with data folders and numbered lists. A list names the data
folder of every part; the highest number counts. Writers put new data into folders
of their own, then publish a list that names them. A writer that dies before that
leaves the table as it was, and a reader keeps the list it opened.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LISTS, DATA, PART = "lists", "data", "part"


class Conflict(RuntimeError):
    """Another writer has published first."""


@dataclass(frozen=True)
class Snapshot:
    """A published list: its number, the folder of each part and notes of the writer."""

    number: int = 0
    parts: Mapping[str, str] = field(default_factory=dict)
    notes: Mapping[str, str] = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), found


def names_in(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with the time of their last change; none without a folder."""
    files, found = _files(spark, path)
    if not files.exists(found):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(found)}


def new_folder(path: str) -> str:
    """Name of a data folder, relative to the table, that no other writer uses."""
    return f"{DATA}/{uuid.uuid4().hex}"


def current(spark: SparkSession, path: str) -> Snapshot:
    """The newest published list; an empty one where nothing is published yet."""
    numbers = [int(name) for name in names_in(spark, f"{path}/{LISTS}") if name.isdigit()]
    if not numbers:
        return Snapshot()
    rows = spark.read.schema("kind string, name string, value string").json(
        f"{path}/{LISTS}/{max(numbers):012d}"
    )
    listed = rows.collect()
    return Snapshot(
        max(numbers),
        {row["name"]: row["value"] for row in listed if row["kind"] == PART},
        {row["name"]: row["value"] for row in listed if row["kind"] != PART},
    )


def publish(
    spark: SparkSession, path: str, base: Snapshot, parts: Mapping[str, str], notes: Mapping[str, str]
) -> Snapshot:
    """Make ``parts`` the table, if ``base`` still is its newest list.

    The list is written beside the others and renamed into place, which takes
    effect as a whole or not at all. ``Conflict`` if another writer was faster.
    """
    rows = [(PART, name, value) for name, value in sorted(parts.items())]
    rows += [("note", name, value) for name, value in sorted(notes.items())]
    draft = f"{path}/{LISTS}/_draft-{uuid.uuid4().hex}"
    frame = spark.createDataFrame(rows, "kind string, name string, value string")
    frame.coalesce(1).write.json(draft)
    files, source = _files(spark, draft)
    _, target = _files(spark, f"{path}/{LISTS}/{base.number + 1:012d}")
    if files.exists(target) or not files.rename(source, target):
        files.delete(source, True)
        raise Conflict(f"{path} has changed since list {base.number}")
    return Snapshot(base.number + 1, dict(parts), dict(notes))


def read_parts(spark: SparkSession, path: str, schema: StructType | str, folders: list[str]) -> DataFrame:
    """The rows of some data folders."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{folder}" for folder in folders])


def drop_unlisted(spark: SparkSession, path: str, older_than_ms: int, keep: int = 1) -> list[str]:
    """Delete data that none of the newest ``keep`` lists names, and older lists.

    ``older_than_ms`` is a moment in milliseconds: what changed after it stays, as a
    writer may not have published it yet or a reader may still be at it. Returns the
    names of the deleted data folders.
    """
    files, _ = _files(spark, path)
    folder = spark._jvm.org.apache.hadoop.fs.Path
    lists = sorted((n, t) for n, t in names_in(spark, f"{path}/{LISTS}").items() if n.isdigit())
    old = [name for name, changed in lists[: len(lists) - keep] if changed < older_than_ms]
    # Lists go first: a list is never left without its data.
    for name in old:
        files.delete(folder(f"{path}/{LISTS}/{name}"), True)
    listed = [f"{path}/{LISTS}/{name}" for name, _ in lists if name not in old]
    named = set()
    if listed:
        rows = spark.read.json(listed, "kind string, value string").filter(F.col("kind") == PART)
        named = {row["value"].split("/")[1] for row in rows.collect()}
    dropped = []
    for name, changed in sorted(names_in(spark, f"{path}/{DATA}").items()):
        if name not in named and changed < older_than_ms:
            files.delete(folder(f"{path}/{DATA}/{name}"), True)
            dropped.append(name)
    return dropped
