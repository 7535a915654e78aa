"""Numbered manifests of a table, each put in place by one rename, and changes that survive crashes.

A manifest is a small JSON file under ``_manifests``; the one with the highest number holds. It is
written beside its final name and renamed, so readers see a whole one or none.

A day table (``tables.write_days``) needs a manifest only while folders of it are exchanged:

1. the new folders are written under ``_staged``, which readers pass over;
2. a manifest names the folders that go and those that come: from this rename on, and not before,
   the table is the new one for readers that look at the manifest (:func:`view`);
3. old folders are deleted and new ones moved to their places; each step can be done again;
4. a manifest without changes follows.

A crash in step 1 leaves the old table and rubbish under ``_staged``; one in step 3 leaves the new
table, and whoever changes the table next finishes the steps first (:func:`settle`). One change of
a table may run at a time; streams may append meanwhile.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from bedside_spark.sinks import files

FOLDER, STAGED = "_manifests", "_staged"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    if not files.exists(spark, f"{root}/{FOLDER}"):
        return []
    names = files.names(spark, f"{root}/{FOLDER}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _path(root: str, number: int) -> str:
    return f"{root}/{FOLDER}/{number:012d}.json"


def newest(spark: SparkSession, root: str, below: int | None = None) -> tuple[int, dict]:
    """(number, content) of the newest manifest, or of the newest one under ``below``; (-1, {})."""
    numbers = [n for n in _numbers(spark, root) if below is None or n < below]
    if not numbers:
        return -1, {}
    return numbers[-1], json.loads(files.read_text(spark, _path(root, numbers[-1])))


def put(spark: SparkSession, root: str, number: int, content: dict, keep: int = 3) -> None:
    """Make ``content`` manifest ``number``; older ones but the last few are removed."""
    pending = f"{root}/{FOLDER}/.{uuid.uuid4().hex}.tmp"
    files.write_text(spark, pending, json.dumps(content))
    files.delete(spark, _path(root, number))
    files.move(spark, pending, _path(root, number))
    for old in [n for n in _numbers(spark, root) if n < number][: -keep or None]:
        files.delete(spark, _path(root, old))


# ---- exchange of folders ------------------------------------------------------------------


def stage(root: str) -> str:
    """A new hidden folder for what is to come into the table."""
    return f"{root}/{STAGED}/{uuid.uuid4().hex}"


def exchange(spark: SparkSession, root: str, old: list[str], new: dict[str, str]) -> None:
    """Replace folders ``old`` of the table by ``new`` (final name to staged folder), as one change.

    Names are relative to the table; an old one may be a whole day. Staged folders keep the
    folder names of the table behind their own.
    """
    number, pending = newest(spark, root)
    if pending.get("old") or pending.get("new"):
        raise RuntimeError(f"an earlier change of {root} is not settled")
    put(spark, root, number + 1, {"old": old, "new": new})
    settle(spark, root)


def settle(spark: SparkSession, root: str) -> None:
    """Finish the change that the newest manifest names, and remove what no manifest names."""
    number, pending = newest(spark, root)
    if pending.get("old") or pending.get("new"):
        for name in pending["old"]:
            files.delete(spark, f"{root}/{name}")
        for name, staged in pending["new"].items():
            if files.exists(spark, staged):
                files.move(spark, staged, f"{root}/{name}")
        put(spark, root, number + 1, {"old": [], "new": {}})
    files.delete(spark, f"{root}/{STAGED}")


def view(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """The table with its folder columns, whole at every moment of a change."""
    reader = spark.read.schema(schema) if schema else spark.read
    _, pending = newest(spark, root)
    if not (pending.get("old") or pending.get("new")):
        return reader.parquet(root)
    gone, come = set(pending["old"]), pending["new"]
    parts = []
    for day in files.folders(spark, root):
        if day in gone or day.startswith(("_", ".")):
            continue
        own = [f"{day}/{n}" for n in files.folders(spark, f"{root}/{day}")]
        parts += [n for n in own if n not in gone and n not in come]
    frames = []
    # Folders that have moved are read at their places, the others where they were staged.
    waiting = {n: s for n, s in come.items() if files.exists(spark, s)}
    parts += [n for n in come if n not in waiting]
    if parts:
        frames.append(reader.option("basePath", root).parquet(*[f"{root}/{n}" for n in parts]))
    for base in sorted({s[: -len(n) - 1] for n, s in waiting.items()}):
        own = [s for n, s in waiting.items() if s == f"{base}/{n}"]
        frames.append(reader.option("basePath", base).parquet(*own))
    if not frames:
        return reader.parquet(root).limit(0)
    table = frames[0]
    for frame in frames[1:]:
        table = table.unionByName(frame)
    return table
