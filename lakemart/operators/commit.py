"""Commits of several partitions that a crash can't leave half done.

A table is a folder of parquet files, partitioned or not, with its state beside them: the
declared schema and the greatest load time of each partition, in ``_state-<n>.json`` (the highest
``n`` counts; a state is never overwritten).  So a table may have no row yet, and its watermark is known
without reading it.

A commit replaces whole partitions (of an unpartitioned table: all its files):

1. the new partitions are written by a Spark job below ``_commit/next``;
2. ``_commit/intent.json`` is put in place by a rename: what to replace, what to remove, the new
   state.  This is the commit: before it nothing has changed, after it the rest is bound to follow;
3. the old partitions go and the new ones are renamed into their places;
4. the new state is written and the intent removed.

Every step of 3 and 4 can be repeated, so :func:`recover`, which every writer calls first, replays an
intent that it finds and discards written partitions without one.  There is one writer at a time, and the
file system renames folders (as Spark's own commit of a dynamic partition overwrite requires too).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from lakemart.session import shuffles_freed

_WORK = "_commit"
_STATE = re.compile(r"_state-(\d{9})\.json")


class Folder:
    """Driver-side calls on the file system of a path: small files, listings and renames."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._jvm, self._path = jvm, jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def uri(self, name: str) -> str:
        """As ``_metadata.file_path`` names it."""
        return self._fs.makeQualified(self.at(name)).toUri().toString()

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self.at(name))

    def list(self, name: str = "") -> list[tuple[str, bool]]:
        """(name, whether it is a folder) of what lies in a folder; nothing if there is none."""
        if not self.exists(name):
            return []
        return sorted((s.getPath().getName(), s.isDirectory()) for s in self._fs.listStatus(self.at(name)))

    def delete(self, name: str) -> None:
        self._fs.delete(self.at(name), True)

    def make(self, name: str) -> None:
        self._fs.mkdirs(self.at(name))

    def rename(self, old: str, new: str) -> None:
        parent = self.at(new).getParent()
        self._fs.mkdirs(parent)
        if not self._fs.rename(self.at(old), self.at(new)):
            raise OSError(f"can't rename {self.at(old)} to {self.at(new)}")

    def write_json(self, name: str, value) -> None:
        """Written under another name first: a reader finds the whole file or none."""
        draft = f"{os.path.dirname(name)}/.{os.path.basename(name)}".lstrip("/") + ".draft"
        out = self._fs.create(self.at(draft), True)
        try:
            out.write(bytearray(json.dumps(value), "utf-8"))
        finally:
            out.close()
        if self.exists(name):
            self.delete(name)
        self.rename(draft, name)

    def read_json(self, name: str):
        if not self.exists(name):
            return None
        read = self._fs.open(self.at(name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(read, "UTF-8"))
        finally:
            read.close()


@dataclass
class State:
    """What a table declares beside its files."""

    schema: StructType
    #: partition folder (empty: the whole table) -> greatest value of ``order_col`` there, as text
    marks: dict[str, str] = field(default_factory=dict)
    order_col: str | None = None
    number: int = 0

    def dump(self) -> dict:
        return {"schema": self.schema.jsonValue(), "marks": self.marks, "order_col": self.order_col}

    @classmethod
    def load(cls, value: dict, number: int) -> "State":
        return cls(StructType.fromJson(value["schema"]), value["marks"], value["order_col"], number)

    def watermark(self):
        """The greatest ``order_col`` of the table, None for a table without rows."""
        if not self.marks:
            return None
        kind = self.schema[self.order_col].dataType
        parse = {DateType: dt.date.fromisoformat, TimestampType: dt.datetime.fromisoformat,
                 TimestampNTZType: dt.datetime.fromisoformat}.get(type(kind), json.loads)
        return max(map(parse, self.marks.values()))


def _text(v) -> str:
    return v.isoformat() if isinstance(v, dt.date) else json.dumps(v)


def read_state(spark: SparkSession, path: str) -> State | None:
    """The table's state, or None if no table is there."""
    folder = Folder(spark, path)
    numbers = [int(m[1]) for name, _ in folder.list() if (m := _STATE.fullmatch(name))]
    if not numbers:  # a table of an earlier release declares its schema alone
        old = folder.read_json("_schema.json")
        return None if old is None else State(StructType.fromJson(old))
    return State.load(folder.read_json(f"_state-{max(numbers):09d}.json"), max(numbers))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is at ``path``: a state, or the files of a release that kept none."""
    return read_state(spark, path) is not None or any(
        name[0] not in "_." for name, _ in Folder(spark, path).list())


def _put_state(folder: Folder, state: dict, number: int) -> None:
    name = f"_state-{number:09d}.json"
    if not folder.exists(name):
        folder.write_json(name, state)
    for other, _ in folder.list():
        if (m := _STATE.fullmatch(other)) and int(m[1]) < number:
            folder.delete(other)


def declare(spark: SparkSession, path: str, state: State) -> None:
    """A new state without a change of rows: also how a table without rows comes into being."""
    now = read_state(spark, path)
    _put_state(Folder(spark, path), state.dump(), now.number + 1 if now else 1)


def _apply(folder: Folder, intent: dict, after_step: Callable[[str], None]) -> None:
    new = set(intent["replace"])
    for name in intent["remove"]:
        if name not in new:
            folder.delete(name)
            after_step("removed")
    for name in intent["replace"]:
        if folder.exists(f"{_WORK}/next/{name}"):  # else a run before this one has put it there
            folder.delete(name)
            after_step("cleared")
            folder.rename(f"{_WORK}/next/{name}", name)
            after_step("replaced")
    _put_state(folder, intent["state"], intent["number"])
    after_step("declared")
    folder.delete(f"{_WORK}/intent.json")
    folder.delete(_WORK)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish the commit that a crash interrupted, or discard one that hadn't begun; whether there was one."""
    folder = Folder(spark, path)
    if not folder.exists(_WORK):
        return False
    intent = folder.read_json(f"{_WORK}/intent.json")
    if intent is None:
        folder.delete(_WORK)
        return False
    _apply(folder, intent, lambda step: None)
    return True


def units(folder: Folder, root: str, depth: int) -> list[str]:
    """Partition folders ``depth`` levels below ``root``; the data files of an unpartitioned table."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{n}".lstrip("/") for f in found for n, is_folder in
                 folder.list(f"{root}/{f}".strip("/")) if is_folder and "=" in n]
    if depth:
        return found
    return [n for n, is_folder in folder.list(root) if not is_folder and n[0] not in "_."]


def folders_of(file_path: str, depth: int) -> Column:
    """The last ``depth`` folders of a file's path, "" for none.  It is computed for every row, and so
    takes time in proportion to the path (a pattern tied to the path's end is tried from each character)."""
    tail = F.substring_index(file_path, "/", -(depth + 1))
    return F.substring_index(tail, "/", depth) if depth else F.lit("")


def partition_names(df: DataFrame, partition_cols: Sequence[str]) -> list[str]:
    """Folders, below the table's, of the partitions that ``df``, read from it, has rows in."""
    jvm = df.sparkSession.sparkContext._jvm
    files = (df.groupBy(*partition_cols).agg(F.min("_metadata.file_path").alias("file"))
             .select("file").collect())
    out = []
    for r in files:
        p, parts = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r.file)).getParent(), []
        for _ in partition_cols:
            parts.insert(0, p.getName())
            p = p.getParent()
        out.append("/".join(parts))
    return out


def replace_partitions(rows: DataFrame | Sequence[DataFrame], path: str, partition_cols: Sequence[str], old: Sequence[str],
                       schema: StructType, order_col: str | None, write,
                       after_step: Callable[[str], None] | None = None) -> State:
    """Commit ``rows`` as the new contents of their partitions, and of those ``old`` names (folders below
    the table's, or None for all of it); ``old`` ones without new rows are removed.  Several frames are
    written one after another, so that the shuffle files of one are there at a time.

    ``write`` makes a DataFrameWriter of a frame.  ``after_step`` is called with the name of
    each step that is done.  Returns the new state, with the marks of the replaced partitions.
    """
    frames = [rows] if isinstance(rows, DataFrame) else list(rows)
    spark = frames[0].sparkSession
    folder, step = Folder(spark, path), after_step or (lambda name: None)
    depth = len(partition_cols)
    before = read_state(spark, path)
    with shuffles_freed(spark):
        for i, frame in enumerate(frames):
            write(frame).mode("append" if i else "overwrite").parquet(f"{path}/{_WORK}/next")
    step("written")
    new = units(folder, f"{_WORK}/next", depth)
    gone = units(folder, "", depth) if old is None or not depth else [n for n in old if n not in new]
    marks = {} if before is None or old is None or not depth else {
        k: v for k, v in before.marks.items() if k not in new and k not in gone}
    if order_col is not None and new:
        # one column of the rows just written, not of the table
        fresh = spark.read.schema(schema).parquet(f"{path}/{_WORK}/next")
        part = folders_of("_metadata.file_path", depth).alias("part")
        with shuffles_freed(spark):
            found = fresh.groupBy(part).agg(F.max(order_col).alias("mark")).collect()
        for r in found:
            if r.mark is not None:
                name = folder._jvm.java.net.URI(r.part).getPath() if depth else ""
                marks[name] = _text(r.mark)
    state = State(schema, marks, order_col, before.number + 1 if before else 1)
    intent = {"replace": new, "remove": gone, "state": state.dump(), "number": state.number}
    folder.write_json(f"{_WORK}/intent.json", intent)
    step("intended")
    _apply(folder, intent, step)
    return state
