"""Releases: which files make up the tables of a folder, and the control table's rows, as one small file.

A folder of tables has ``_releases/0000000001.json``, ``…2.json`` and so on; the last one holds for every table and
quarter the run that wrote its rows (``<table>/data/run=…/<key>=…``), and the control rows (one for each
survey quarter). So any number of tables and the loaded flags change in one step, and a reader that
took a release sees all of them as they were.

A release is written under a name of its own attempt and then takes the next number, which only one writer
can: by a hard link on a local disk, elsewhere by a rename that refuses a name that is there (HDFS,
ABFS; stores whose rename isn't such a step need one writer at a time). Whatever a dead job leaves,
attempts or data, is named by no release and is stepped over. A writer that finds its number taken reads the
new release and makes its change again on that; only this small file is written anew, not the data.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

_NAME = re.compile(r"\d{10}\.json")
_ATTEMPT = "_attempt-"


@dataclass(frozen=True)
class Part:
    """A quarter's rows: the run that wrote them, the run that it copied them from, the names' rules that they follow."""

    run: str
    of: str = ""
    rules: str = ""


@dataclass
class Release:
    """Tables by name, each with its parts by quarter; control tables by name; quarters done by a job in steps."""

    tables: dict[str, dict[str, Part]] = field(default_factory=dict)
    control: dict[str, list[list]] = field(default_factory=dict)
    done: dict[str, list[str]] = field(default_factory=dict)

    def replaced(self, table: str, gone: set[str], parts: dict[str, Part]) -> None:
        """The table loses the quarters ``gone`` and gets the new parts."""
        kept = {quarter: part for quarter, part in self.tables.get(table, {}).items() if quarter not in gone}
        self.tables[table] = dict(sorted((kept | parts).items()))

    def text(self) -> str:
        tables = {name: {q: [p.run, p.of, p.rules] for q, p in parts.items()} for name, parts in self.tables.items()}
        return json.dumps({"tables": tables, "control": self.control, "done": self.done}, indent=0)

    @staticmethod
    def parsed(text: str) -> Release:
        found = json.loads(text)
        tables = {name: {q: Part(*p) for q, p in parts.items()} for name, parts in found["tables"].items()}
        return Release(tables, found["control"], found["done"])


class Folder:
    """A folder in a file system that Spark can reach."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.conf, self.gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway
        hadoop = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = hadoop.getFileSystem(self.conf)
        self.path = self.fs.makeQualified(hadoop)

    def _at(self, *names: str):
        at = self.path
        for name in names:
            at = self.jvm.org.apache.hadoop.fs.Path(at, name)
        return at

    def names(self, *below: str) -> dict[str, int]:
        """What is in the folder, with the time of its last change in ms; empty if it isn't there."""
        at = self._at(*below)
        return {s.getPath().getName(): s.getModificationTime() for s in self.fs.listStatus(at)} if self.fs.exists(at) else {}

    def text(self, *names: str) -> str:
        stream = self.fs.open(self._at(*names))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def removed(self, *names: str) -> None:
        self.fs.delete(self._at(*names), True)

    def taken(self, text: str, below: str, name: str) -> bool:
        """Put the text there under ``name``, whole or not at all; False if the name is taken."""
        attempt = f"{_ATTEMPT}{uuid.uuid4().hex}"
        if self.fs.getUri().getScheme() == "file":
            folder = unquote(urlparse(self._at(below).toString()).path)
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/{attempt}", "w", encoding="utf-8") as file:
                file.write(text)
                file.flush()
                os.fsync(file.fileno())
            try:
                os.link(f"{folder}/{attempt}", f"{folder}/{name}")
            except FileExistsError:
                return False
            finally:
                os.unlink(f"{folder}/{attempt}")
            return True
        return self._renamed(text, below, attempt, name)

    def _renamed(self, text: str, below: str, attempt: str, name: str) -> bool:
        stream = self.fs.create(self._at(below, attempt), False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        hadoop = self.jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(self.fs.getUri(), self.conf)
        no_overwrite = self.gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            context.rename(self._at(below, attempt), self._at(below, name), no_overwrite)
        except Exception:
            self.removed(below, attempt)
            if self.fs.exists(self._at(below, name)):
                return False
            raise
        return True


def _numbered(folder: Folder) -> list[int]:
    return sorted(int(name[:10]) for name in folder.names("_releases") if _NAME.fullmatch(name))


def latest(spark: SparkSession, root: str) -> tuple[int, Release]:
    """The last release and its number; an empty one and 0 if there is none. A damaged one is an error."""
    folder = Folder(spark, root)
    numbers = _numbered(folder)
    return (numbers[-1], Release.parsed(folder.text("_releases", f"{numbers[-1]:010d}.json"))) if numbers else (0, Release())


def commit(spark: SparkSession, root: str, change: Callable[[Release], None], attempts: int = 100) -> int:
    """Make the change on the last release and add it as the next one; returns its number.

    ``change`` is made again, on what is there then, whenever another writer was faster.
    """
    folder = Folder(spark, root)
    for _ in range(attempts):
        number, release = latest(spark, root)
        change(release)
        if folder.taken(release.text(), "_releases", f"{number + 1:010d}.json"):
            return number + 1
    raise RuntimeError(f"no release of {root} could be added in {attempts} attempts; other writers were faster each time")


def sweep(spark: SparkSession, root: str, keep: int = 2, grace_hours: float = 24.0) -> list[str]:
    """Remove what none of the last ``keep`` releases names: runs, older releases and attempts; returns what went.

    Nothing that changed within the last ``grace_hours`` goes, as a job may be about to name it, or a reader of an
    older release may still be at work.
    """
    if keep < 1:
        raise ValueError("the last release must stay")
    folder = Folder(spark, root)
    numbers = _numbered(folder)
    if not numbers:
        return []
    kept = [Release.parsed(folder.text("_releases", f"{n:010d}.json")) for n in numbers[-keep:]]
    before = folder.jvm.java.lang.System.currentTimeMillis() - grace_hours * 3_600_000
    gone = []
    for table in sorted({name for release in kept for name in release.tables}):
        named = {f"run={part.run}" for release in kept for part in release.tables.get(table, {}).values()}
        gone += [(table, "data", name) for name, at in folder.names(table, "data").items() if name not in named and at <= before]
    old = {f"{n:010d}.json" for n in numbers[:-keep]}
    gone += [("_releases", name) for name, at in folder.names("_releases").items() if (name in old or name.startswith(_ATTEMPT)) and at <= before]
    for names in gone:
        folder.removed(*names)
    return sorted("/".join(names) for names in gone)
