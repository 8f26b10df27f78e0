"""Tables whose content is what one manifest lists.

A ledger is a folder with data/ (Parquet folders, each written once) and versions/ (one small JSON file per
version). The newest version names the parts that make up the table, each with a key and facts about it,
and all that was written but isn't named there doesn't count. A commit is one rename onto a version
number that must be free: of two writers one has to read the newest version and try again, and
a writer that stops anywhere leaves the table as it was. Readers take one version and keep it, so a commit
amid a read changes nothing for them. vacuum() deletes what no kept version names.

A manifest grows with the parts, so writers of many small parts merge them now and then.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_temporary: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from spark.checkpoint.dir; on a local master a temporary one where none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _temporary:
        _temporary[app] = f"file://{tempfile.mkdtemp(prefix='spanmill-')}"
    return _temporary[app]


def kept(frame: DataFrame, label: str, store: str | None = None) -> DataFrame:
    """frame written as a table in a shared folder, the session's by default, and read back."""
    path = f"{(store or scratch(frame.sparkSession)).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@dataclass(frozen=True)
class Part:
    """A folder of a ledger, or none (an empty path). key names its place: a commit takes away the part that had it. facts are the writer's own."""

    key: str
    path: str
    facts: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Version:
    number: int
    parts: tuple[Part, ...] = ()
    facts: dict = field(default_factory=dict)

    def part(self, key: str) -> Part | None:
        return next((p for p in self.parts if p.key == key), None)


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _fs(self, path: str):
        return self._fs_path(path).getFileSystem(self._conf)

    def _names(self, folder: str) -> list[tuple[str, int]]:
        """(name, time of change in ms) of a folder's entries; none if it doesn't exist."""
        path = f"{self.root}/{folder}"
        if not self._fs(path).exists(self._fs_path(path)):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self._fs(path).listStatus(self._fs_path(path))]

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n, _ in self._names("versions") if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def _load(self, number: int) -> Version:
        stream = self._fs(self.root).open(self._fs_path(f"{self.root}/versions/{number:012d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        own = json.loads(text)
        return Version(number, tuple(Part(p["key"], p["path"], p["facts"]) for p in own["parts"]), own["facts"])

    def current(self) -> Version:
        """The newest version; version 0 of an empty ledger has no parts."""
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else Version(0)

    def stage(self, rows: DataFrame, partition_by: str | None = None) -> str:
        """Write rows as a folder that no version names yet; its path within the ledger."""
        own = f"data/{uuid.uuid4().hex}"
        writer = rows.write
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{self.root}/{own}")
        return own

    def frame(self, path: str, schema: T.StructType | str) -> DataFrame:
        """A part, or a staged folder."""
        return self.spark.read.schema(schema).parquet(f"{self.root}/{path}")

    def read(self, schema: T.StructType | str, version: Version | None = None, parts: tuple[Part, ...] | list[Part] | None = None) -> DataFrame:
        """The rows of a version, the newest by default, or of some of its parts."""
        own = [p for p in ((version or self.current()).parts if parts is None else parts) if p.path]
        if not own:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p.path}" for p in own])

    def commit(self, change: Callable[[Version], tuple[tuple[Part, ...], dict] | None], tries: int = 20) -> Version:
        """Make change(newest version) = (parts, facts) the next version; None leaves all as it is.

        change is called anew when another writer was faster, so it must not rest on what it saw before.
        """
        for _ in range(tries):
            old = self.current()
            made = change(old)
            if made is None:
                return old
            new = Version(old.number + 1, tuple(made[0]), made[1])
            if self._publish(new):
                return new
        raise RuntimeError(f"{tries} other commits came first: {self.root}")

    def _publish(self, new: Version) -> bool:
        """Whether the version's number was free. The file appears whole or not at all."""
        body = json.dumps({"parts": [{"key": p.key, "path": p.path, "facts": p.facts} for p in new.parts], "facts": new.facts})
        draft = self._fs_path(f"{self.root}/versions/.{uuid.uuid4().hex}.draft")
        stream = self._fs(self.root).create(draft, True)
        try:
            stream.write(bytearray(body.encode()))
        finally:
            stream.close()
        jvm = self.spark._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs(self.root).getUri(), self._conf)
        options = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(draft, self._fs_path(f"{self.root}/versions/{new.number:012d}.json"), options)
        except Exception as error:
            if "FileAlreadyExists" not in str(error) and "already exists" not in str(error).lower():
                raise
            self._fs(self.root).delete(draft, False)
            return False
        return True

    def put(self, key: str, path: str, facts: dict | None = None) -> Version:
        """Add a staged folder as the part of a key, in place of the one that had it."""
        return self.commit(lambda old: ((*(p for p in old.parts if p.key != key), Part(key, path, facts or {})), old.facts))

    def vacuum(self, keep: int = 2, grace_ms: int = 86_400_000) -> int:
        """Delete versions but the newest few, and folders that they don't name and that are older than grace; how many folders went.

        grace must be longer than the longest job between stage() and its commit, and than the longest reader.
        """
        kept = self._numbers()[-keep:]
        named = {p.path.split("/")[1] for n in kept for p in self._load(n).parts if p.path}
        now = int(self.spark._jvm.System.currentTimeMillis())
        for number in self._numbers():
            if number < (kept[0] if kept else 0):
                self._fs(self.root).delete(self._fs_path(f"{self.root}/versions/{number:012d}.json"), False)
        gone = [n for n, changed in self._names("data") if n not in named and now - changed >= grace_ms]
        for name in gone:
            self._fs(self.root).delete(self._fs_path(f"{self.root}/data/{name}"), True)
        return len(gone)
