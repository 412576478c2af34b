"""What a stream has already done, step by step, in a folder that outlives it.

A step of a stream may run again after a failure, with the same number and the same rows. An
entry of the ledger says that a step is done and how many rows all steps up to it had, so
that a step that comes again is told from a new one. Entries are small files that appear
whole, by renaming; only the latest few are kept, as no older step can come again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

KEPT = 8


class Folder:
    """Files of a folder that any Hadoop file system holds."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        context = spark.sparkContext
        self.jvm = context._jvm
        self.path = path.rstrip("/")
        self._conf = context._jsc.hadoopConfiguration()
        self.files = self.at().getFileSystem(self._conf)
        self.files.mkdirs(self.at())

    def at(self, *names: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def names(self) -> list[str]:
        return sorted(f.getPath().getName() for f in self.files.listStatus(self.at()))

    def delete(self, name: str) -> None:
        self.files.delete(self.at(name), True)

    def move(self, name: str, other: Folder, to: str) -> None:
        """Rename a file into another folder of the same file system."""
        if not self.files.rename(self.at(name), other.at(to)):
            raise OSError(f"cannot rename {self.at(name)} to {other.at(to)}")

    def write(self, name: str, text: str) -> None:
        """A file that is there whole or not at all."""
        draft = f".{name}.{uuid.uuid4().hex}"
        out = self.files.create(self.at(draft), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.delete(name)
        self.move(draft, self, name)

    def read(self, name: str) -> str:
        stream = self.files.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


@dataclass(frozen=True)
class Entry:
    """A finished step: its number, its rows, and the rows of all steps up to it."""

    step: int
    rows: int
    total: int


class Ledger:
    """Steps that are done. ``run`` tells streams apart that share a folder."""

    def __init__(self, spark: SparkSession, path: str, run: str = "run") -> None:
        if not run.replace("_", "").isalnum():
            raise ValueError("a run is named by letters, digits and underscores")
        self.folder, self.run = Folder(spark, path), run

    def _name(self, step: int) -> str:
        return f"{self.run}-{step:018d}.json"

    def _steps(self) -> list[int]:
        """Numbers of the entries kept, ascending."""
        head = f"{self.run}-"
        names = [n for n in self.folder.names() if n.startswith(head) and n.endswith(".json")]
        return [int(n.removeprefix(head).removesuffix(".json")) for n in names]

    def entry(self, step: int) -> Entry | None:
        if step not in self._steps():
            return None
        return Entry(**json.loads(self.folder.read(self._name(step))))

    def latest(self) -> Entry | None:
        steps = self._steps()
        return self.entry(steps[-1]) if steps else None

    def total_before(self, step: int) -> int:
        """Rows of all steps before this one."""
        steps = [s for s in self._steps() if s < step]
        return self.entry(steps[-1]).total if steps else 0

    def is_done(self, step: int) -> bool:
        last = self._steps()[-1:]
        return bool(last) and step <= last[0]

    def done(self, step: int, rows: int) -> Entry:
        """Note a step; nothing may be left to do for it but this."""
        entry = Entry(step, rows, self.total_before(step) + rows)
        self.folder.write(self._name(step), json.dumps(entry.__dict__))
        for old in self._steps()[:-KEPT]:
            self.folder.delete(self._name(old))
        return entry
