"""Which folders make up a table: a small versioned list, switched in one rename.

A write goes to a folder of its own that nobody reads yet; then a new list is put beside the old one. Readers take the
highest version, so a write that dies leaves the table as it was, and a reader keeps the folders it began with.
The same list names the table's kept watermarks, which therefore change together with its rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

FOLDER = "_manifest"


@dataclass(frozen=True)
class Entry:
    """A part of a table: one month of one write (``month`` None: the table has no months)."""

    write: str  # name of the write's folder
    month: str | None
    load_id: int
    unique: bool = True  # holds each key once


@dataclass(frozen=True)
class Marks:
    """Latest dates per group of the rows that loads up to ``load_id`` brought, in a folder of their own."""

    marks: str
    load_id: int
    size: int  # bytes of the rows, as ``lookup_bytes`` counts them


class Manifest:
    def __init__(self, spark: SparkSession, table_path: str):
        self.path, jvm = table_path, spark._jvm
        self._place = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join([table_path, *parts]))
        self._fs = self._place().getFileSystem(spark._jsc.hadoopConfiguration())
        self._read = lambda stream: jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")

    def _names(self, *parts: str) -> list[str]:
        place = self._place(*parts)
        return [f.getPath().getName() for f in self._fs.listStatus(place)] if self._fs.exists(place) else []

    def version(self) -> int:
        return max((int(n) for n in self._names(FOLDER) if n.isdigit()), default=0)

    def content(self) -> tuple[list[Entry], list[Marks]]:
        version = self.version()
        if not version:
            return [], []
        stream = self._fs.open(self._place(FOLDER, str(version)))
        try:
            lines = [json.loads(line) for line in self._read(stream).splitlines()]
        finally:
            stream.close()
        return [Entry(**x) for x in lines if "write" in x], [Marks(**x) for x in lines if "marks" in x]

    def entries(self) -> list[Entry]:
        return self.content()[0]

    def months_of(self, write: str) -> list[str | None]:
        """Month folders that a write has left; [None] for files straight in its folder."""
        names = self._names(write)
        months = sorted(n.split("=", 1)[1] for n in names if n.startswith("month="))
        return months or ([None] if any(n.startswith("part-") for n in names) else [])

    def switch(self, entries: Iterable[Entry | Marks]) -> None:
        """Make ``entries`` the table, with the marks among them its watermarks. The list before stays for readers that are about to open it."""
        version = self.version() + 1
        draft, final = self._place(FOLDER, f".{version}"), self._place(FOLDER, str(version))
        stream = self._fs.create(draft, True)
        stream.write(bytearray("\n".join(json.dumps(e.__dict__) for e in entries), "utf-8"))
        stream.close()
        if not self._fs.rename(draft, final):
            raise RuntimeError(f"another writer has changed {self.path}")
        self._fs.delete(self._place(FOLDER, str(version - 2)), False)

    def vacuum(self) -> list[str]:
        """Delete the folders of writes that are in no list; call it when no job reads or writes the table."""
        entries, marks = self.content()
        used = {e.write for e in entries} | {m.marks for m in marks}
        old = [n for n in self._names() if n.startswith(("write=", "marks=")) and n not in used]
        for name in old:
            self._fs.delete(self._place(name), True)
        return old
