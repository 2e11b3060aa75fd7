"""A batch sink of one file a document, at a path of its own.

``register(spark)`` makes the format known; then

    documents.select("rel_path", "text").write.format("quillbank_files").mode("append").save(folder)

writes each ``text`` as UTF-8 bytes to ``folder/rel_path``. Two phases keep half files out: a task writes under a
folder of its attempt below ``_temporary`` and reports how many files that holds, nothing more; only when all tasks are
done are the files of the successful attempts moved to their places. Files of failed or doubled attempts go with
``_temporary``; tasks that outlive a failed job may leave some there, where no scan looks. ``overwrite`` removes what the folder held before, in the same second phase.

Paths are relative and stay inside the folder; other rows fail the job, so sort them out before (``is_inside``). Of rows
with one path, one is kept. Folders are reached by ``pyarrow.fs``, which knows local ones and the usual object stores.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "quillbank_files"
TEMPORARY = "_temporary"
MOVERS = 16


def is_inside(rel_path: Column) -> Column:
    """Whether a relative path names a file inside its folder."""
    plain = ~rel_path.rlike(r"(^|/)\.{0,2}(/|$)") & ~rel_path.rlike(r"[\x00]") & ~F.startswith(rel_path, F.lit(TEMPORARY + "/"))
    return F.coalesce(plain & (rel_path != TEMPORARY), F.lit(False))


def _checked(rel_path: str | None) -> str:
    steps = (rel_path or "").split("/")
    if any(s in ("", ".", "..") for s in steps) or steps[0] == TEMPORARY or "\0" in rel_path:
        raise ValueError(f"not a path inside the folder: {rel_path!r}")
    return rel_path


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and the folder's path there."""
    if "://" in folder or folder.startswith("file:"):
        if folder.startswith("file:"):
            return fs.LocalFileSystem(), "/" + folder[len("file:") :].lstrip("/")
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), posixpath.abspath(folder)


@dataclass
class Written(WriterCommitMessage):
    """An attempt that has written all its files."""

    attempt: str
    n_files: int


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite, self.run = folder, overwrite, uuid4().hex

    def _place(self, *steps: str) -> str:
        return posixpath.join(opened(self.folder)[1], TEMPORARY, self.run, *steps)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, _ = opened(self.folder)
        attempt, n = uuid4().hex, 0
        made: set[str] = set()
        for batch in iterator:
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                target = self._place(attempt, _checked(path))
                if (parent := posixpath.dirname(target)) not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(target) as out:
                    out.write(text or b"")
                n += 1
        return Written(attempt, n)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = opened(self.folder)
        system.create_dir(folder, recursive=True)
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(folder)):
                if info.base_name != TEMPORARY:
                    (system.delete_dir if info.type == fs.FileType.Directory else system.delete_file)(info.path)
        made: set[str] = set()

        def moved(source: str, target: str) -> None:
            system.move(source, target)

        with ThreadPoolExecutor(MOVERS) as movers:
            for message in messages:
                if message is None or not message.n_files:
                    continue
                top = self._place(message.attempt)
                waiting = []
                for info in system.get_file_info(fs.FileSelector(top, recursive=True)):
                    if info.type != fs.FileType.File:
                        continue
                    target = posixpath.join(folder, info.path[len(top) + 1 :])
                    if (parent := posixpath.dirname(target)) not in made:
                        system.create_dir(parent, recursive=True)
                        made.add(parent)
                    waiting.append(movers.submit(moved, info.path, target))
                for done in waiting:
                    done.result()
        self._clear(system, folder)

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = opened(self.folder)
        self._clear(system, folder)

    def _clear(self, system: fs.FileSystem, folder: str) -> None:
        """Removes this run's attempts, and ``_temporary`` when no other run uses it."""
        top = posixpath.join(folder, TEMPORARY)
        if system.get_file_info(self._place()).type == fs.FileType.Directory:
            system.delete_dir(self._place())
        if system.get_file_info(top).type == fs.FileType.Directory and not system.get_file_info(fs.FileSelector(top)):
            system.delete_dir(top)


class JsonFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "rel_path string, text string"

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        if [f.dataType.simpleString() for f in schema.fields] != ["string", "string"]:
            raise ValueError("a table of two text columns is needed: the relative path and the text")
        return FilesWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session; doing it again changes nothing."""
    spark.dataSource.register(JsonFiles)
