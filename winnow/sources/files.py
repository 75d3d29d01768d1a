"""Text files by name: a sink that puts each row's body into a file of its own.

Tasks write below a hidden folder of the run; nothing is in its place before all have succeeded, and
what a failed run wrote goes. The module is pickled by value, so executors need no install.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "named_files"
_NO_NAMES = ("", ".", "..")


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: where it lies, and the names below the root."""

    folder: str
    names: list[str]


class _Writer(DataSourceWriter):
    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")
        self.staging = f"{self.path}/_staging-{uuid4().hex}"
        files, staged = self._files(self.staging)
        files.create_dir(staged, recursive=True)

    def _files(self, path: str) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")

    def write(self, rows: Iterator[Row]) -> Written:
        context = TaskContext.get()
        folder = f"{self.staging}/{context.partitionId()}-{context.taskAttemptId()}"
        files, root = self._files(folder)
        _, run = self._files(self.staging)
        names = []
        for row in rows:
            if files.get_file_info(run).type == fs.FileType.NotFound:
                raise RuntimeError("the run has been given up")
            parts = row.name.split("/")
            if any(p in _NO_NAMES for p in parts):
                raise ValueError(f"not a name for a file: {row.name!r}")
            files.create_dir("/".join([root, *parts[:-1]]), recursive=True)
            with files.open_output_stream(f"{root}/{row.name}") as out:
                out.write((row.body or "").encode())
            names.append(row.name)
        return Written(folder, names)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = self._files(self.path)
        done = [m for m in messages if m is not None]
        for message in done:
            _, staged = self._files(message.folder)
            for name in message.names:
                files.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
                files.move(f"{staged}/{name}", f"{root}/{name}")
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        files, staged = self._files(self.staging)
        if files.get_file_info(staged).type != fs.FileType.NotFound:
            files.delete_dir(staged)


class NamedFiles(DataSource):
    """Rows of ``name`` and ``body``; the option ``path`` is a folder that all executors share."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, body string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"])


def write_files(rows: DataFrame, path: str) -> None:
    """Write ``body`` of each row to the file ``name`` below ``path``.

    A name is a path below the folder, its parts parted by slashes. Files of earlier runs are replaced. Rows
    that share a name are refused before anything is written. A null body is an empty file. The files of a
    run appear when all of its tasks have succeeded; their names, not their bodies, come to the driver.
    """
    shared = rows.groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    if (first := shared.orderBy("name").first()) is not None:
        raise ValueError(f"{first.n} rows have the name {first['name']!r}")
    rows.sparkSession.dataSource.register(NamedFiles)
    rows.select("name", "body").write.format(FORMAT).option("path", path).mode("append").save()
