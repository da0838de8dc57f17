"""Small files (pointers, ids, records) on the file systems that tables live on.

A classic session reaches them through the file system layer that Spark's own
readers use; a Connect session, which has no such handle, through Arrow's.
A file appears whole: it is written under another name and renamed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class FileTakenError(FileExistsError):
    """Someone else has published a file of that name first."""


class _Hadoop:
    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def write(self, path: str, data: bytes) -> None:
        out = self.fs.create(self._path(path), True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()

    def rename(self, source: str, target: str) -> bool:
        return not self.fs.exists(self._path(target)) and self.fs.rename(self._path(source), self._path(target))

    def read(self, path: str) -> bytes | None:
        if not self.fs.exists(self._path(path)):
            return None
        source = self.fs.open(self._path(path))
        try:
            return bytes(source.readAllBytes())
        finally:
            source.close()

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self._path(folder)):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(folder))]

    def stamps(self, path: str) -> list[tuple[str, int, int]]:
        if not self.fs.exists(self._path(path)):
            return []
        return [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in self.fs.listStatus(self._path(path))]

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


class _Arrow:
    def __init__(self, path: str):
        from pyarrow import fs
        self.local = path.startswith(("/", "file:"))
        self.fs = fs.LocalFileSystem() if self.local else fs.FileSystem.from_uri(path)[0]

    def _path(self, path: str) -> str:
        from pyarrow import fs
        return "/" + path.removeprefix("file:").strip("/") if self.local else fs.FileSystem.from_uri(path)[1]

    def _kind(self, path: str) -> str:
        return self.fs.get_file_info(self._path(path)).type.name

    def write(self, path: str, data: bytes) -> None:
        self.fs.create_dir(self._path(path.rsplit("/", 1)[0]), recursive=True)
        with self.fs.open_output_stream(self._path(path), compression=None) as out:
            out.write(data)

    def rename(self, source: str, target: str) -> bool:
        if self._kind(target) != "NotFound":
            return False
        self.fs.move(self._path(source), self._path(target))
        return True

    def replace(self, source: str, target: str) -> None:
        self.fs.create_dir(self._path(target.rsplit("/", 1)[0]), recursive=True)
        if not self.local and self._kind(target) == "File":
            self.fs.delete_file(self._path(target))
        self.fs.move(self._path(source), self._path(target))

    def size(self, path: str) -> int:
        return self.fs.get_file_info(self._path(path)).size

    def files_below(self, folder: str) -> list[str]:
        """Paths of the files in a folder and its subfolders, without hidden ones."""
        from pyarrow import fs
        if self._kind(folder) != "Directory":
            return []
        root, base = folder.rstrip("/"), self._path(folder).rstrip("/")
        below = [i.path[len(base) + 1:] for i in self.fs.get_file_info(fs.FileSelector(self._path(folder), recursive=True))
                 if i.type.name == "File"]
        return [f"{root}/{b}" for b in below if not any(part.startswith((".", "_")) for part in b.split("/"))]

    def read(self, path: str) -> bytes | None:
        if self._kind(path) != "File":
            return None
        with self.fs.open_input_stream(self._path(path)) as source:
            return source.read()

    def names(self, folder: str) -> list[str]:
        from pyarrow import fs
        if self._kind(folder) != "Directory":
            return []
        return [i.base_name for i in self.fs.get_file_info(fs.FileSelector(self._path(folder)))]

    def stamps(self, path: str) -> list[tuple[str, int, int]]:
        from pyarrow import fs
        kind = self._kind(path)
        found = self.fs.get_file_info(fs.FileSelector(self._path(path))) if kind == "Directory" else (
            [self.fs.get_file_info(self._path(path))] if kind == "File" else [])
        return [(i.base_name, i.size or 0, (i.mtime_ns or 0) // 1_000_000) for i in found]

    def delete(self, path: str) -> None:
        kind = self._kind(path)
        if kind == "Directory":
            self.fs.delete_dir(self._path(path))
        elif kind == "File":
            self.fs.delete_file(self._path(path))


def _of(spark: SparkSession, path: str):
    try:
        handle = spark.sparkContext._jvm
    except Exception:  # noqa: BLE001 - a Connect session has no SparkContext
        handle = None
    return _Hadoop(spark, path) if handle is not None else _Arrow(path)


def write_file(spark: SparkSession, path: str, data: bytes) -> str:
    """A new file, seen whole or not at all; raises if there is one already."""
    folder, name = path.rsplit("/", 1)
    files, passing = _of(spark, path), f"{folder}/.{name}-{uuid.uuid4().hex}"
    files.write(passing, data)
    if not files.rename(passing, path):
        files.delete(passing)
        raise FileTakenError(path)
    return path


def read_file(spark: SparkSession, path: str) -> bytes | None:
    """The file's bytes; None without one."""
    return _of(spark, path).read(path)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, without hidden ones; none if there is no folder."""
    return sorted(n for n in _of(spark, folder).names(folder) if not n.startswith("."))


def stamps(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """(name, size, time of change) of a file, or of the files of a folder:
    other data under the same path has others."""
    return tuple(sorted(_of(spark, path).stamps(path)))


def delete(spark: SparkSession, path: str) -> None:
    """The file or folder goes, with all it holds."""
    _of(spark, path).delete(path)
