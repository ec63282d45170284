"""Files on any store: names come from Hadoop on the driver, bytes through Arrow's file systems on the executors."""

from __future__ import annotations

import errno
import io
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import SparkSession


def resolved(spark: SparkSession, path: str, make: bool = False) -> str:
    """The URI behind ``path`` (default file system filled in, mounted views followed); ``make`` creates the folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if make:
        files.mkdirs(at)
    return files.resolvePath(at).toString()


class _Readable(io.RawIOBase):
    """An Arrow file for libraries that expect Python's errors: a seek before the begin is an OSError."""

    def __init__(self, file):
        self.file, self.size = file, file.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        at = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.file.tell(), io.SEEK_END: self.size}[whence]
        if at < 0:
            raise OSError(errno.EINVAL, "seek before the begin of the file")
        self.file.seek(at)
        return at

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)

    def close(self) -> None:
        self.file.close()
        super().close()


class Store:
    """One folder of a store."""

    def __init__(self, uri: str):
        if uri.startswith("file:"):  # Hadoop writes such paths as they are, without escapes
            self.fs, root = fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
        else:
            self.fs, root = fs.FileSystem.from_uri(uri)
        self.root = root.rstrip("/")

    def files(self) -> Iterator[tuple[str, int]]:
        """(path, bytes) of the files below the folder; hidden and unfinished ones are left out."""
        for info in self.fs.get_file_info(fs.FileSelector(self.root, recursive=True)):
            inside = info.path[len(self.root):]
            if info.type == fs.FileType.File and not any(p.startswith((".", "_")) for p in inside.split("/")):
                yield info.path, info.size

    def open(self, path: str) -> io.BufferedReader:
        return io.BufferedReader(_Readable(self.fs.open_input_file(path)))

    def put(self, name: str, content: bytes) -> str:
        """Write one file whole: readers see none of it or all."""
        path = f"{self.root}/{name}"
        folder, last = path.rsplit("/", 1)
        unfinished = f"{folder}/.{last}.{uuid.uuid4().hex[:8]}"
        self.fs.create_dir(folder, recursive=True)
        with self.fs.open_output_stream(unfinished) as out:
            out.write(content)
        self.fs.move(unfinished, path)
        return path

    def drop(self, name: str) -> None:
        path = f"{self.root}/{name}"
        if self.fs.get_file_info(path).type == fs.FileType.File:
            self.fs.delete_file(path)

