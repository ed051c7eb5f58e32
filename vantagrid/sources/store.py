"""Object stores by URI: local folders, HDFS, S3 and whatever else Hadoop reads.

The driver goes through Hadoop's file systems; tasks, which have no JVM at hand, go
through Arrow's. A key is a path relative to the store's root.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import islice
from pathlib import Path
from urllib.parse import quote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from vantagrid.errors import KeyExists, KeyMissing, NotPermitted, StoreRefused


@dataclass(frozen=True)
class Store:
    """A root that keys are relative to; all calls run on the driver."""

    spark: SparkSession
    root: str

    @staticmethod
    def at(spark: SparkSession, root: str) -> Store:
        parsed = urlparse(root)
        if parsed.scheme in ("s3", "s3a") and not parsed.netloc:
            raise StoreRefused(f"{root} names no bucket")
        if parsed.scheme == "s3":
            root = "s3a" + root[2:]
        return Store(spark, (root if parsed.scheme else "file://" + str(Path(root).resolve())).rstrip("/"))

    def path(self, key: str = "") -> str:
        return f"{self.root}/{key}" if key else self.root

    def _open(self, key: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(key))
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if self.root.startswith("file:"):
            fs.setWriteChecksum(False)  # no hidden checksum files beside documents that others may edit
        return fs, path

    def _call(self, key: str, method: str, *args):
        fs, path = self._open(key)
        try:
            return getattr(fs, method)(path, *args)
        except Py4JJavaError as e:
            kind = e.java_exception.getClass().getSimpleName()
            if "FileNotFound" in kind:
                raise KeyMissing(self.path(key)) from None
            if "AlreadyExists" in kind:
                raise KeyExists(self.path(key)) from None
            if "AccessDenied" in kind or "AccessControl" in kind:
                raise NotPermitted(self.path(key)) from None
            raise

    def exists(self, key: str) -> bool:
        return self._call(key, "exists")

    def read_text(self, key: str) -> str:
        stream = self._call(key, "open")
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write(self, key: str, text: str, overwrite: bool) -> None:
        stream = self._call(key, "create", overwrite)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def write_text(self, key: str, text: str) -> None:
        self._write(key, text, True)

    def write_text_if_absent(self, key: str, text: str) -> None:
        """Write a key that must be new: the commit of a run or a version.

        Local folders use an exclusive create. Others are asked to put the object on the
        condition that it is new, which an object store decides when the object is
        complete; a file system that does not know the option creates without overwriting.
        """
        if not self.root.startswith("file:"):
            self._write_new(key, text)
            return
        path = Path(urlparse(self.path(key)).path)
        path.parent.mkdir(parents=True, exist_ok=True)
        try:
            handle = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644)
        except FileExistsError:
            raise KeyExists(self.path(key)) from None
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.write(text)

    def _write_new(self, key: str, text: str) -> None:
        fs, path = self._open(key)
        try:
            stream = fs.createFile(path).recursive().overwrite(False).opt("fs.option.create.conditional.overwrite", True).build()
            stream.write(bytearray(text.encode()))
            stream.close()
        except Py4JJavaError as e:
            kind = e.java_exception.getClass().getSimpleName()
            # a condition that fails when the object is complete comes back as a failed request
            if "AlreadyExists" in kind or "Precondition" in str(e.java_exception) or "412" in str(e.java_exception):
                raise KeyExists(self.path(key)) from None
            raise

    def list_keys(self, prefix: str = "") -> list[str]:
        """Keys below a folder, in order; none if it is not there."""
        try:
            files = self._call(prefix, "listFiles", True)
        except KeyMissing:
            return []
        base = urlparse(self.root).path.rstrip("/") + "/"
        found = []
        while files.hasNext():
            path = files.next().getPath().toUri().getPath()
            if not path.endswith(".crc"):
                found.append(path[len(base) :])
        return sorted(found)

    @property
    def of_objects(self) -> bool:
        """Whether keys are objects, which writers may not take back, rather than files."""
        return urlparse(self.root).scheme in ("s3a", "s3n", "gs", "abfs", "abfss", "wasb", "oss", "cosn")

    def delete_prefix(self, prefix: str) -> None:
        """Clear what an interrupted writer left; not where objects are kept, as their writers may only put."""
        if self.of_objects:
            raise NotPermitted(f"{self.path(prefix)}: objects are not deleted here, but pruned")
        self._call(prefix, "delete", True)

    def delete_keys(self, keys: Iterable[str]) -> int:
        """Delete many keys with as few requests as the store allows (an object store takes a thousand at a time); how many were asked for."""
        jvm = self.spark._jvm
        fs, base = self._open()
        bulk = fs.createBulkDelete(base)
        try:
            n, size = 0, bulk.pageSize()
            rest = iter(keys)
            while page := list(islice(rest, size)):
                paths = jvm.java.util.ArrayList()
                for key in page:
                    paths.add(jvm.org.apache.hadoop.fs.Path(self.path(key)))
                failed = bulk.bulkDelete(paths)
                if failed.size():
                    raise NotPermitted(f"{failed.get(0).getKey()}: {failed.get(0).getValue()}")
                n += len(page)
            return n
        finally:
            bulk.close()

    @property
    def deletes_at_once(self) -> int:
        """How many keys one request deletes."""
        fs, base = self._open()
        bulk = fs.createBulkDelete(base)
        try:
            return bulk.pageSize()
        finally:
            bulk.close()

    def put_file(self, local: str | Path, key: str) -> None:
        fs, path = self._open(key)
        source = self.spark._jvm.org.apache.hadoop.fs.Path("file://" + str(Path(local).resolve()))
        fs.copyFromLocalFile(False, True, source, path)

    def get_file(self, key: str, local: str | Path) -> None:
        if not self.exists(key):
            raise KeyMissing(self.path(key))
        Path(local).parent.mkdir(parents=True, exist_ok=True)
        fs, path = self._open(key)
        fs.copyToLocalFile(False, path, self.spark._jvm.org.apache.hadoop.fs.Path("file://" + str(Path(local).resolve())), True)

    def describe(self, key: str = "") -> str:
        return self.path(key).removeprefix("file://")


def arrow_path(uri: str):
    """Arrow's file system and path of a URI, for use in tasks; the path is taken as it is, whatever signs it has.

    A path without a scheme is a local one, as for ``Store.at``.
    """
    from pyarrow import fs

    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    scheme, _, rest = uri.replace("s3a://", "s3://", 1).partition(":")
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")


def copy_file(source: str, target: str) -> None:
    """Copy bytes between URIs, in a task; overwriting, so a retried task repeats itself harmlessly.

    Within one store the store copies by itself; only between stores do bytes pass through the task.
    """
    fs, path = arrow_path(target)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    other, from_path = arrow_path(source)
    if fs == other:
        fs.copy_file(from_path, path)
        return
    with other.open_input_stream(from_path) as a, fs.open_output_stream(path) as b:
        while data := a.read(1 << 20):
            b.write(data)


def read_bytes(source: str) -> bytes:
    fs, path = arrow_path(source)
    with fs.open_input_stream(path) as f:
        return f.read()


def write_bytes(target: str, data: bytes) -> None:
    fs, path = arrow_path(target)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(data)
