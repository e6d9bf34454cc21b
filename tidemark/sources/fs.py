"""Small files through Spark's file systems, so that any store Spark knows will do."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Stores whose files appear when closed and which can refuse to replace one; a rename there copies.
CONDITIONAL_PUT = ("s3a", "gs")


class Files:
    """Reads and writes the metadata files below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.at(name))

    def names(self, folder: str) -> list[str]:
        """Names in a folder, none if there is no such folder."""
        if not self.exists(folder):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self.at(folder))]

    def walk(self, folder: str) -> list[tuple[str, int]]:
        """(path below the root, bytes) of all files below a folder."""
        if not self.exists(folder):
            return []
        found, it = [], self._fs.listFiles(self.at(folder), True)
        base = self._fs.makeQualified(self.at("")).toUri().getPath().rstrip("/")
        while it.hasNext():
            s = it.next()
            found.append((s.getPath().toUri().getPath()[len(base) + 1 :], s.getLen()))
        return sorted(found)

    def read(self, name: str) -> str:
        stream = self._fs.open(self.at(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str, replace: bool = False) -> None:
        """The file appears whole or not at all; an existing one is replaced only if asked for.

        Of several writers of one name, one succeeds and the others get FileExistsError: a local file is
        linked, a store with conditional writes is asked for one, elsewhere (HDFS) a rename refuses.
        """
        if not replace and self.exists(name):
            raise FileExistsError(f"{self.root}/{name} exists: another writer has committed it")
        if not replace and self._fs.getScheme() in CONDITIONAL_PUT:
            return self._put_new(name, text)
        folder, _, last = name.rpartition("/")
        part = f"{folder}/.{last}.{uuid.uuid4().hex}"
        self._fill(self._fs.create(self.at(part), True), text)
        try:
            if not replace and self._fs.getScheme() == "file":
                os.link(self._local(part), self._local(name))
                return
            if replace:
                self._fs.delete(self.at(name), False)
            if not self._fs.rename(self.at(part), self.at(name)):
                raise FileExistsError(f"{self.root}/{name} could not be committed")
        finally:
            self._fs.delete(self.at(part), False)

    def _put_new(self, name: str, text: str) -> None:
        made = self._fs.createFile(self.at(name)).overwrite(False).recursive()
        try:
            self._fill(made.opt("fs.option.create.conditional.overwrite", "true").build(), text)
        except Py4JJavaError as e:
            if self.exists(name):
                raise FileExistsError(f"{self.root}/{name} exists: another writer has committed it") from e
            raise

    def _fill(self, stream, text: str) -> None:
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def _local(self, name: str) -> str:
        return self._fs.makeQualified(self.at(name)).toUri().getPath()

    def delete(self, name: str) -> None:
        self._fs.delete(self.at(name), True)
