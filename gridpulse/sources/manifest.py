"""Versions of a folder: small files that say what is visible, each published at once or not at all."""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_versions"


class ConflictError(RuntimeError):
    """Another writer published the version that was to be published."""


class Manifest:
    """The numbered versions below ``path``, on whatever file system it lies.

    Version ``n`` is one file. It is written beside its place and renamed into it, which fails if another
    writer was first; so a version is seen whole or not, and two writers never publish the same one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm = spark._jvm
        self.folder = self._hadoop(f"{self.path}/{FOLDER}")
        self.fs = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _file(self, version: int):
        return self._hadoop(f"{self.path}/{FOLDER}/{version:012d}.json")

    def versions(self) -> list[int]:
        """Published versions, ascending; none if there is no such folder."""
        found = self.fs.globStatus(self._hadoop(f"{self.path}/{FOLDER}/*.json")) or []
        return sorted(int(status.getPath().getName().removesuffix(".json")) for status in found)

    def latest(self) -> int:
        """The newest version, 0 if nothing was published."""
        return max(self.versions(), default=0)

    def read(self, version: int) -> dict[str, Any]:
        if not version:
            return {}
        stream = self.fs.open(self._file(version))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, version: int, content: dict[str, Any]) -> None:
        """Make ``content`` the next version after ``version``, or raise ``ConflictError``."""
        draft = self._hadoop(f"{self.path}/{FOLDER}/{uuid.uuid4().hex}.draft")
        out = self.fs.create(draft)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            draft.getFileSystem(self.spark._jsc.hadoopConfiguration()).getUri(), self.spark._jsc.hadoopConfiguration()
        )
        never_over = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            if self.latest() != version:
                raise ConflictError(f"{self.path} is at version {self.latest()}, not {version}")
            context.rename(draft, self._file(version + 1), never_over)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                raise ConflictError(f"version {version + 1} of {self.path} exists") from None
            raise
        finally:
            if self.fs.exists(draft):
                self.fs.delete(draft, False)

    def forget(self, keep: int) -> None:
        """Remove all but the newest ``keep`` versions."""
        for version in self.versions()[: -max(keep, 1)]:
            self.fs.delete(self._file(version), False)

    def remove(self, relative: str) -> None:
        self.fs.delete(self._hadoop(f"{self.path}/{relative}"), True)

    def children(self, relative: str) -> list[str]:
        found = self.fs.globStatus(self._hadoop(f"{self.path}/{relative}/*")) or []
        return [status.getPath().getName() for status in found]
