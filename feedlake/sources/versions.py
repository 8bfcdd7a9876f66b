"""Numbered versions in a folder, each published by exactly one writer.

A version is a small JSON text in a file named by its number. It is written under another name and then renamed without
replacing, which the file system does for one writer only; who comes second has to look at the new version first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any, TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ..errors import ReadError

Made = TypeVar("Made")
#: Attempts of one commit; each is lost to another writer's commit only.
ATTEMPTS = 50


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether there is such a folder, on any file system that Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


class Versions:
    """The versions below ``root``, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._root = root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop
        self._folder = self._hadoop.fs.Path(self._root)
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """The published numbers, ascending."""
        if not self._files.exists(self._folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def read(self, number: int) -> Any:
        """What version ``number`` says."""
        stream = self._files.open(self._hadoop.fs.Path(self._folder, f"{number:012d}"))
        try:
            return json.loads(bytes(self._spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def latest(self) -> tuple[int, Any]:
        """Number and content of the version in force; ``(0, None)`` before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, None)

    def history(self) -> list[tuple[int, Any]]:
        """All versions, ascending."""
        return [(number, self.read(number)) for number in self.numbers()]

    def publish(self, number: int, content: Any) -> bool:
        """Publish version ``number``; False if it exists already."""
        self._files.mkdirs(self._folder)
        written = self._hadoop.fs.Path(self._folder, f"_{uuid.uuid4().hex}")
        stream = self._files.create(written, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        context = self._hadoop.fs.FileContext.getFileContext(written.toUri(), self._spark._jsc.hadoopConfiguration())
        rename = getattr(self._hadoop.fs, "Options$Rename")
        options = self._spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE  # refuses an existing target
        try:
            context.rename(self._files.makeQualified(written), self._files.makeQualified(self._hadoop.fs.Path(self._folder, f"{number:012d}")), options)
        except Py4JJavaError as exc:
            self._files.delete(written, False)
            if "FileAlreadyExistsException" in str(exc.java_exception):
                return False
            raise
        return True

    def commit(self, make: Callable[[int, Any], tuple[Any, Made]]) -> Made:
        """Publish what ``make`` gives for the version in force, ``(content, result)``, and return the result.

        If another writer was first, ``make`` is asked again for its version, so no commit is lost. Content None
        publishes nothing.
        """
        for _ in range(ATTEMPTS):
            number, current = self.latest()
            content, result = make(number, current)
            if content is None or self.publish(number + 1, content):
                return result
        raise ReadError(f"{ATTEMPTS} attempts to publish a version lost to other writers", path=self._root)
