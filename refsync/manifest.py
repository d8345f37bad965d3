"""Small documents that say what is valid, each version committed by one rename.

Data is written first, into folders nobody reads yet. Naming them in the next
version of a manifest is what makes them visible, all at once. A version is a
file that is complete before it gets its name, and a name is given once: of two
writers that want the same version one is told that it came too late. This asks
for a file system that renames a file in one step and refuses to replace one,
as HDFS and local folders do.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Listing, reading, creating and removing small files, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._hadoop = self._jvm.org.apache.hadoop
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")

    def _path(self, name: str = ""):
        return self._hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _system(self):
        return self._path().getFileSystem(self._conf)

    def names(self) -> list[str]:
        """What lies directly below the root; nothing if there is no such folder."""
        system = self._system()
        if not system.exists(self._path()):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(self._path()))

    def read(self, name: str) -> str:
        stream = self._system().open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Make a file with all of its text at once; False if the name is taken."""
        system, draft = self._system(), self._path(f".{name}.{uuid.uuid4().hex}")
        stream = system.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        options = self._hadoop.fs.Options.Rename
        context = self._hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        if not draft.toUri().getScheme():
            context = self._hadoop.fs.FileContext.getFileContext(self._conf)
        none = self._array(options, [options.NONE])
        try:
            context.rename(draft, self._path(name), none)
            return True
        except Py4JJavaError as error:
            if system.exists(draft):
                system.delete(draft, False)
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                return False
            raise

    def _array(self, kind, values):
        from pyspark import SparkContext

        made = SparkContext._gateway.new_array(kind, len(values))
        for index, value in enumerate(values):
            made[index] = value
        return made

    def remove(self, name: str) -> None:
        self._system().delete(self._path(name), True)


@dataclass(frozen=True)
class Version:
    """A committed document; number 0 is the empty one before the first commit."""

    number: int
    content: dict


class Manifest:
    """The versions of a document below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.files = Files(spark, root)

    def numbers(self) -> list[int]:
        found = (name.removesuffix(".json") for name in self.files.names() if name.endswith(".json"))
        return sorted(int(name) for name in found if name.isdigit())

    def read(self, number: int) -> Version:
        return Version(number, json.loads(self.files.read(_name(number))))

    def latest(self) -> Version:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else Version(0, {})

    def commit(self, after: Version, content: dict) -> bool:
        """Make ``content`` the version after ``after``; False if another writer was first."""
        return self.files.create(_name(after.number + 1), json.dumps(content, sort_keys=True))


def _name(number: int) -> str:
    return f"{number:020d}.json"
