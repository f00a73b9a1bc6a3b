"""A numbered commit log for table locations: put-if-absent of the next number, conflicts instead of lost updates.

Each publication of a location is one small JSON file ``_commits/<number>``.  A
writer notes the number it started from, writes its data, and then commits the
next number.  Only one writer can create that file; another one, whose data was
made without knowing of it, gets ``ConcurrentPublish``.  Readers take the entry
with the highest number, so they see whole versions only.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_DIGITS = 20


class ConcurrentPublish(RuntimeError):
    """Another writer published the location since this one started."""


@dataclass(frozen=True)
class Commit:
    number: int
    entry: dict


def file_system(spark: SparkSession, path: str):
    """``(hadoop fs package, file system, path)`` of a location."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return hadoop, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def put_if_absent(spark: SparkSession, path: str, body: str) -> bool:
    """Create a file with its whole content unless it exists; whether this call created it.

    The content goes to a file of its own first.  Giving it the name is one
    atomic step that fails where the name is taken: a rename without overwrite,
    or a hard link on a local file system, whose rename would replace.
    """
    hadoop, fs, target = file_system(spark, path)
    draft = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(body.encode())
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            nio = spark._jvm.java.nio.file
            nio.Files.createLink(nio.Path.of(target.toUri().getPath(), _strings(spark)), nio.Path.of(draft.toUri().getPath(), _strings(spark)))
        else:
            context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
            options = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
            options[0] = hadoop.Options.Rename.NONE
            context.rename(draft, target, options)
    except Py4JJavaError as exc:
        if "FileAlreadyExists" in exc.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)
    return True


def _strings(spark: SparkSession):
    return spark._sc._gateway.new_array(spark._jvm.java.lang.String, 0)


class CommitLog:
    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.folder = spark, f"{location.rstrip('/')}/_commits"

    def numbers(self) -> list[int]:
        _, fs, folder = file_system(self.spark, self.folder)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, number: int) -> Commit:
        _, fs, path = file_system(self.spark, f"{self.folder}/{number:0{_DIGITS}d}")
        stream = fs.open(path)
        try:
            body = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Commit(number, json.loads(body))

    def latest(self) -> Commit | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def last_number(self) -> int:
        return max(self.numbers(), default=0)

    def commit(self, base: int, entry: dict) -> int:
        """Commit number ``base + 1``; ``ConcurrentPublish`` if another writer has it."""
        number = base + 1
        if not put_if_absent(self.spark, f"{self.folder}/{number:0{_DIGITS}d}", json.dumps(entry)):
            raise ConcurrentPublish(f"{self.folder}: number {number} was committed meanwhile: {self.read(number).entry}")
        return number

    def forget(self, number: int) -> None:
        _, fs, path = file_system(self.spark, f"{self.folder}/{number:0{_DIGITS}d}")
        fs.delete(path, False)
