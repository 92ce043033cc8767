"""Manifests: which folders make up a table after a commit.

Data is written into folders of its own name first. A manifest then names all folders
that count, and is put in place by a rename, which fails if another attempt at the same
commit was faster. Readers take the latest manifest and read what it names, so they see
all of a commit or nothing, and never half of a rewrite.

Folders that a commit replaces are kept for ``keep_seconds``, so that a reader that has
listed them can finish.
"""

import json
import time
import uuid

from pyspark.sql import SparkSession


class Manifests:
    """Numbered manifests below one folder. Numbers rise, but need not be consecutive."""

    def __init__(self, spark: SparkSession, root: str, keep_seconds: float):
        self.spark, self.root, self.keep_seconds = spark, root.rstrip("/"), keep_seconds

    def new_folder(self, number: int) -> str:
        """A folder name that no other attempt uses, relative to the root."""
        return f"data-{number}-{uuid.uuid4().hex}"

    def latest(self) -> tuple[int, dict]:
        """Number and content of the last commit; (-1, {}) before the first."""
        while True:
            number = max(self._numbers(), default=-1)
            if number < 0:
                return -1, {}
            try:
                return number, json.loads(read_text(self.spark, self._path(number)))
            except FileNotFoundError:
                continue  # a later commit has come and cleaned up

    def commit(self, number: int, content: dict, replaced: list[str]) -> bool:
        """Puts a manifest in place; False if the number is taken.

        ``replaced`` are folders that the content names no longer.
        """
        now = time.time()
        _, before = self.latest()
        old = [*before.get("replaced", []), *([name, now] for name in replaced)]
        gone = [name for name, since in old if now - since > self.keep_seconds]
        content = {**content, "replaced": [e for e in old if e[0] not in gone]}
        hidden = f"{self.root}/.manifest-{uuid.uuid4().hex}"
        write_text(self.spark, hidden, json.dumps(content))
        if not rename(self.spark, hidden, self._path(number)):
            delete(self.spark, hidden)
            return False
        for name in gone:
            delete(self.spark, f"{self.root}/{name}")
        # The last two stay: a reader may have listed the one before the latest.
        for other in sorted(self._numbers())[:-2]:
            delete(self.spark, self._path(other))
        return True

    def _path(self, number: int) -> str:
        return f"{self.root}/manifest-{number}"

    def _numbers(self) -> list[int]:
        names = children(self.spark, self.root)
        return [int(n.removeprefix("manifest-")) for n in names if n.startswith("manifest-")]


# The file system of a path, whatever store it is on.


def _on(spark: SparkSession, path: str, action):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return action(target.getFileSystem(spark._jsc.hadoopConfiguration()), target)


def children(spark: SparkSession, path: str) -> list[str]:
    def names(fs, p):
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    return _on(spark, path, names)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of a folder, as the file system states it."""
    return _on(spark, path, lambda fs, p: fs.getContentSummary(p).getLength())


def delete(spark: SparkSession, path: str) -> None:
    _on(spark, path, lambda fs, p: fs.delete(p, True))


def rename(spark: SparkSession, path: str, to: str) -> bool:
    """False if the target exists."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    # The local file system would overwrite; a store without rename copies.
    return _on(spark, path, lambda fs, p: not fs.exists(target) and fs.rename(p, target))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    def put(fs, p):
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    _on(spark, path, put)


def read_text(spark: SparkSession, path: str) -> str:
    def get(fs, p):
        if not fs.exists(p):
            raise FileNotFoundError(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    return _on(spark, path, get)
