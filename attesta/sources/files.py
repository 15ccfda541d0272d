"""Small files that tell what belongs to a version: put in place by one rename, read whole."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has committed the version meanwhile."""


class Versions:
    """Numbered JSON files in a folder. A number is given once: of two writers the second fails, and readers see a file whole or not at all."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._conf = spark, folder.rstrip("/"), spark._jsc.hadoopConfiguration()

    def path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))

    def fs(self):
        return self.path().getFileSystem(self._conf)

    def names(self) -> list[str]:
        """What lies in the folder; nothing if it is not there."""
        return [x.getPath().getName() for x in (self.fs().listStatus(self.path()) if self.fs().exists(self.path()) else [])]

    def numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.names() if n.endswith(".json"))

    def read(self, number: int | None = None) -> dict | None:
        known = self.numbers()
        if not known or number is not None and number not in known:
            return None
        r = self.fs().open(self.path(f"{known[-1] if number is None else number:010d}.json"))
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(r)).decode())
        finally:
            r.close()

    def put(self, number: int, content: dict) -> None:
        fs, temp = self.fs(), self.path(f".{uuid.uuid4().hex}")
        w = fs.create(temp)
        try:
            w.write(bytearray(json.dumps(content).encode()))
        finally:
            w.close()
        options = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(options, 1)
        none[0] = options.NONE
        try:
            self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf).rename(temp, self.path(f"{number:010d}.json"), none)
        except Exception as e:
            fs.delete(temp, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"version {number} is there already") from None
            raise

    def drop(self, number: int) -> None:
        self.fs().delete(self.path(f"{number:010d}.json"), False)
