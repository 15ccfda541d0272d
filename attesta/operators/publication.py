"""Publications that readers see whole: a new version is written beside the old one, read back and checked, and then named by one small file.

Below the root, ``versions`` holds a folder for each version and ``current`` numbered files, the last of which names the folder that is published. Whatever
fails before that file is there leaves the publication as it was; going back is one more file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import Versions
from .protect import PublishGuardError
from .records import publish


class Publication:
    """The publication below ``root``, a folder of any file system that Spark's driver and executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._current, self._folders = Versions(spark, f"{self.root}/current"), Versions(spark, f"{self.root}/versions")

    def versions(self) -> list[int]:
        return self._current.numbers()

    def folder(self, version: int | None = None) -> str | None:
        """Where a version lies, by default the one that is published; none if there is none."""
        entry = self._current.read(version)
        return entry and f"{self.root}/versions/{entry['folder']}"

    def items(self, version: int | None = None) -> DataFrame | None:
        """The items of a version, with the types with which they were published."""
        entry = self._current.read(version)
        return entry and self.spark.read.schema(entry["schema"]).json(f"{self.root}/versions/{entry['folder']}/items")

    def release(self, merged: DataFrame, generated_at: str, baseline: DataFrame | None = None, **rules) -> int:
        """Publishes merged listings, audited against ``baseline``, by default what is published now; gives the version.

        A release that is refused or fails leaves nothing behind, and one that another writer has overtaken is a ``Conflict``: what it was audited against is not published any more.
        """
        before = (self.versions() or [0])[-1]
        baseline = self.items(before) if baseline is None and before else baseline
        name = uuid.uuid4().hex
        folder, schema = f"{self.root}/versions/{name}", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in merged.drop("rejection_reasons").schema.fields)
        try:
            publish(merged, folder, generated_at, baseline, **rules)
            self._verify(folder, schema)
            self._current.put(before + 1, {"folder": name, "schema": schema})
        except BaseException:
            self._folders.fs().delete(self._folders.path(name), True)
            raise
        return before + 1

    def _verify(self, folder: str, schema: str) -> None:
        """What was written says the same in all its files."""
        items = self.spark.read.schema(schema).json(f"{folder}/items")
        n, keys = items.agg(F.count(F.lit(1)), F.count("identity_key")).first()
        said = self.spark.read.schema("rowCount long").json(f"{folder}/manifest").first()["rowCount"]
        envelope = self.spark.read.schema("count long, pipeline struct<rejected_count: long>").json(f"{folder}/payload").first()
        rejected = self.spark.read.text(f"{folder}/rejected").count()
        if not n == keys == said == envelope["count"] or rejected != envelope["pipeline"]["rejected_count"]:
            raise PublishGuardError(f"{n} items of {keys} keys were written where manifest and envelope say {said} and {envelope['count']}, and {rejected} rejected where {envelope['pipeline']['rejected_count']} are said")

    def roll_back(self, version: int | None = None) -> int:
        """Publishes an earlier version again, by default the one before the last; gives the new version."""
        known = self.versions()
        version = version if version is not None else known[-2] if len(known) > 1 else None
        entry = version is not None and self._current.read(version)
        if not entry:
            raise ValueError(f"there is no version {version} to go back to" if version is not None else "there is no version to go back to")
        self._current.put(known[-1] + 1, entry)
        return known[-1] + 1

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes all but the last ``keep`` versions, and the folders that none of those name: those of writers that were lost, too, so that none may be at work."""
        known = self.versions()
        for v in known[:-keep]:
            self._current.drop(v)
        used = {self._current.read(v)["folder"] for v in known[-keep:]}
        gone = [n for n in self._folders.names() if n not in used]
        for n in gone:
            self._folders.fs().delete(self._folders.path(n), True)
        return gone
