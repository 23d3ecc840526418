"""Versions of a set of tables: a refresh is written beside the last one and becomes visible at once.

Under a root, `data/<refresh>/<table>` holds files that are never changed, and `commits/<version>.json`
names the folder and the schema of every table of a version. Readers go by the newest commit, so they
see all tables of one refresh or of the one before, never a mixture and never half a table. A run that
dies leaves files that no commit names; `clean_up` removes them when they are old enough.
"""

from __future__ import annotations

import json
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from waybill.sources.storage import write_table

_COMMIT = re.compile(r"(\d{10})\.json")


class Folder:
    """A folder in the store that its path names, whichever Hadoop file system that is."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._path = path.rstrip("/")
        self._store = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.fs.Path(f"{self._path}/{name}" if name else self._path)

    def names(self, name: str) -> list[str]:
        """What is directly below; nothing if the folder is not there."""
        if not self._store.exists(self._at(name)):
            return []
        return [entry.getPath().getName() for entry in self._store.listStatus(self._at(name))]

    def read(self, name: str) -> str:
        source = self._store.open(self._at(name))
        try:
            return bytes(self._hadoop.io.IOUtils.readFullyToByteArray(source)).decode()
        finally:
            source.close()

    def write_new(self, name: str, text: str) -> bool:
        """Put a whole file in place, if there is none of that name; whether it was put there."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        out = self._store.create(self._at(draft), True)
        try:
            out.write(text.encode())
        finally:
            out.close()
        placed = not self._store.exists(self._at(name)) and self._store.rename(self._at(draft), self._at(name))
        if not placed:
            self.remove(draft)
        return placed

    def remove(self, name: str) -> None:
        self._store.delete(self._at(name), True)


class Refresh:
    """One run's tables; nobody sees them before `commit`."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        # Named by its start, as not every store knows when a folder was changed.
        self._folder = f"data/{int(time.time())}-{uuid.uuid4().hex}"
        self._tables: dict[str, dict] = {}

    def write(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Write one table and scan it; for the later steps of the same run."""
        path = f"{self._folder}/{name}"
        written = write_table(df, f"{self._root}/{path}", partition_by)
        self._tables[name] = {"path": path, "schema": df.schema.jsonValue()}
        return written

    def commit(self) -> int:
        """Make all tables written so far the newest version; returns its number."""
        return _publish(self._spark, self._root, self._tables)


def _publish(spark: SparkSession, root: str, tables: dict[str, dict]) -> int:
    folder = Folder(spark, root)
    while True:
        version = max(versions(spark, root), default=0) + 1
        # Another run may take the number first; the next one is tried then.
        if folder.write_new(f"commits/{version:010d}.json", json.dumps({"tables": tables})):
            return version


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    found = [_COMMIT.fullmatch(name) for name in Folder(spark, root).names("commits")]
    return sorted(int(commit[1]) for commit in found if commit)


def _tables(spark: SparkSession, root: str, version: int | None) -> dict[str, dict]:
    known = versions(spark, root)
    if version is None and known:
        version = known[-1]
    if version not in known:
        raise FileNotFoundError(f"{root}: no version {version or ''} among {known}")
    return json.loads(Folder(spark, root).read(f"commits/{version:010d}.json"))["tables"]


def read_tables(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """All tables of the newest version, or of the given one, by name."""
    frames = {}
    for name, entry in _tables(spark, root, version).items():
        schema = T.StructType.fromJson(entry["schema"])
        stored = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{entry['path']}")
        # The reader moves partition columns to the end; keep the order of the definition.
        frames[name] = stored.select(*schema.names)
    return frames


def roll_back(spark: SparkSession, root: str, version: int) -> int:
    """Make the tables of an older version the newest one again; no data is copied."""
    return _publish(spark, root, _tables(spark, root, version))


def clean_up(spark: SparkSession, root: str, keep: int = 2, min_age_hours: float = 24.0) -> list[str]:
    """Remove commits older than the last `keep` and data that no commit left names; returns the latter.

    Data of runs that began less than `min_age_hours` ago stays: they may not have named it yet, and a
    reader may still be at it.
    """
    folder = Folder(spark, root)
    known = versions(spark, root)
    # Commits go first: a version that is still listed always has its data.
    for version in known[:-keep] if keep else known:
        folder.remove(f"commits/{version:010d}.json")
    named = {
        entry["path"].split("/")[1]
        for version in versions(spark, root)
        for entry in _tables(spark, root, version).values()
    }
    before = time.time() - min_age_hours * 3600
    stale = [
        name for name in folder.names("data") if name not in named and int(name.split("-")[0]) <= before
    ]
    for name in stale:
        folder.remove(f"data/{name}")
    return stale
