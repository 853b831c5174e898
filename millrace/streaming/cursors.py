"""Where each stream's feeder stands."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import files
from millrace.tables.table import TableStore

FEEDERS = "feeder_cursors"
EXTRACTS = "extract_cursors"
SCHEMA = "source string, stream string, cursor_path string, updated_at timestamp, number long"


class CursorTable:
    """State ``source, stream, cursor_path, updated_at``, one row per stream. The cursor is a file
    path for feeders and a value of the cursor field for extracts.

    A stream's cursor is a small numbered file that must not exist yet, so that of two writers one
    fails; the file before it goes after that. Moving a cursor starts no Spark job.
    """

    def __init__(self, store: TableStore, name: str = FEEDERS):
        self.store = store
        self.root = f"{store.root}/{name}"

    def read(self) -> DataFrame:
        spark = self.store.spark
        if not files.exists(spark, self.root):
            return spark.createDataFrame([], SCHEMA).drop("number")
        found = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").json(self.root)
        last = found.groupBy("source", "stream").agg(F.max_by(F.struct("cursor_path", "updated_at"), "number").alias("last"))
        return last.select("source", "stream", "last.*").filter(F.col("cursor_path").isNotNull())

    def _numbers(self, source: str, stream: str) -> list[int]:
        names = files.child_names(self.store.spark, self._folder(source, stream))
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _folder(self, source: str, stream: str) -> str:
        return f"{self.root}/{source}/{stream}"

    def get(self, source: str, stream: str) -> str | None:
        return self._last(source, stream).get("cursor_path")

    def boundary(self, source: str, stream: str) -> str | None:
        """Folder with the records that were seen at the cursor's value, if it was kept."""
        return self._last(source, stream).get("boundary")

    def _last(self, source: str, stream: str) -> dict:
        numbers = self._numbers(source, stream)
        if not numbers:
            return {}
        path = f"{self._folder(source, stream)}/{numbers[-1]:012d}.json"
        return json.loads(files.first_line(self.store.spark, path))

    def set(self, source: str, stream: str, cursor_path: str | None, boundary: str | None = None) -> None:
        spark, folder = self.store.spark, self._folder(source, stream)
        numbers = self._numbers(source, stream)
        number = numbers[-1] + 1 if numbers else 1
        now = self.store.clock().astimezone(dt.timezone.utc).isoformat()
        row = {"source": source, "stream": stream, "cursor_path": cursor_path, "updated_at": now, "number": number, "boundary": boundary}
        files.create_text(spark, f"{folder}/{number:012d}.json", [json.dumps(row)])
        for old in numbers:
            files.delete(spark, f"{folder}/{old:012d}.json")

    def clear(self, source: str, stream: str) -> None:
        """Forget a stream, so that its next run reads all its files again."""
        self.set(source, stream, None)

    def freshness(self) -> DataFrame:
        """All cursors, the one that moved last first."""
        return self.read().orderBy(F.col("updated_at").desc())
