"""What earlier runs finished or failed at, as small JSON documents in a shared folder.

Each document is replaced by an atomic rename.  Keys are for units of work that a person
would list - books, folders - so the documents stay small; what grows with the data is
skipped by anti joins against the written tables instead.
"""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.sources.state import Files


def file_key(name: str, path: str, modified: float | None = None) -> str:
    """Key of a unit of work: it changes when the file behind it does."""
    return hashlib.md5(":".join([name, path] + ([] if modified is None else [str(modified)])).encode()).hexdigest()


class Checkpoint:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)
        self.completed, self.failed = self._load("completed.json"), self._load("failed.json")

    def _load(self, name: str) -> dict:
        try:
            return json.loads(self.files.read(name) or "{}")
        except ValueError:  # a broken document counts as none: the work is done again
            return {}

    def _save(self) -> None:
        self.files.replace("completed.json", json.dumps(self.completed, indent=1))
        self.files.replace("failed.json", json.dumps(self.failed, indent=1))

    def is_completed(self, key: str) -> bool:
        return key in self.completed

    def is_failed(self, key: str) -> bool:
        return key in self.failed

    def result(self, key: str):
        return self.completed[key]["result"]

    def mark_completed(self, key: str, result=None) -> None:
        self.completed[key] = {"result": result, "at": datetime.now(timezone.utc).isoformat()}
        self.failed.pop(key, None)
        self._save()

    def mark_failed(self, key: str, error: str) -> None:
        self.failed[key] = {"error": error, "at": datetime.now(timezone.utc).isoformat()}
        self._save()

    def clear_failed(self, key: str) -> None:
        if self.failed.pop(key, None) is not None:
            self._save()

    def left(self, todo: DataFrame, key: str = "key", retry_failed: bool = False) -> DataFrame:
        """Rows of ``todo`` not completed, nor failed unless those are tried again."""
        done = [*self.completed, *([] if retry_failed else self.failed)]
        return todo.where(~F.coalesce(F.col(key).isin(done), F.lit(False))) if done else todo
