"""Keyed state as a table of immutable parts and a pointer that names the live ones.

A merge writes only what is new, as a part of its own, and then moves the pointer by one
atomic rename.  A reader follows the pointer and lets the last row of each key win, so it
sees the state before or after a merge, never half of one or none.  A writer that dies
leaves at most a part that no pointer names.  When there are many parts they are folded
into one; what the pointer before named stays until the next fold, for readers under way.
One writer at a time is assumed, as ``foreachBatch`` has it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from voxloom.operators.sequence import keep_last

POINTER = "_CURRENT"


class Files:
    """The few file operations that pointers and checkpoints need, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self.path(name)):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a small file under another name and rename it over the old one, atomically."""
        fresh = f"{name}.{uuid.uuid4().hex[:8]}"
        self.fs.mkdirs(self.path(""))
        out = self.fs.create(self.path(fresh), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        options = self.jvm.org.apache.hadoop.fs.Options
        kinds = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        kinds[0] = getattr(options, "Rename").OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(self.path(fresh), self.path(name), kinds)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _pointer(files: Files) -> dict:
    text = files.read(POINTER)
    return json.loads(text) if text else {"parts": [], "before": []}


def read_state(spark: SparkSession, path: str, schema: str | StructType, key: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key; no rows where nothing was merged yet."""
    parts = _pointer(Files(spark, path))["parts"]
    if not parts:
        return spark.createDataFrame([], schema)
    return keep_last(spark.read.schema(schema).parquet(*[f"{path}/{p}" for p in parts]), key, order)


def merge_into(spark: SparkSession, path: str, new: DataFrame, key: list[str], order: list[Column], most_parts: int = 16) -> DataFrame:
    """Upsert: the last row of each key stays.  Merging the same rows again changes nothing.
    The cost follows the new rows; once in ``most_parts`` merges the whole state is folded."""
    files = Files(spark, path)
    old, schema = _pointer(files), new.schema
    parts = old["parts"]
    made = f"part-{uuid.uuid4().hex[:12]}"
    if len(parts) + 1 < most_parts:
        keep_last(new, key, order).write.parquet(f"{path}/{made}")
        files.replace(POINTER, json.dumps({"parts": [*parts, made], "before": old["before"]}))
    else:
        state = spark.read.schema(schema).parquet(*[f"{path}/{p}" for p in parts]).unionByName(new)
        keep_last(state, key, order).write.parquet(f"{path}/{made}")
        files.replace(POINTER, json.dumps({"parts": [made], "before": parts}))
        for p in old["before"]:
            files.delete(p)
    return read_state(spark, path, schema, key, order)
