"""Reading and writing of the stage tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from voxloom.operators.incremental import pending
from voxloom.operators.sequence import first_seen_index

# Required columns of a catalog.
REQUIRED = ("title", "narrator", "audio_path")


def require(df: DataFrame, columns) -> DataFrame:
    """The table itself, or an error that names the columns it lacks."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def catalog(df: DataFrame, root: str = "", position: str | None = None) -> DataFrame:
    """Catalog with ``full_path``, ``title_index`` and ``narrator_index``.

    A null narrator is ``unknown``.  Indexes number values by first appearance in the
    order of ``position`` (the row order of the file by default).
    """
    df = require(df, REQUIRED)
    pos = F.col(position) if position else F.monotonically_increasing_id()
    d = df.withColumn("_pos", pos).withColumn("narrator", F.coalesce("narrator", F.lit("unknown")))
    d = d.withColumn("full_path", F.concat(F.lit(root.rstrip("/") + "/" if root else ""), "audio_path"))
    d = first_seen_index(first_seen_index(d, "title", "_pos", "title_index"), "narrator", "_pos", "narrator_index")
    return d.drop("_pos")


def read_catalog_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_catalog(spark: SparkSession, path: str, root: str = "") -> DataFrame:
    return catalog(read_catalog_file(spark, path), root)


def read_stage(
    spark: SparkSession, pattern: str, schema: str | StructType, name_column: str | None = None, recursive: bool = True, completed: DataFrame | None = None, required: str | None = None
) -> DataFrame:
    """CSV files of a stage under one schema; the folder's name becomes a column if asked
    for.  Unreadable files are skipped, empty text is null.

    ``recursive`` looks at all depths below the path, otherwise the pattern itself says
    which files are meant (``*/name.csv``: one level).  Folders named in ``completed`` (a
    column ``name_column``) and rows whose ``required`` column is null are left out.
    """
    d = spark.read.option("header", True).option("recursiveFileLookup", recursive).option("ignoreCorruptFiles", True).option("multiLine", True).option("escape", '"').schema(schema).csv(pattern)
    if name_column:
        d = d.withColumn(name_column, F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))
    if completed is not None:
        d = pending(d, completed, [name_column])
    return d.dropna(subset=[required]) if required else d


def union_tables(*tables: DataFrame) -> DataFrame:
    """All rows of tables whose columns may differ; what a table lacks is null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def embedding_tables(spark: SparkSession, root: str) -> DataFrame:
    """``folder, path``: of each folder's CSV files whose name contains "embedding" and not
    "backup", the first by name.  Only the listing is read, no file."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(root).select("path")
    name = F.lower(F.regexp_extract("path", r"([^/]+)$", 1))
    d = d.where(F.contains(name, F.lit("embedding")) & ~F.contains(name, F.lit("backup")))
    return d.groupBy(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder")).agg(F.min("path").alias("path"))


def read_samples(spark: SparkSession, path: str, key: list[str] | None = None) -> DataFrame:
    """Evaluation pairs; rows without one of the key columns are dropped if asked for."""
    d = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return d.dropna(subset=key) if key else d


def first_present(df: DataFrame, *columns: str, default: str = "") -> Column:
    """The first of the columns that exists, decided by the schema."""
    return next((F.col(c) for c in columns if c in df.columns), F.lit(default))


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "append") -> None:
    """A stage's table, a folder per book; ``overwrite`` replaces only the books written."""
    w = df.write.mode(mode).partitionBy(by)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def segment_rows(df: DataFrame, path: str = "segment_path", text: str = "final_transcript") -> DataFrame:
    """Segments as they are recorded: without any text there is no audio file, so no path."""
    from voxloom.operators.text import has_text

    return df.withColumn(path, F.when(has_text(F.col(text)), F.col(path)))


def write_manifest(df: DataFrame, path: str, single_file: bool = False) -> None:
    """The release as CSV; one file only where the reader needs it."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_outputs(df: DataFrame, path: str) -> None:
    """An evaluation's rows as CSV with a header, replacing what an earlier run wrote."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_labels(local: DataFrame, global_: DataFrame, summary: DataFrame, root: str, by: str) -> None:
    """Both label trees, a folder per book each, and the table of global speakers."""
    write_partitioned(local, f"{root}/local", by, "overwrite")
    write_partitioned(global_, f"{root}/global", by, "overwrite")
    summary.write.mode("overwrite").parquet(f"{root}/speakers")


def master_table(parts: DataFrame, key: str = "file_path", order: list[str] | None = None, folder: str = "audiobook_folder", name: str = "filename") -> DataFrame:
    """One table of all per-folder results: the first row of each key, sorted by folder and
    file name."""
    from voxloom.operators.sequence import keep_first

    return keep_first(parts, [key], [F.col(c) for c in order or [folder, name]]).orderBy(folder, name)
