"""Session helpers: local sessions, and tables that cut lineage in a shared folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_spaces: dict[str, str] = {}
_private: list[str] = []


def local_session(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("voxloom")
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.driver.host": "127.0.0.1",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A scan that has fewer splits than the cluster has cores - one small file, one row
    group - dealt to all cores by a hash of its keys, ahead of much work per row.  A scan
    of as many splits or more is left as it is, so a large table is not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """This application's folder for intermediate tables.

    It lies in ``spark.checkpoint.dir``, which every executor sees.  Where that is unset, a
    local session takes a temporary folder of this machine; a session with executors of
    its own is refused, since each of them would write where the others cannot read.
    """
    app = spark.sparkContext.applicationId
    if app not in _spaces:
        base = spark.conf.get("spark.checkpoint.dir", "") or ""
        if not base:
            if not re.match(r"local($|\[)", spark.sparkContext.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="voxloom-")
            _private.append(base[7:])
        _spaces[app] = f"{base.rstrip('/')}/voxloom-{app}-{uuid.uuid4().hex[:8]}"
    return _spaces[app]


def materialize(df: DataFrame, label: str = "t", by: str | None = None) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back: lineage ends here, and
    a lost executor costs a read of that file instead of the work behind it.  ``by`` makes
    a folder per value of a column, so that a filter on it reads no other."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the table behind a materialized DataFrame that nothing reads any more."""
    spark = df.sparkSession
    own = re.compile(rf"(.*/voxloom-{re.escape(spark.sparkContext.applicationId)}-[0-9a-f]+/[^/]+)/")
    for name in {m[1] for p in df.inputFiles() if (m := own.match(p))}:
        _delete(spark, name)


def release_part(df: DataFrame, part: str) -> None:
    """Delete one folder (``column=value``) of a table that was materialized ``by`` a column."""
    spark = df.sparkSession
    own = re.compile(rf"(.*/voxloom-{re.escape(spark.sparkContext.applicationId)}-[0-9a-f]+/[^/]+)/")
    for name in {m[1] for p in df.inputFiles() if (m := own.match(p))}:
        _delete(spark, f"{name}/{part}")


def release_all(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; no query's result may be read afterwards."""
    if folder := _spaces.pop(spark.sparkContext.applicationId, None):
        _delete(spark, folder)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _clean() -> None:
    import shutil

    for path in _private:
        shutil.rmtree(path, ignore_errors=True)
