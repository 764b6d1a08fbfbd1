"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: Rows of a file, where the number of rows is known beforehand.
FILE_ROWS = 50_000


def scratch_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, else (local runs only) a temporary folder."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="roundhouse-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: What was written in this process and isn't deleted yet.
_written: list[tuple[SparkSession, str]] = []


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there is deleted when the process ends."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write df once to the shared folder and read it back: a cut lineage that survives lost executors.

    rows: a number of rows that df won't exceed, if it is known. Then a small table is written as few files, not as one per shuffle partition.
    """
    path = scratch_folder(df.sparkSession, name)
    (df if rows is None else df.coalesce(1 + rows // FILE_ROWS)).write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def forget(*tables: DataFrame) -> None:
    """Delete the files of stored tables that nothing reads any more."""
    gone = {t.stored_at for t in tables}
    for spark, path in [x for x in _written if x[1] in gone]:
        _delete(spark, path)
    _written[:] = [x for x in _written if x[1] not in gone]


def mark() -> int:
    """A point in time, for forget_since."""
    return len(_written)


def forget_since(start: int, keep: DataFrame) -> None:
    """Delete what was stored since mark() gave `start`, but for `keep`."""
    for spark, path in _written[start:]:
        if path != keep.stored_at:
            _delete(spark, path)
    _written[start:] = [x for x in _written[start:] if x[1] == keep.stored_at]


@atexit.register
def _forget_all() -> None:
    """Delete what is left when the process ends, if its session still runs; one that was stopped or lost leaves its tables."""
    try:
        while _written:
            spark, path = _written.pop()
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
    except (Py4JError, OSError):  # the JVM is gone
        _written.clear()
