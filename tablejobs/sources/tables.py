"""Tables written as Parquet folders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tablejobs.session import work_dir


def _read_back(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_table(df: DataFrame, path: str) -> DataFrame:
    """Query result to a new table; an existing one is an error."""
    df.write.mode("errorifexists").parquet(path)
    return _read_back(df, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """A result that several later steps read, written once to the shared folder. Lost executors do not lose it."""
    return create_table(df, work_dir(df.sparkSession, label))


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Query result in place of a table. A result that still reads ``path`` is refused, before anything is removed.

    The result is written beside the table and takes its place when it is whole: a failed write leaves the old table as it
    was. Between the two renames no table has the name; readers of the old files must have ended.
    """
    folder = f"{path.rstrip('/')}/"
    if any(folder in file for file in df.inputFiles()):
        raise ValueError(f"the result to be written reads {path}")
    mark = uuid.uuid4().hex
    new, old = f"{folder[:-1]}.new-{mark}", f"{folder[:-1]}.old-{mark}"
    df.write.mode("errorifexists").parquet(new)
    jvm = df.sparkSession._jvm
    place, fresh, kept = (jvm.org.apache.hadoop.fs.Path(p) for p in (folder[:-1], new, old))
    files = place.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf())
    existed = files.exists(place)
    if existed and not files.rename(place, kept):
        raise OSError(f"{path} can't be moved away; the result is in {new}")
    if not files.rename(fresh, place):
        if existed:
            files.rename(kept, place)
        raise OSError(f"{new} can't take the place of {path}")
    if existed:
        files.delete(kept, True)
    return _read_back(df, path)


def append_rows(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("append").parquet(path)
    return _read_back(df, path)


def clustered_write(df: DataFrame, path: str, *by: str) -> DataFrame:
    """Table physically ordered by ``by``, so that row-group statistics skip most of it.

    Range partitioning over all the columns also cuts through a single hot first id.
    """
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("errorifexists").parquet(path)
    return _read_back(df, path)


def bucketed_write(df: DataFrame, name: str, path: str, buckets: int, by: str, *sort: str) -> DataFrame:
    """Catalog table bucketed by one id: later joins and groupings on it need no shuffle. One file per bucket."""
    (
        df.repartition(buckets, by)
        .write.bucketBy(buckets, by)
        .sortBy(by, *sort)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def temp_table(df: DataFrame, name: str) -> DataFrame:
    """Session-scoped result used by several later statements: kept in memory or on disk, and visible to SQL by name."""
    kept = df.persist()
    kept.createOrReplaceTempView(name)
    return kept
