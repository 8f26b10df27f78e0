"""Helpers that the operators of this package share: inputs, intermediate tables, word patterns."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from spark.checkpoint.dir.

    Where it is unset, a temporary folder is set as the session's own, on a local master only: the
    machines of a cluster would each write to another disk.
    """
    found = spark.conf.get("spark.checkpoint.dir", "")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spanmill-')}"
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Tables that this process has written in the shared folder, in order.
_written: list[str] = []


def table_path(spark: SparkSession, label: str) -> str:
    """A new path for a table in the shared folder."""
    _written.append(f"{shared_dir(spark)}/tables/{label}-{uuid.uuid4().hex}")
    return _written[-1]


def tables_since(count: int = 0) -> list[str]:
    """The tables written in the shared folder after the first count of them."""
    return _written[count:]


def drop_tables(spark: SparkSession, paths: list[str], keep: DataFrame | None = None) -> None:
    """Delete tables of the shared folder, but for those that keep reads.

    For when nothing else that reads them is left to be computed. Absent tables are passed over.
    """
    kept = {f.rpartition("/")[0].rpartition("/")[2] for f in keep.inputFiles()} if keep is not None and paths else set()
    for path in paths:
        if path.rpartition("/")[2] not in kept:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
            if path in _written:
                _written.remove(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    It cuts the lineage, survives the loss of any executor, and keeps columns prunable.
    """
    spark = df.sparkSession
    path = table_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def nested(docs: DataFrame, **columns: Column) -> DataFrame:
    """The given columns beside _row, which holds all columns of docs: no name can clash. unnested() undoes it."""
    return docs.select(F.struct("*").alias("_row"), *[c.alias(k) for k, c in columns.items()])


def unnested(rows: DataFrame, **changed: Column) -> DataFrame:
    """The columns of _row, with new values for some."""
    names = rows.schema["_row"].dataType.names
    return rows.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in names])


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
