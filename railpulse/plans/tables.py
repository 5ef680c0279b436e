"""Stored tables of a warehouse folder."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


class SchemaDrift(ValueError):
    """New rows do not have the columns of the table they are for."""


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None) -> DataFrame | None:
    """A stored table, or None before the first write.

    The schema is given: a partition column full of digits would otherwise come
    back as numbers. Tables without partitions may do without.
    """
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in (missing.getCondition() or ""):
            return None
        raise


def require_schema(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """``df`` in the column order of ``schema``; any other difference is an error."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in schema}
    if have != want:
        changed = sorted(
            n for n in have.keys() | want.keys() if have.get(n) != want.get(n)
        )
        raise SchemaDrift(f"{table}: columns differ from the stored table: {', '.join(changed)}")
    return df.select(*schema.fieldNames())


def overwrite(df: DataFrame, path: str, by: str | None = None) -> None:
    """Write a table anew, one folder per value of ``by``."""
    if by is None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        return
    (
        df.hint("rebalance", by).write.mode("overwrite")
        .option("partitionOverwriteMode", "static").partitionBy(by).parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace the partitions that occur in ``df`` and no others.

    ``df`` may read the table it is written to: its files are removed when the
    job commits, after all of them were read.
    """
    (
        df.hint("rebalance", by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    )


def replace_all(df: DataFrame, held: DataFrame, path: str, by: str) -> None:
    """Replace the partitions of ``held``, stored rows at ``path``, by ``df``; those without a new row go.

    ``df`` is stored elsewhere. Folders are told from the files of ``held``. Their
    list, one entry for a date that lost all its rows, passes through the driver.
    """
    new = df.select(F.col(by).alias("new")).distinct()
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    emptied = (
        held.select(by, folder.alias("folder")).distinct().join(new, F.col(by).eqNullSafe(F.col("new")), "left_anti")
    )
    gone = [unquote(r["folder"]) for r in emptied.select("folder").toLocalIterator()]
    replace_partitions(df, path, by)
    for found in gone:
        remove(df.sparkSession, found)


def append(df: DataFrame, path: str, by: str) -> None:
    df.hint("rebalance", by).write.mode("append").partitionBy(by).parquet(path)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table and go on from its files.

    Cuts the lineage, so that what follows neither repeats the work nor loses it
    with an executor.
    """
    schema = df.schema
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark's file systems have it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
