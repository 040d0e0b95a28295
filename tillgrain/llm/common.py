"""What the operators of this subpackage share: tables, ordering, bounded broadcasts."""

from __future__ import annotations

import math
import os
import pathlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BATCH_ROWS = 1000            # rows of whole texts that travel to Python at once
BROADCAST_ROWS = 500_000     # narrow rows (ids) that are broadcast at most, counted first


def prepare(spark: SparkSession) -> None:
    """Small batches of Arrow and of Parquet's reader, as rows hold whole texts; Python workers look for this
    package where the driver has it (beyond what they have installed or were sent)."""
    root = str(pathlib.Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)
    for key in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"):
        if int(spark.conf.get(key)) > BATCH_ROWS:
            spark.conf.set(key, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A few rows of whole numbers as a table.

    Lists would pass through plain Python workers, which stay beside those of the Arrow functions, with a daemon of their own.
    """
    columns = zip(*rows) if rows else [[] for _ in names]
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)}))


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null texts as empty ones, whatever else the table has."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not have, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_remainder(modulus: int) -> Column:
    """crc32 of the id as text, by modulus; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def total_bytes(docs: DataFrame) -> int:
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def parts_for(size: float, each: float) -> int:
    return max(1, math.ceil(size / each))


def hinted(df: DataFrame, rows: int) -> DataFrame:
    """`df` marked for broadcasting when its counted rows are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def running_start(rows: DataFrame, part: str, order: list[str], value: str, name: str) -> DataFrame:
    """Adds `name`: the sum of `value` over all rows before, by (part, order).

    Rows of a part are summed in one task, so parts must be of bounded size; the
    parts themselves (one row each) are the only thing that is summed as a whole.
    """
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(F.col(part).alias("_part")).agg(F.sum(value).alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_before"))
    return rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(
        F.broadcast(before), F.col(part) == F.col("_part")).withColumn(
        name, F.col("_before") + F.col("_inside")).drop("_part", "_before", "_inside")
