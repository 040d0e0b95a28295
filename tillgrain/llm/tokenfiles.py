"""Token ids as Parquet list columns, in ascending order of the documents.

Ids go through a dictionary page, and beyond its size through delta encoding (format
version 2); row groups and pages are small and carry page indexes, so that readers fetch
the tokens of some documents, or the counts alone, without the rest.

Null and empty texts are documents of the end id alone.  Rows with one doc_id follow each
other in the order of their texts; a null doc_id comes first.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import parts_for, running_start, texts, total_bytes
from .tokenize import encoder

END_ID = 1
FILE_BYTES = 64 << 20            # text that goes to one file
FORMAT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(256 << 10),
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}
SCHEMA = "doc_id long, n_tokens int, ids array<int>"


def encoded(path: str, end_id: int = END_ID):
    """A function for mapInArrow: (doc_id, text, ...) to (doc_id, n_tokens, ids)."""
    def run(batches):
        for batch in batches:
            lists = encoder(path).encode(batch.column("text").to_pylist())
            size = np.fromiter((len(x) + 1 for x in lists), np.int32, len(lists))
            upto = np.concatenate([[0], np.cumsum(size, dtype=np.int32)]).astype(np.int32)
            flat = np.full(upto[-1], end_id, np.int32)
            keep = np.ones(len(flat), bool)
            keep[upto[1:] - 1] = False
            flat[keep] = np.concatenate(lists) if lists else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size),
                 pa.ListArray.from_arrays(pa.array(upto), pa.array(flat))],
                ["doc_id", "n_tokens", "ids"])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encodes whole texts and writes them by ascending doc_id; `part` numbers the files."""
    rows = texts(docs)
    rows = rows.repartitionByRange(parts_for(total_bytes(rows), FILE_BYTES), "doc_id",
                                   F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(encoded(tokenizer, end_id), SCHEMA).select(
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
        "doc_id", "n_tokens", "ids").write.options(**FORMAT).parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The stored documents; only the columns asked for are read."""
    df = spark.read.schema(f"part int, place long, {SCHEMA}").parquet(path)
    return df.select(*columns) if columns else df


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(place, doc_id, n_tokens, start): ids of all documents before, from the counts alone."""
    counts = read_tokens(spark, path, ["part", "place", "doc_id", "n_tokens"])
    return running_start(counts, "part", ["place"], "n_tokens", "start").drop("part")


def _checksums(batches):
    for batch in batches:
        lists = batch.column("ids")
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        upto = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        raw = memoryview(flat.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"),
             pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(upto[:-1], upto[1:])], pa.int64())],
            ["place", "ids_crc32"])


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(place, ids_crc32) of the stored ids as little-endian unsigned 32-bit integers."""
    return read_tokens(spark, path, ["place", "ids"]).mapInArrow(
        _checksums, "place long, ids_crc32 long")


def stored_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, all from the files."""
    return starts(spark, path).join(checksums(spark, path), "place").select(
        "doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")
