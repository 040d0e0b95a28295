"""Line dedup: a line that stands in several documents stays only in the first of them.

Normalised lines are exploded and hashed, the distinct documents of each hash are counted,
and the places of the lines to drop go back to their documents, which are put together again
by position.  All of it is DataFrame functions: no text leaves the JVM, and only hashes and
places are shuffled besides one pass of the texts.

Keys are compared by 128-bit hashes; equal hashes count as equal keys.

Defined results: a null text is an empty one, and has one empty line.  Rows that share an id
are one document: lines are never dropped for a copy under the same id, and equal rows get
equal results.  Rows without an id are one document, too, which comes after all others.
Columns other than `doc_id` and `text` are not looked at.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import attach
from ..session import materialize

LEAST_CHARS = 10       # code points of a key that can be dropped
LEAST_DOCUMENTS = 2    # documents that hold a key which is dropped from all but the first
BLANK = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, with A-Z (and no other letters) lower-cased."""
    bare = F.btrim(line, F.lit(BLANK))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _lines() -> Column:
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n")


def _entries(rows: DataFrame, least_chars: int) -> DataFrame:
    """(doc_id, copy, at, hash): each line whose key is long enough."""
    lines = rows.select("doc_id", "copy", F.posexplode(_lines()).alias("at", "line"))
    return lines.withColumn("key", line_key(F.col("line"))).filter(
        F.char_length("key") >= least_chars).select(
        "doc_id", "copy", "at", F.unhex(F.md5(F.col("key").cast("binary"))).alias("hash"))


def shared_lines(entries: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(hash, first, held): hashes of at least so many documents, the first one, and their lines.

    A frequent hash is counted where its lines are before anything is shuffled.
    """
    found = entries.groupBy("hash").agg(
        F.count_distinct("doc_id").alias("known"), F.max(F.col("doc_id").isNull().cast("int")).alias("unknown"),
        F.min("doc_id").alias("first"), F.count("*").alias("held"))
    return found.filter(F.col("known") + F.col("unknown") >= least_documents).select("hash", "first", "held")


def remove_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS
                 ) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, kept) for every row of `docs`."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("copy"))
    entries = _entries(rows, least_chars)
    shared = materialize(shared_lines(entries, least_documents), "shared-lines")
    # The lines of frequent hashes meet their answer without a shuffle by hash.
    marked = attach(entries, shared.withColumn("shared", F.lit(True)), "hash", "held")
    dropped = materialize(
        marked.filter(F.col("shared") & ~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "copy").agg(F.sort_array(F.collect_set("at")).alias("dropped")), "dropped-lines")
    gone = dropped.select(F.col("doc_id").alias("gone_id"), F.col("copy").alias("gone_copy"), "dropped")
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id"))
                       & (F.col("copy") == F.col("gone_copy")), "left")
    # A flag per line up to the last dropped one: runs that stay, each followed by one that goes.
    flags = F.flatten(F.transform("dropped", lambda at, k: F.concat(
        F.array_repeat(F.lit(True), at - F.when(k > 0, F.get(F.col("dropped"), k - 1)).otherwise(-1) - 1),
        F.array(F.lit(False)))))
    kept = F.array_join(F.zip_with(_lines(), flags, lambda line, stays: F.when(
        F.coalesce(stays, F.lit(True)), line)), "\n")
    return joined.select(
        "doc_id", "text", F.size(_lines()).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept"))
