"""CSV files whose quoted fields may hold line breaks, read by many tasks.

A line alone does not say whether it begins inside a quoted field.  But a line maps either state
at its beginning, outside or inside a field, to a state at its end, and such maps can be joined.  So
lines are read as text, which splits anywhere; every split joins the maps of its lines; the few
splits of a file, in their order, tell in which state each of them begins; then each split puts its own
lines together to records, and a record that crosses splits is joined from its pieces.

A file in which no line opens a field beyond its end needs none of this and goes to the plain reader.
Quotes inside a field are doubled; lines end with a line feed, which a carriage return may precede.
"""

from __future__ import annotations

from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize

FEW_SPLITS = 100_000      # splits (a path and a number) that are broadcast at most, counted first

# Parts of a line: what is inside quotes, and a whole field with its comma.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?+,'
OPENS = rf'\A(?:{_FIELD})*+"{_INSIDE}\z'                                  # outside before, inside after
STAYS = rf'\A{_INSIDE}(?:\z|"[^,]*+,(?:{_FIELD})*+"{_INSIDE}\z)'          # inside before and after


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, split, line, opens, stays, at), in the order of each split."""
    text = spark.read.option("lineSep", "\n").text(paths)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                       F.col("value").alias("line"), F.col("value").rlike(OPENS).alias("opens"),
                       F.col("value").rlike(STAYS).alias("stays"), F.monotonically_increasing_id().alias("at"))


def _split_maps(batches):
    """Per split: whether it ends inside a field, from outside and from inside at its beginning."""
    key, state = None, (False, True)
    for batch in batches:
        for file, split, opens, stays in zip(batch["file"], batch["split"], batch["opens"], batch["stays"]):
            if (file, split) != key:
                if key:
                    yield pd.DataFrame([(*key, *state)], columns=["file", "split", "outside", "inside"])
                key, state = (file, split), (False, True)
            state = tuple(stays if s else opens for s in state)
    if key:
        yield pd.DataFrame([(*key, *state)], columns=["file", "split", "outside", "inside"])


def _begins(splits: pd.DataFrame) -> pd.DataFrame:
    """The state at the beginning of each split of a file."""
    splits = splits.sort_values("split")
    state, begins = False, []
    for outside, inside in zip(splits["outside"], splits["inside"]):
        begins.append(state)
        state = inside if state else outside
    return splits.assign(begins=begins)[["file", "split", "begins"]]


PIECE = "file string, split long, place int, kind string, text string"


def _records(batches):
    """Whole records, and the pieces at either end of a split that belong to a longer one.

    kind: `whole`, `end` (of a record that began before), `start` (of one that goes on) or
    `middle` (the whole split is inside one record).
    """
    key, inside, open_lines, begun_before, place, out = None, False, [], False, 0, []

    def finish():
        if key and open_lines:
            return [(*key, place, "middle" if begun_before else "start", "\n".join(open_lines))]
        return []

    for batch in batches:
        for file, split, line, opens, stays, begins in batch.itertuples(index=False):
            if (file, split) != key:
                out += finish()
                key, inside, open_lines, begun_before, place = (file, split), begins, [], begins, 0
            open_lines.append(line)
            inside = stays if inside else opens
            if not inside:
                out.append((*key, place, "end" if begun_before else "whole", "\n".join(open_lines)))
                open_lines, begun_before, place = [], False, place + 1
        if out:
            yield pd.DataFrame(out, columns=["file", "split", "place", "kind", "text"])
            out = []
    out = finish()
    if out:
        yield pd.DataFrame(out, columns=["file", "split", "place", "kind", "text"])


def _joined(pieces: pd.DataFrame) -> pd.DataFrame:
    """Records of a file that cross splits, from two pieces per split at most."""
    out, parts = [], []
    for row in pieces.sort_values(["split", "place"]).itertuples(index=False):
        if row.kind == "start":
            parts = [row]
        else:
            parts.append(row)
        if row.kind == "end":
            out.append((*parts[0][:3], "whole", "\n".join(p.text for p in parts)))
            parts = []
    if parts:                                   # a field that is never closed: the rest of the file
        out.append((*parts[0][:3], "whole", "\n".join(p.text for p in parts)))
    return pd.DataFrame(out, columns=["file", "split", "place", "kind", "text"])


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, split, place, text): the records of CSV files, header lines included."""
    lines = _lines(spark, paths)
    # One row per split; the splits of a file are a few, whatever the number of its lines.
    maps = materialize(lines.drop("line", "at").mapInPandas(
        _split_maps, "file string, split long, outside boolean, inside boolean"), "csv-splits")
    begins = materialize(maps.groupBy("file").applyInPandas(
        _begins, "file string, split long, begins boolean"), "csv-begins")
    # Few splits begin inside a field; the lines stay where they are read, in their order.
    inside = begins.filter("begins")
    if inside.count() <= FEW_SPLITS:
        known = lines.join(F.broadcast(inside), ["file", "split"], "left")
    else:
        known = lines.join(inside, ["file", "split"], "left").repartition("file", "split").sortWithinPartitions(
            "file", "split", "at")
    return stitched(known.select("file", "split", "line", "opens", "stays", F.coalesce(
        "begins", F.lit(False)).alias("begins")).mapInPandas(_records, PIECE))


def stitched(pieces: DataFrame) -> DataFrame:
    pieces = materialize(pieces, "csv-pieces")
    crossing = pieces.filter("kind <> 'whole'").groupBy("file").applyInPandas(_joined, PIECE)
    return pieces.filter("kind = 'whole'").unionByName(crossing).select("file", "split", "place", "text")


def files_with_open_lines(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(files where some line ends inside a field, all others); the names of a folder's files."""
    found = _lines(spark, [path]).groupBy("file").agg(F.max("opens").alias("opens")).collect()
    return (sorted(unquote(r["file"]) for r in found if r["opens"]),
            sorted(unquote(r["file"]) for r in found if not r["opens"]))


def read_records(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """The rows of files that have line breaks in fields, all columns as text; headers are left out."""
    schema = ", ".join("`" + c.replace("`", "``") + "` STRING" for c in columns)
    header = (F.col("split") == 0) & (F.col("place") == 0)
    body = records(spark, paths).filter(~header).select(
        F.regexp_replace("text", r"\r\z", "").alias("text")).filter("trim(text) <> ''")
    return body.select(F.from_csv("text", F.lit(schema), {"escape": '"'}).alias("row")).select("row.*")
