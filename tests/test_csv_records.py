"""CSV with line breaks in fields, cut into splits of any size, against the reader that reads whole files."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from tillgrain.schema import REQUIRED
from tillgrain.session import scratch_path
from tillgrain.sources import csv_records, ingest

ODD = ["plain", "", 'with "quotes"', "a,b", "two\nlines", "x\n\ny", 'q",\n"', "\n", '5" pipe', "é\n€ \U0001f600",
       "ends with\n", '"', '""', "a\r\nb", "line,\n\"quoted\",\nlines\n" * 3]


def written(folder, name, rows, newline="\n", header=tuple(REQUIRED)):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="", encoding="utf-8") as out:
        made = csv.writer(out, lineterminator=newline)
        made.writerow(header)
        made.writerows(rows)
    return str(folder)


def rows_of(df):
    return sorted(tuple(v or "" for v in r) for r in df.collect())


def table(seed, n=400):
    draw = random.Random(seed)
    return [(str(k), *[draw.choice(ODD) for _ in range(6)], "end") for k in range(n)]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [512, 1 << 27])
def test_any_split(spark, tmp_path, newline, size):
    rows = table(1)
    path = written(tmp_path / "in", "part.csv", rows, newline)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        found = ingest.read_csv(spark, path)
        assert rows_of(found) == sorted(rows)
        if size == 512:
            assert spark.read.text(path).rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_same_as_the_reader_of_whole_files(spark, tmp_path):
    path = written(tmp_path / "in", "a.csv", table(2))
    whole = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    assert rows_of(ingest.read_csv(spark, path)) == rows_of(whole)


def test_files_of_both_kinds_and_orders(spark, tmp_path):
    broken, plain = table(3, 50), [(str(k), *["x", 'say "hi"', "a,b", "", "1", "2"], "end") for k in range(1000, 1040)]
    path = written(tmp_path / "in put", "a b.csv", broken)
    written(tmp_path / "in put", "b.csv", plain)
    turned = [tuple(reversed(r)) for r in table(4, 30)]
    written(tmp_path / "in put", "c.csv", turned, header=tuple(reversed(REQUIRED)))
    assert rows_of(ingest.read_csv(spark, path)) == sorted([*broken, *plain, *table(4, 30)])
    open_files, others = csv_records.files_with_open_lines(spark, path)
    assert [f.rsplit("/", 1)[1] for f in open_files] == ["a b.csv", "c.csv"]
    assert [f.rsplit("/", 1)[1] for f in others] == ["b.csv"]


def test_lines_as_maps(spark):
    def state(line, inside):
        return spark.range(1).select(F.lit(line).rlike(
            csv_records.STAYS if inside else csv_records.OPENS)).first()[0]
    for line, outside, inside in [('a,b', False, True), ('a,"b', True, False), ('"a""', True, False),
                                  ('"a"', False, False), ('a "quoted" b', False, False), ('x",y', False, False),
                                  ('x","y', True, True), ('x,"y""z",w', False, False), ("", False, True),
                                  ('x"', False, False), ('"', True, False), ('""', False, True)]:
        assert (state(line, False), state(line, True)) == (outside, inside), line


def test_long_lines_and_an_open_end(spark, tmp_path):
    rows = [(str(k), "word " * 40_000 + "\n" + 'a""b' * 10, *[""] * 5, "end") for k in range(3)]
    path = written(tmp_path / "in", "a.csv", rows)
    assert rows_of(ingest.read_csv(spark, path)) == sorted(rows)
    with open(tmp_path / "in" / "a.csv", "a") as out:
        out.write('9,"never closed,\nmore')
    found = {r["Invoice"]: r["StockCode"] for r in ingest.read_csv(spark, path).collect()}
    assert len(found) == 4 and found["9"].startswith("never closed,")


def test_nothing_but_a_header(spark, tmp_path):
    path = written(tmp_path / "in", "a.csv", [])
    assert ingest.read_csv(spark, path).count() == 0
    assert ingest.read_csv(spark, path, line_breaks=False).columns == REQUIRED


def test_trusted_files_are_read_once(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([tuple(str(k) for k in range(8))], REQUIRED).write.csv(path, header=True)
    assert ingest.read_csv(spark, path, line_breaks=False).first()["Invoice"] == "0"
