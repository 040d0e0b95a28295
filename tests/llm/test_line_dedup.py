"""Line dedup against a plain version, on edge rows, long texts and an empty table."""

import collections

import pytest

from tillgrain.llm import linededup

from tests.llm.conftest import ROWS

BLANK = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(BLANK).translate(UPPER)


def plain(rows, least=2):
    """(id, text) -> (lines, dropped, kept); rows without an id are one document after all others."""
    held = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                held[key(line)].add((i is None, i or 0))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < least or min(held[key(x)]) == (i is None, i or 0)]
        out.append((i, text, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(docs, **more):
    return sorted(map(tuple, linededup.remove_lines(docs, **more).collect()), key=str)


MADE = [
    (1, "A common line here\nonly in one\n\nshort\nA common line here"),
    (2, "  a COMMON line here\t\r\nshort\nsecond text, kept\n"),
    (3, "Éclair au chocolat\nshort\nA common line here"), (4, "éclair au chocolat"), (5, "ÉCLAIR AU CHOCOLAT"),
    (6, "\n\n\n"), (7, "A common line here"), (7, "other text of seven\nA common line here"),
    (8, "other text of seven"), (None, "other text of seven\nnobody's line"), (None, "nobody's line"),
    (9, "nobody's line "), (10, "nine chars\nnine char"), (11, "NINE CHARS\nnine char"), (12, "𝒜𝒜𝒜𝒜𝒜𝒜𝒜𝒜𝒜"), (13, "𝒜𝒜𝒜𝒜𝒜𝒜𝒜𝒜𝒜"),
    (14, "\n".join(f"line number {k % 700}" for k in range(5000))), (15, "\n".join(f"Line Number {k}" for k in range(2000))),
    (16, "\x1cA common line here"),
]


@pytest.mark.parametrize("least", [2, 3])
def test_lines_as_by_hand(spark, least):
    docs = spark.createDataFrame(MADE, "doc_id long, text string")
    assert found(docs, least_documents=least) == plain(MADE, least)


def test_edge_rows(docs, nothing):
    assert found(docs) == plain([(i, t) for i, t, *_ in ROWS])
    assert linededup.remove_lines(nothing).count() == 0


def test_other_columns_may_clash(spark):
    docs = spark.createDataFrame([(*r, "x", 1, "h") for r in MADE],
                                 "doc_id long, text string, lines string, copy int, hash string")
    assert found(docs) == plain(MADE)


def test_no_python_and_hot_lines_counted_before_the_shuffle(spark):
    docs = spark.createDataFrame(MADE, "doc_id long, text string")
    plan = linededup.remove_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    shared = linededup.shared_lines(linededup._entries(
        docs.selectExpr("doc_id", "text", "xxhash64(text) AS copy"), 10))._jdf.queryExecution().toString()
    assert "partial_" in shared
