"""The manifest against a plain tree, over several pages, on edge rows and an empty table."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tillgrain.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + 3])) for k in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, at):
    out = []
    for level in levels[:-1]:
        first = at - at % 3
        out.append(("".join(level[first:at]), "".join(level[at + 1:first + 3])))
        at //= 3
    return out


def plain(rows):
    """rows: (doc_id, source, leaf, claimed) -> (doc_id, source, leaf, claimed, subroot, root, proof), sorted."""
    trees = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        trees.setdefault(r[1], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    lower = {s: climb([r[2] for r in trees[s]]) for s in order}
    upper = climb([lower[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for at, r in enumerate(trees[s]):
            steps = way(lower[s], at) + way(upper, place)
            out.append((*r, lower[s][-1][0], upper[-1][0], ";".join("|".join(x) for x in steps)))
    return sorted(out, key=str)


LEAVES = "doc_id long, source string, leaf string, claimed string"


def found(leaves):
    return sorted(map(tuple, merkle.manifest(leaves).collect()), key=str)


def test_many_shapes(spark):
    draw = random.Random(5)
    sizes = {None: 1, "": 2, "a": 3, "B": 10, "é": 28, "z\U0001f600": 81, "zz": 5}
    rows = [(draw.randrange(1 << 40), s, sha(f"{s}{k}"), sha(f"changed {k}") if k % 2 else sha(f"{s}{k}"))
            for s, n in sizes.items() for k in range(n)]
    assert found(spark.createDataFrame(rows, LEAVES)) == plain(rows)


@pytest.mark.parametrize("height", [1, 2])
def test_trees_over_many_pages(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "PAGE", 3 ** height)
    # Workers import the module anew, so what they call is bound to the size here.
    levels = merkle.levels_of
    for name in ("_up", "_down"):
        monkeypatch.setattr(merkle, name, bound(getattr(merkle, name), height))
    assert levels(10 ** 6, 1) == height
    rows = [(k, "hot" if k % 3 else f"s{k % 21}", sha(str(k)), sha(str(k))) for k in range(500)]
    assert found(spark.createDataFrame(rows, LEAVES)) == plain(rows)


def bound(work, height):
    def run(batches):
        from tillgrain.llm import merkle as there
        there.HEIGHT, there.PAGE = height, 3 ** height
        try:
            yield from work(batches)
        finally:
            there.HEIGHT, there.PAGE = 6, 3 ** 6
    return run


def test_page_nodes_follow_labels():
    leaves = [sha(str(k)) for k in range(20)]
    assert merkle.page_nodes(leaves, 3) == climb(leaves)
    assert merkle.page_nodes(leaves[:1], 0) == [leaves[:1]]
    alone = merkle.page_nodes(leaves[:1], 2)
    assert alone == [leaves[:1], [sha(leaves[0])], [sha(sha(leaves[0]))]]


def test_edge_rows_and_tampering(spark, docs, nothing):
    rows = docs.withColumn("source", F.when(F.col("doc_id") < 5, F.col("lang"))).withColumn(
        "n_chars", F.length("text")).withColumns({"tree": F.lit(3), "page": F.lit("x"), "place": F.lit(None)})
    leaves = merkle.document_leaves(rows, F.translate("text", "\n", ""))
    want = [(r.doc_id, r.source, row_leaf([r.doc_id, r.source, r.lang, r.n_chars, r.text]),
             row_leaf([r.doc_id, r.source, r.lang, r.n_chars, r.text and r.text.replace("\n", "")]))
            for r in rows.collect()]
    made = merkle.manifest(leaves)
    assert sorted(map(tuple, made.collect()), key=str) == plain(want)
    judged = made.select("leaf", "claimed", "root", merkle.folded(F.col("leaf"), F.col("proof")).alias("kept"),
                         merkle.folded(F.col("claimed"), F.col("proof")).alias("changed"),
                         merkle.siblings(F.col("proof")).alias("all"), "proof").collect()
    assert all(r.kept == r.root and (r.changed == r.root) == (r.leaf == r.claimed) for r in judged)
    assert any(r.leaf != r.claimed for r in judged)
    assert all(r["all"] == r.proof.replace("|", "").replace(";", "") for r in judged)
    assert merkle.manifest(leaves.limit(0)).count() == 0
    assert merkle.manifest(merkle.document_leaves(
        nothing.withColumns({"source": F.lit("a"), "n_chars": F.lit(1)}))).count() == 0


def test_a_lone_row_is_its_own_root(spark):
    leaf = sha("x")
    made = merkle.manifest(spark.createDataFrame([(1, "a", leaf, None)], LEAVES))
    assert found(spark.createDataFrame([(1, "a", leaf, leaf)], LEAVES)) == plain([(1, "a", leaf, leaf)])
    row = made.select("*", merkle.folded(F.col("claimed"), F.col("proof")).alias("up")).first()
    assert (row.root, row.proof, row.up) == (leaf, "", leaf)
