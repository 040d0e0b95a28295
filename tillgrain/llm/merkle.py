"""Merkle manifest: a digest tree over each source's rows, a tree over the sources, and a proof per row.

Time-forward processing.  Every node has a label (tree, level, place); a node is computed when
the digests of its children have arrived, and sends its own to its parent.  What waits is held
in a priority queue in the order of labels.  The queue is external: nodes are cut into pages of
`ARITY ** HEIGHT` consecutive ones with the levels above them.  Inside a page messages wait on a
heap; those that leave it (one per page) are stored rows, which the next sweep
shuffles and sorts by label.  So a tree of n leaves takes log(n) / log(729) sweeps up.  Then the
sweeps run back: the page of a parent hands each child the rest of its proof, from there to the root.

A proof is a string: a level each from the leaf to the root, joined by `;`, and per level the digests of
the siblings before and after the node, parted by `|`.  `folded` recomputes the root from it.

Defined results: rows with equal ids are ordered by their digests, rows without an id come first in their
source; equal rows are leaves of their own.  A null source is a source of its own, before all others.  An
empty table has no proofs and no root.  Columns that are not digested don't matter.
"""

from __future__ import annotations

import heapq
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

ARITY = 3
HEIGHT = 6              # levels of a page
PAGE = ARITY ** HEIGHT
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def row_digest(values: list[Column]) -> Column:
    """Hex sha256 over the values: byte count, colon and value each, or a dash for null."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in text]).cast("binary"), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf's hex digest and its proof."""
    def up(digest, level):
        return F.sha2(F.concat(F.substring_index(level, "|", 1), digest,
                               F.substring_index(level, "|", -1)).cast("binary"), 256)
    return F.when(proof == "", leaf).otherwise(F.aggregate(F.split(proof, ";"), leaf, up))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level and left to right, as one string."""
    return F.translate(proof, "|;", "")


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds `place` (from 0) and `total` within each tree; no tree is sorted in one task.

    Rows are sorted over ranges of (tree, order), and a range is numbered from the counts of
    those before it.  There is one count per range and tree.
    """
    ranges = materialize(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                         .withColumn("part", F.spark_partition_id()), "ranges")
    tree = Window.partitionBy("tree")
    counts = ranges.groupBy("tree", "part").agg(F.count("*").alias("n")).select(
        "tree", "part", F.sum("n").over(tree).alias("total"), F.coalesce(F.sum("n").over(
            tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order))
    return ranges.withColumn("place", inside - 1).join(counts, ["tree", "part"]).withColumn(
        "place", F.col("place") + F.col("before")).drop("part", "before")


def page_nodes(leaves: list[str], levels: int) -> list[list[str]]:
    """The digests of a page by level; `leaves` are level 0.

    A heap hands each node the digests that its children have sent, in the order of labels.
    """
    nodes = [list(leaves)] + [[] for _ in range(levels)]
    queue = [(1, k // ARITY, k, digest) for k, digest in enumerate(leaves)] if levels else []
    while queue:
        level, place = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, place):
            children.append(heapq.heappop(queue)[3])
        digest = sha256("".join(children).encode()).hexdigest()
        nodes[level].append(digest)
        if level < levels:
            heapq.heappush(queue, (level + 1, place // ARITY, place, digest))
    return nodes


def levels_of(total: int, size: int) -> int:
    """Levels above a page's lowest: all of them if its tree goes on, else up to one node."""
    if total > PAGE:
        return HEIGHT
    levels = 0
    while size > 1:
        size, levels = -(-size // ARITY), levels + 1
    return levels


PAGE_ROW = "tree string, page long, total long, digests binary, claimed binary, ids binary, unknown int, top string"


def _pack(digests) -> bytes:
    return bytes.fromhex("".join(digests))


def _unpack(raw: bytes) -> list[str]:
    text = raw.hex()
    return [text[k:k + 64] for k in range(0, len(text), 64)]


def _up(batches):
    """Rows in the order of (tree, page, place) become page rows, each with the page's top node."""
    def finished(key, parts):
        rows = pd.concat(parts) if len(parts) > 1 else parts[0]
        digests, total = rows["digest"].tolist(), int(rows["total"].iloc[0])
        return (*key, total, _pack(digests), _pack(rows["claimed"].tolist()),
                rows["id"].to_numpy(np.int64).tobytes(), int((~rows["known"]).sum()),
                page_nodes(digests, levels_of(total, len(digests)))[-1][0])

    names = [x.split()[0] for x in PAGE_ROW.split(", ")]
    key, parts, done = None, [], []
    for batch in batches:
        for at, rows in batch.groupby(["tree", "page"], sort=False):
            if at != key:
                if parts:
                    done.append(finished(key, parts))
                key, parts = at, []
            parts.append(rows)
        if done:
            yield pd.DataFrame(done, columns=names)
            done = []
    if parts:
        yield pd.DataFrame([finished(key, parts)], columns=names)


def _proof(part: str, rest: str) -> str:
    return f"{part};{rest}" if rest else part


DOWN_ROW = "tree string, place long, id long, known boolean, digest string, claimed string, subroot string, proof string"


def _down(batches):
    """A page and the rest of its top's proof become a proof per lowest node."""
    for batch in batches:
        for page in batch.itertuples(index=False):
            lowest = _unpack(page.digests)
            nodes = page_nodes(lowest, levels_of(page.total, len(lowest)))
            proofs = [page.proof]
            for level in reversed(nodes[:-1]):
                below = []
                for k in range(len(level)):
                    first = k - k % ARITY
                    below.append(_proof("".join(level[first:k]) + "|" + "".join(level[k + 1:first + ARITY]),
                                        proofs[k // ARITY]))
                proofs = below
            size = len(lowest)
            yield pd.DataFrame({
                "tree": page.tree, "place": page.page * PAGE + np.arange(size),
                "id": np.frombuffer(page.ids, np.int64), "known": np.arange(size) >= page.unknown,
                "digest": lowest, "claimed": _unpack(page.claimed), "subroot": page.subroot, "proof": proofs})


def _climb(rows: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(the stored pages of every sweep, (tree, floor, top): the top of each tree and the sweep it ended in).

    `rows`: (tree, place, total, digest, claimed, id, known).
    """
    floors, tops = [], []
    while True:
        paged = rows.withColumn("page", F.floor(F.col("place") / PAGE))
        pages = materialize(paged.repartition("tree", "page").sortWithinPartitions("tree", "page", "place")
                            .select("tree", "page", "place", "total", "digest", "claimed", "id", "known")
                            .mapInPandas(_up, PAGE_ROW), "pages")
        ended = F.col("total") <= PAGE
        tops.append(pages.filter(ended).select("tree", F.lit(len(floors)).alias("floor"), "top"))
        floors.append(pages)
        if pages.filter(~ended).isEmpty():
            break
        rows = pages.filter(~ended).select(
            "tree", F.col("page").alias("place"), F.ceil(F.col("total") / PAGE).alias("total"),
            F.col("top").alias("digest"), F.col("top").alias("claimed"), F.lit(0).cast("long").alias("id"),
            F.lit(True).alias("known"))
    ends = tops[0]
    for more in tops[1:]:
        ends = ends.unionByName(more)
    return floors, ends


def _descend(floors: list[DataFrame], ends: DataFrame) -> DataFrame:
    """A proof per lowest node; `ends`: (tree, floor, subroot, proof) of the trees' tops."""
    rest = None
    for floor in reversed(range(len(floors))):
        own = ends.filter(F.col("floor") == floor).select("tree", F.lit(0).cast("long").alias("page"), "subroot", "proof")
        rest = own if rest is None else own.unionByName(
            rest.select("tree", F.col("place").alias("page"), "subroot", "proof"))
        rest = floors[floor].join(rest, ["tree", "page"]).mapInPandas(_down, DOWN_ROW)
        if floor:
            rest = materialize(rest, "proofs")
    return rest


def manifest(leaves: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, claimed, subroot, root, proof) for every row of `leaves`.

    `leaves`: (doc_id long, source, leaf, claimed), digests as hex text.  `claimed` is a digest
    that is only carried along, so that a later state of the row can be held against the proof.
    """
    # Null sorts before all sources, and an empty name right after it.
    rows = leaves.select(
        F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("")).alias("tree"),
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNotNull().alias("known"),
        F.col("leaf").alias("digest"), F.coalesce("claimed", "leaf").alias("claimed"))
    floors, tops = _climb(placed(rows, ["known", "id", "digest"]))
    tops = materialize(tops, "subroots")
    forest, ends = _climb(placed(tops.select(
        F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("top").alias("digest"),
        F.col("top").alias("claimed"), F.lit(0).cast("long").alias("id"), F.lit(True).alias("known")), ["of"]))
    root = ends.first()
    root = root["top"] if root else None
    above = _descend(forest, ends.select("tree", "floor", F.col("top").alias("subroot"), F.lit("").alias("proof")))
    # Subroots are told apart by their place among the sources.
    order = materialize(placed(tops.withColumn("of", F.col("tree")).withColumn("tree", F.lit("")), ["of"]), "order")
    ways = materialize(order.select(F.col("of").alias("tree"), "floor", F.col("top").alias("subroot"), "place").join(
        above.select("place", "proof"), "place").drop("place"), "ways")
    found = _descend(floors, ways)
    return found.select(
        F.when(F.col("known"), F.col("id")).alias("doc_id"),
        F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("source"),
        F.col("digest").alias("leaf"), "claimed", "subroot", F.lit(root).cast("string").alias("root"), "proof")


def document_leaves(docs: DataFrame, changed_text: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, claimed) of `documents`; `claimed` has `changed_text` for the text."""
    values = [F.col(c) for c in COLUMNS]
    claimed = row_digest([*values[:-1], changed_text]) if changed_text is not None else F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       row_digest(values).alias("leaf"), claimed.alias("claimed"))
