"""Hard negatives: rows of another label that score nearly as high with an anchor as its positives.

Maximum inner product becomes a nearest neighbour search by one more component per candidate,
sqrt(M - |x|^2), which gives all of them the same length; queries have 0 there.  Then a ball of centre
c and radius r around candidates bounds their scores with q by q.c - |q| r and q.c + |q| r.

Candidates are dealt to cells, by their nearest of a bounded number of pivots, and cells are cut into
pages of bounded size, so that a cell of copies is as many pages as it needs.  Each page becomes a cover tree:
the centres of a node's children are at least as far apart as the children's radii, which
shrink level by level.  A stored page is one row.

Anchors are packed in blocks per cell.  A block first asks one page of its own cell, which
gives each of its queries scores to beat; then it asks the pages of every cell whose ball may still hold
something.  In a page a block goes down level by level, leaves out nodes whose bounds lie
outside of all its windows or below what it has, and reads leaves best bound first, where all scores are exact.
A task holds one block and one page at a time.

Defined results: rows without id, label or vector, or with a null or non-finite component, take no
part.  Of rows that share an id the least by (label, vector) takes part.  A shorter vector counts as
filled up with zeros.  Ties go to the smaller id.  Scores are exact while they stay below 2^53.
"""

from __future__ import annotations

import collections

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

PAGE = 8192            # candidates of a page, on average
BLOCK = 512            # anchors of a block, on average
MAX_CELLS = 4096       # pivots: a sample of the candidates, of this size at most
LEAF = 256             # candidates of a node that is not split
CHILDREN = 48          # children of a node, at most; the radius of all children follows
SHRINK = 1.3           # a level's radius is at most its parent's by this, if so many children do

PAGE_ROW = "cell int, slot int, kind string, width int, ids binary, labels binary, points binary"


def usable(rows: DataFrame, id_column: str, label: Column, vector: Column, components: Column) -> DataFrame:
    """(id, label, vector): one row per id; `components` is made of `vector`, element by element."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) != float("inf")))
    return rows.filter(F.col(id_column).isNotNull() & label.isNotNull() & vector.isNotNull() & sound).select(
        F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"),
        components.cast("array<double>").alias("vector")).groupBy("id").agg(
        F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def _packed(points: np.ndarray) -> tuple[str, bytes]:
    kind = "<i2" if np.abs(points).max(initial=0) < 1 << 15 else "<f8"
    return kind, points.astype(kind).tobytes()


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    points = np.frombuffer(row.points, row.kind).astype(np.float64)
    return (np.frombuffer(row.ids, np.int64), np.frombuffer(row.labels, np.int64),
            points.reshape(-1, row.width) if row.width else points.reshape(-1, 0)[:0])


class CoverTree:
    """Nodes level by level: centre, radius, and children or a range of candidates.

    Candidates are in the order of the leaves; `children[k]` is empty for a leaf, whose candidates
    are those from `first[k]` to `last[k]`.
    """

    def __init__(self, points: np.ndarray, most: float):
        lift = np.sqrt(np.maximum(most - np.einsum("ij,ij->i", points, points), 0))
        lifted = np.column_stack([points, lift])
        self.centre, self.radius, self.children, self.first, self.last = [], [], [], [], []
        order, done = [], 0
        todo = [(None, np.arange(len(points)), 0, np.linalg.norm(lifted - lifted[:1], axis=1))]
        while todo:
            parent, some, centre, away = todo.pop()
            me = len(self.centre)
            if parent is not None:
                self.children[parent].append(me)
            reach = float(away.max(initial=0.0))
            self.centre.append(points[centre])
            self.radius.append(reach)
            self.children.append([])
            if len(some) <= LEAF or not reach:
                self.first.append(done)
                done += len(some)
                self.last.append(done)
                order.append(some)
                continue
            self.first.append(-1)
            self.last.append(-1)
            # Farthest point first: every centre is at least the final radius away from those before.
            heads, nearest, owner = [centre], away.copy(), np.zeros(len(some), np.int64)
            while len(heads) < CHILDREN and nearest.max() > reach / SHRINK:
                far = int(nearest.argmax())
                heads.append(some[far])
                there = np.linalg.norm(lifted[some] - lifted[some[far]], axis=1)
                closer = there < nearest
                owner[closer], nearest[closer] = len(heads) - 1, there[closer]
            if len(heads) == 1 or nearest.max() >= reach:
                # A level that can't shrink: what is left is read as leaves of bounded size.
                for k in range(0, len(some), LEAF):
                    part = some[k:k + LEAF]
                    todo.append((me, part, centre, away[k:k + LEAF]))
                continue
            for k, head in enumerate(heads):
                mine = owner == k
                todo.append((me, some[mine], head, nearest[mine]))
        self.order = np.concatenate(order)

    def packed(self) -> bytes:
        """Per node: radius, parent, first and last candidate, and centre."""
        parent = np.full(len(self.radius), -1.0)
        for k, below in enumerate(self.children):
            parent[below] = k
        return np.column_stack([self.radius, parent, self.first, self.last, self.centre]).tobytes()


class Page:
    """A stored cover tree that answers window queries."""

    def __init__(self, row):
        self.ids, self.labels, self.points = _unpacked(row)
        table = np.frombuffer(row.tree, np.float64).reshape(-1, 4 + row.width)
        self.radius, self.parent = table[:, 0], table[:, 1].astype(np.int64)
        self.first, self.last = table[:, 2].astype(np.int64), table[:, 3].astype(np.int64)
        self.centre = table[:, 4:]

    def levels(self):
        """The nodes by level, the root first."""
        depth = np.zeros(len(self.parent), np.int64)
        for k in range(1, len(depth)):
            depth[k] = depth[self.parent[k]] + 1
        return [np.flatnonzero(depth == d) for d in range(depth.max(initial=0) + 1)]

    def answer(self, ids, labels, queries, low, high, beat, same: bool, most: int):
        """(query, window, id, score): the first `most` of each window of each query in this page.

        `low`, `high`, `beat`: (query, window) bounds of a score, and what it must reach to matter;
        a window with low above high is empty.  `same`: candidates of the query's label, else of others.
        """
        windows = low.shape[1]
        length = np.linalg.norm(queries, axis=1)
        near = queries @ self.centre.T
        slack = 1e-9 * (np.abs(near) + length[:, None] * (self.radius + 1)) + 1e-6
        upper = near + length[:, None] * self.radius + slack
        lower = near - length[:, None] * self.radius - slack
        need = np.maximum(low, beat)
        alive = np.zeros(upper.shape, bool)
        leaves = []
        for nodes in self.levels():
            inside = np.zeros((len(queries), len(nodes)), bool)
            for w in range(windows):
                inside |= ((upper[:, nodes] >= need[:, w, None]) & (lower[:, nodes] <= high[:, w, None])
                           & (low[:, w] <= high[:, w])[:, None])
            inside &= alive[:, self.parent[nodes]] | (self.parent[nodes] < 0)
            alive[:, nodes] = inside
            leaves.append(nodes[(self.first[nodes] >= 0) & inside.any(0)])
        leaves = np.concatenate(leaves) if leaves else np.empty(0, np.int64)
        best = np.full((len(queries), windows, most), -np.inf)
        who = np.full((len(queries), windows, most), np.iinfo(np.int64).max)
        # Best first: the leaf with the highest bound of any query comes first.
        for leaf in leaves[np.argsort(-np.where(alive[:, leaves], upper[:, leaves], -np.inf).max(0), kind="stable")]:
            a, b = self.first[leaf], self.last[leaf]
            reach = np.maximum(need, best[:, :, -1])
            asked = np.flatnonzero(alive[:, leaf] & ((upper[:, leaf, None] >= reach) & (low <= high)).any(1))
            if not len(asked):
                continue
            scores = queries[asked] @ self.points[a:b].T
            fits = (self.labels[None, a:b] == labels[asked, None]) == same
            fits &= self.ids[None, a:b] != ids[asked, None]
            for w in range(windows):
                good = (fits & (scores >= reach[asked, w, None]) & (scores <= high[asked, w, None])
                        & (scores >= low[asked, w, None]))
                hit = good.any(1)
                if not hit.any():
                    continue
                rows = asked[hit]
                value = np.concatenate([best[rows, w], np.where(good[hit], scores[hit], -np.inf)], axis=1)
                name = np.concatenate([who[rows, w], np.broadcast_to(self.ids[a:b], (len(rows), b - a))], axis=1)
                first = np.lexsort((name, -value))[:, :most]
                best[rows, w] = np.take_along_axis(value, first, 1)
                who[rows, w] = np.take_along_axis(name, first, 1)
        query, window, k = np.nonzero(best > -np.inf)
        return query, window, who[query, window, k], best[query, window, k].astype(np.int64)


def _paged(rows: DataFrame, size: int, cells: DataFrame) -> DataFrame:
    """Adds `slot`: cells are cut into slots of about `size` rows; `cells` has a row per cell."""
    slots = cells.select("cell", F.ceil(F.col("n") / size).cast("int").alias("slots"))
    return rows.join(F.broadcast(slots), "cell").withColumn(
        "slot", F.pmod(F.xxhash64("id"), F.col("slots")).cast("int")).drop("slots")


def _pack_rows(width: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        points = _matrix(frame["vector"].tolist(), width)
        kind, raw = _packed(points)
        return pd.DataFrame([(int(frame["cell"].iloc[0]), int(frame["slot"].iloc[0]), kind, width,
                              frame["id"].to_numpy(np.int64).tobytes(),
                              frame["label"].to_numpy(np.int64).tobytes(), raw)],
                            columns=[x.split()[0] for x in PAGE_ROW.split(", ")])
    return run


def _plant(most: float):
    """Pages get their trees, and their rows the order of the leaves."""
    def run(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids, labels, points = _unpacked(row)
                tree = CoverTree(points, most)
                kind, raw = _packed(points[tree.order])
                yield pd.DataFrame([(row.cell, row.slot, kind, row.width, ids[tree.order].tobytes(),
                                     labels[tree.order].tobytes(), raw, tree.packed())],
                                   columns=[x.split()[0] for x in f"{PAGE_ROW}, tree binary".split(", ")])
    return run


class Index:
    """Candidates in pages, and the balls around their cells (at most MAX_CELLS, so they may be broadcast)."""

    def __init__(self, points: DataFrame):
        facts = points.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"), F.max(F.aggregate(
            "vector", F.lit(0.0), lambda total, x: total + x * x)).alias("most")).first()
        self.size, self.width, self.most = facts["n"], int(facts["width"] or 0), float(facts["most"] or 0)
        count = max(1, min(MAX_CELLS, -(-self.size // PAGE)))
        sample = points.orderBy(F.xxhash64("id"), "id").select("vector").limit(count).collect()
        self.pivots = _matrix([r["vector"] for r in sample], self.width)
        self.points = materialize(self._dealt(points), "dealt")
        cells = self.points.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("reach"))
        self.cells = materialize(cells, "cells")
        reach = {r["cell"]: r["reach"] for r in self.cells.collect()}       # MAX_CELLS rows at most
        self.held = np.array(sorted(reach), np.int64)
        self.reach = np.array([reach[c] for c in self.held.tolist()])
        self.pages = materialize(
            _paged(self.points, PAGE, self.cells).select("cell", "slot", "id", "label", "vector")
            .groupBy("cell", "slot").applyInPandas(_pack_rows(self.width), PAGE_ROW)
            .mapInPandas(_plant(self.most), f"{PAGE_ROW}, tree binary"), "cover-trees")

    def _dealt(self, points: DataFrame) -> DataFrame:
        pivots, most, width = self.pivots, self.most, self.width
        lift = np.sqrt(np.maximum(most - np.einsum("ij,ij->i", pivots, pivots), 0))

        def run(batches):
            for batch in batches:
                x = _matrix(batch["vector"].tolist(), width)
                if not len(x):
                    continue
                up = np.sqrt(np.maximum(most - np.einsum("ij,ij->i", x, x), 0))
                # All lifted vectors have length sqrt(most).
                product = x @ pivots.T + up[:, None] * lift
                cell = product.argmax(1)
                away = np.linalg.norm(np.column_stack([x, up]) - np.column_stack([pivots, lift])[cell], axis=1)
                yield batch.assign(cell=cell.astype(np.int32), away=away)
        return points.select("id", "label", "vector").mapInPandas(
            run, "id long, label long, vector array<double>, cell int, away double")

    def search(self, blocks: DataFrame, homes: DataFrame, same: bool, most: int) -> DataFrame:
        """(anchor, window, id, score, rank): the first `most` per window, over all pages.

        `blocks`: ASKED columns; `homes`: (cell, slot, anchor), the block of each anchor.
        """
        own = blocks.select("*", F.col("cell").alias("target"), F.lit(0).alias("target_slot"))
        first = materialize(self._asked(own, same, most), "seed-answers")
        beat = first.groupBy("anchor", "window").agg(F.min("score").alias("least"), F.count("*").alias("n")).filter(
            F.col("n") >= most).select("anchor", "window", "least")
        known = materialize(_with_beat(blocks, beat.join(homes, "anchor")), "asked")
        slots = self.cells.select(F.col("cell").alias("target"), F.ceil(F.col("n") / PAGE).cast("int").alias("slots"))
        routes = known.mapInPandas(_route(self), "cell int, slot int, target int").join(
            F.broadcast(slots), "target").select("cell", "slot", "target", F.explode(
                F.sequence(F.lit(0), F.col("slots") - 1)).alias("target_slot")).filter(
            (F.col("target") != F.col("cell")) | (F.col("target_slot") != 0))
        later = self._asked(known.join(routes, ["cell", "slot"]), same, most)
        rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id"))
        return materialize(first.unionByName(later).withColumn("rank", rank).filter(F.col("rank") <= most), "answers")

    def _asked(self, visits: DataFrame, same: bool, most: int) -> DataFrame:
        """Blocks meet the pages named by (target, target_slot): a row holds one of each."""
        pages = self.pages.select(F.col("cell").alias("target"), F.col("slot").alias("target_slot"), *[
            F.col(c).alias(f"page_{c}") for c in ("kind", "width", "ids", "labels", "points", "tree")])
        return visits.join(pages, ["target", "target_slot"]).mapInPandas(
            _visit(same, most), "anchor long, window long, id long, score long")


ASKED = f"{PAGE_ROW}, windows int, low binary, high binary, beat binary"
Stored = collections.namedtuple("Stored", "kind width ids labels points tree")


def _with_beat(blocks: DataFrame, beat: DataFrame) -> DataFrame:
    """Blocks with the scores that their windows have to reach."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return left
        row = left.iloc[0]
        ids = np.frombuffer(row.ids, np.int64)
        known = np.full((len(ids), int(row.windows)), -np.inf)
        known[np.searchsorted(ids, right["anchor"].to_numpy(np.int64)),
              right["window"].to_numpy(np.int64)] = right["least"].to_numpy(np.int64)
        return left.assign(beat=[known.tobytes()])

    return blocks.groupBy("cell", "slot").cogroup(
        beat.select("cell", "slot", "anchor", "window", "least").groupBy("cell", "slot")).applyInPandas(run, ASKED)


def _bounds(row):
    ids, labels, queries = _unpacked(row)
    return (ids, labels, queries, *[np.frombuffer(x, np.float64).reshape(len(ids), int(row.windows))
                                    for x in (row.low, row.high, row.beat)])


def _visit(same: bool, most: int):
    """A block of anchors and a page on each row: what the page has for the block."""
    def run(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids, *bounds = _bounds(row)
                page = Page(Stored(*[getattr(row, f"page_{c}") for c in Stored._fields]))
                query, window, name, score = page.answer(ids, *bounds, same, most)
                yield pd.DataFrame({"anchor": ids[query], "window": window, "id": name, "score": score})
    return run


def _route(index: Index):
    """The cells whose ball can hold an answer to any query of the block."""
    pivots, held, reach = index.pivots[index.held], index.held, index.reach

    def run(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids, labels, queries, low, high, beat = _bounds(row)
                length = np.linalg.norm(queries, axis=1)[:, None]
                near = queries @ pivots.T
                slack = 1e-9 * (np.abs(near) + length * (reach + 1)) + 1e-6
                upper, lower = near + length * reach + slack, near - length * reach - slack
                need = np.maximum(low, beat)
                some = np.zeros(upper.shape, bool)
                for w in range(low.shape[1]):
                    some |= ((upper >= need[:, w, None]) & (lower <= high[:, w, None])
                             & (low[:, w] <= high[:, w])[:, None])
                cells = held[some.any(0)]
                yield pd.DataFrame({"cell": np.int32(row.cell), "slot": np.int32(row.slot),
                                    "target": cells.astype(np.int32)})
    return run


def _windows(blocks: DataFrame, positives: DataFrame, most: int, share: tuple[int, int]) -> DataFrame:
    """Blocks with a window of scores per positive: share[0] % to share[1] % of its score."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return left
        ids = np.frombuffer(left.iloc[0].ids, np.int64)
        low, high = np.full((len(ids), most), np.inf), np.full((len(ids), most), -np.inf)
        at = np.searchsorted(ids, right["anchor"].to_numpy(np.int64)), right["window"].to_numpy(np.int64)
        score = right["score"].to_numpy(np.int64)
        low[at], high[at] = -(-score * share[0] // 100), score * share[1] // 100
        return left.assign(windows=most, low=[low.tobytes()], high=[high.tobytes()],
                           beat=[np.full(low.shape, -np.inf).tobytes()])

    return blocks.groupBy("cell", "slot").cogroup(
        positives.select("cell", "slot", "anchor", "window", "score").groupBy("cell", "slot")).applyInPandas(run, ASKED)


def _open_windows(batches):
    """Blocks with one window without bounds."""
    for batch in batches:
        size = [len(x) // 8 for x in batch["ids"]]
        none, all_ = [np.full(n, -np.inf).tobytes() for n in size], [np.full(n, np.inf).tobytes() for n in size]
        yield batch.assign(windows=1, low=none, high=all_, beat=none)


def mine(points: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
         share: tuple[int, int] = (80, 100)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `points`: (id, label, vector) as `usable` makes them, with whole numbers as components.  Positives are the
    best other rows of the anchor's label, negatives the best rows of other labels whose score is between
    share[0] % and share[1] % of the positive's.
    """
    index = Index(materialize(points, "points"))
    anchors = index.points.filter(is_anchor)
    sizes = anchors.groupBy("cell").agg(F.count("*").alias("n"))
    anchors = materialize(_paged(anchors, BLOCK, sizes).select("cell", "slot", "id", "label", "vector"), "anchors")
    homes = anchors.select("cell", "slot", F.col("id").alias("anchor"))
    blocks = materialize(anchors.groupBy("cell", "slot").applyInPandas(_pack_rows(index.width), PAGE_ROW), "blocks")
    found = index.search(blocks.mapInPandas(_open_windows, ASKED), homes, True, positives).select(
        "anchor", (F.col("rank") - 1).alias("window"), "id", "score")
    windows = materialize(_windows(blocks, found.join(homes, "anchor"), positives, share), "windows")
    wrong = index.search(windows, homes, False, negatives)
    return wrong.join(found.withColumnsRenamed({"id": "positive_id", "score": "positive_score"}),
                      ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
