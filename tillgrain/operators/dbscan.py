"""Exact density clustering (DBSCAN) on a grid.

Cells have a diagonal of eps, so all points of a cell are neighbours:

* a cell with enough points holds core points only, and they belong together;
* only the points of thin cells (fewer than `min_points` each) count neighbours,
  so a point meets a bounded number of probes however full its cell is;
* clusters are components of the graph of core cells.  Two cells are linked when
  some pair of their core points lies within eps.  That is decided from bounding
  boxes and sample points of ever finer sub-cells; single points are compared only
  once few candidate pairs are left.

Full cells are cut into slots, so no task holds a whole cell.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .components import connected_components
from .joins import attach
from .ranking import with_row_rank

SLOT_ROWS = 100_000          # points of one cell per task
DIRECT_PAIRS = 20_000_000    # candidate point pairs that are compared directly
NOISE = -1


def _cell(columns: list[Column]) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in columns])


def _offsets(d: int) -> list[tuple[int, ...]]:
    """Cell offsets that can hold points within eps (side = eps / sqrt(d))."""
    reach = math.floor(1 + math.sqrt(d) + 1e-6)
    return [o for o in itertools.product(range(-reach, reach + 1), repeat=d)
            if sum(max(abs(k) - 1, 0) ** 2 for k in o) <= d + 1e-6]


def _near_cells(df: DataFrame, d: int, offsets) -> DataFrame:
    """Each row once per cell around its own, as `near`."""
    shifts = F.array(*[F.struct(*[F.lit(k).alias(f"s{i}") for i, k in enumerate(o)]) for o in offsets])
    shifted = df.withColumn("_s", F.explode(shifts))
    return shifted.withColumn("near", _cell([F.col(f"c{i}") + F.col("_s")[f"s{i}"] for i in range(d)])).drop("_s")


def _gap(lo_a, hi_a, lo_b, hi_b) -> Column:
    """Smallest squared distance between two boxes."""
    return sum((F.pow(F.greatest(la - hb, lb - ha, F.lit(0.0)), 2)
                for la, ha, lb, hb in zip(lo_a, hi_a, lo_b, hi_b)), F.lit(0.0))


def _reach(lo_a, hi_a, lo_b, hi_b) -> Column:
    """Largest squared distance between points of two boxes."""
    return sum((F.pow(F.greatest(ha - lb, hb - la), 2)
                for la, ha, lb, hb in zip(lo_a, hi_a, lo_b, hi_b)), F.lit(0.0))


def _squared(a: list[Column], b: list[Column]) -> Column:
    total = None
    for x, y in zip(a, b):
        term = (x - y) * (x - y)
        total = term if total is None else total + term
    return total


def neighbour_flags(points: DataFrame, key: str, dims: list[str], eps: float,
                    min_points: int) -> DataFrame:
    """Points with their grid cell and `is_core`: at least `min_points` within eps, itself included."""
    d = len(dims)
    side = eps / math.sqrt(d) * (1 - 1e-9)
    grid = points.select(F.col(f"`{key}`").alias("id"),
                         *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(dims)])
    grid = grid.withColumns({f"c{i}": F.floor(F.col(f"x{i}") / side) for i in range(d)})
    grid = materialize(grid.withColumn("cell", _cell([F.col(f"c{i}") for i in range(d)])), "grid")
    cells = materialize(grid.groupBy("cell").agg(F.count("*").alias("n"))
                        .withColumn("n_cell", F.col("n"))
                        .withColumn("slots", F.ceil(F.col("n") / SLOT_ROWS).cast("int")), "cells")
    placed = attach(grid, cells, "cell", "n")
    placed = materialize(placed.withColumn("slot", F.pmod(F.xxhash64("id"), F.col("slots")).cast("int")),
                         "placed")
    thin = placed.filter(F.col("n_cell") < min_points)
    counts = (_meet(thin, placed, cells, d, eps).groupBy("id").agg(F.count("*").alias("near_points")))
    return placed.join(counts, "id", "left").withColumn(
        "is_core", (F.col("n_cell") >= min_points)
        | (F.coalesce("near_points", F.lit(0)) >= min_points)).drop("near_points")


def _meet(probes: DataFrame, points: DataFrame, cells: DataFrame, d: int, eps: float) -> DataFrame:
    """Pairs of a probe (`id`) and a point within eps, as probe id and the point's columns.

    `cells` lists the occupied cells with their number of slots.  Pairs flow straight
    into the caller's aggregate.
    """
    near = _near_cells(probes.select("id", *[f"x{i}" for i in range(d)], *[f"c{i}" for i in range(d)]),
                       d, _offsets(d))
    near = near.join(cells.select(F.col("cell").alias("near"), F.col("slots").alias("near_slots")), "near")
    near = near.select("id", "near", *[F.col(f"x{i}").alias(f"p{i}") for i in range(d)],
                       F.explode(F.sequence(F.lit(0), F.col("near_slots") - 1)).alias("near_slot"))
    others = points.withColumnRenamed("id", "other")
    close = _squared([F.col(f"p{i}") for i in range(d)], [F.col(f"x{i}") for i in range(d)]) <= eps * eps
    return near.join(others, (F.col("near") == F.col("cell")) & (F.col("near_slot") == F.col("slot"))
                     & close)


def dbscan(points: DataFrame, key: str, dims: list[str], eps: float, min_points: int,
           direct_pairs: int = DIRECT_PAIRS) -> DataFrame:
    """(key, cluster): clusters numbered by their smallest core key, noise is -1.

    A border point joins the lowest-numbered cluster that has a core point within eps.
    """
    d = len(dims)
    flagged = materialize(neighbour_flags(points, key, dims, eps, min_points), "flagged")
    core = flagged.filter("is_core")
    links = _cell_links(core, d, eps, direct_pairs)
    parts = connected_components(links.select("a", "b"))
    core_cells = materialize(
        core.groupBy("cell").agg(F.min("id").alias("first_id"), F.count("*").alias("n"),
                                 F.first("slots").alias("slots"))
        .join(parts, F.col("cell") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "cell")).drop("node"), "core-cells")
    firsts = core_cells.groupBy("component").agg(F.min("first_id").alias("first_id"))
    numbered = with_row_rank(materialize(firsts, "clusters"), ["first_id"], "_number")
    cell_cluster = materialize(
        core_cells.join(numbered.select("component", (F.col("_number") - 1).cast("int").alias("cluster")),
                        "component").select("cell", "n", "slots", "cluster"), "cell-clusters")
    labelled = attach(core.select("id", "cell"), cell_cluster.select("cell", "n", "cluster"), "cell", "n")
    # Border points: probes from thin cells towards core points only.
    core_points = attach(core, cell_cluster.select("cell", "n", "cluster"), "cell", "n")
    rest = flagged.filter(~F.col("is_core"))
    border = _meet(rest, core_points, cell_cluster, d, eps).groupBy("id").agg(F.min("cluster").alias("cluster"))
    others = rest.select("id").join(border, "id", "left").select(
        "id", F.coalesce("cluster", F.lit(NOISE)).alias("cluster"))
    return labelled.select("id", "cluster").unionAll(others).withColumnRenamed("id", key)


def _cell_links(core: DataFrame, d: int, eps: float, direct_pairs: int) -> DataFrame:
    """Pairs (a, b) of core cells with two core points within eps of each other."""
    forward = [o for o in _offsets(d) if o > (0,) * d]
    boxes = materialize(_boxes(core, ["cell"], d, ["cell"] + [f"c{i}" for i in range(d)]), "boxes")
    a, b = _sided(boxes, "a", d), _sided(boxes, "b", d)
    pairs = _near_cells(boxes.select("cell", *[f"c{i}" for i in range(d)]), d, forward).select(
        F.col("cell").alias("a_cell"), F.col("near").alias("b_cell"))
    open_pairs = pairs.join(a, "a_cell").join(b, "b_cell")
    linked, level = None, 0
    while True:
        # Pairs of boxes: decided by their sample points or corners, dropped when too
        # far apart, else open.  One sure pair decides its two cells.
        judged = materialize(_judge(open_pairs, d, eps), f"pairs-{level}")
        sure = judged.filter("sure").select("a_cell", "b_cell").distinct()
        linked = sure if linked is None else linked.unionAll(sure)
        left = materialize(judged.filter("not sure").join(sure, ["a_cell", "b_cell"], "left_anti"),
                           f"open-{level}")
        work = left.agg(F.sum(F.col("a_n").cast("double") * F.col("b_n"))).first()[0] or 0.0
        if work <= direct_pairs:
            break
        level += 1
        open_pairs = _refine(core, left, d, eps, level)
    if work:
        linked = linked.unionAll(_compare_points(core, left, d, eps, level))
    return linked.select(F.col("a_cell").alias("a"), F.col("b_cell").alias("b")).distinct()


def _boxes(core: DataFrame, keys: list[str], d: int, carried: list[str]) -> DataFrame:
    sample = F.min(F.struct(*[F.col(f"x{i}") for i in range(d)]))
    return core.groupBy(*keys).agg(
        F.count("*").alias("n"), sample.alias("sample"),
        *[F.min(f"x{i}").alias(f"lo{i}") for i in range(d)],
        *[F.max(f"x{i}").alias(f"hi{i}") for i in range(d)],
        *[F.first(c).alias(c) for c in carried if c not in keys])


def _sided(boxes: DataFrame, side: str, d: int) -> DataFrame:
    names = ["cell", "n", "sample"] + [f"lo{i}" for i in range(d)] + [f"hi{i}" for i in range(d)]
    names += ["micro"] if "micro" in boxes.columns else []
    names += ["parent"] if "parent" in boxes.columns else []
    return boxes.select(*[F.col(n).alias(f"{side}_{n}") for n in names])


def _judge(pairs: DataFrame, d: int, eps: float) -> DataFrame:
    lo_a, hi_a = [F.col(f"a_lo{i}") for i in range(d)], [F.col(f"a_hi{i}") for i in range(d)]
    lo_b, hi_b = [F.col(f"b_lo{i}") for i in range(d)], [F.col(f"b_hi{i}") for i in range(d)]
    samples = _squared([F.col("a_sample")[f"x{i}"] for i in range(d)],
                       [F.col("b_sample")[f"x{i}"] for i in range(d)])
    limit = eps * eps
    # The corner test keeps a hair of distance, so rounding cannot link cells wrongly.
    sure = (samples <= limit) | (_reach(lo_a, hi_a, lo_b, hi_b) <= limit * (1 - 1e-12))
    return pairs.filter(_gap(lo_a, hi_a, lo_b, hi_b) <= limit * (1 + 1e-12)).withColumn("sure", sure)


def _micro(d: int, eps: float, level: int) -> Column:
    side = eps / math.sqrt(d) * (1 - 1e-9) / 2 ** level
    return _cell([F.floor(F.col(f"x{i}") / side) for i in range(d)])


def _refine(core: DataFrame, left: DataFrame, d: int, eps: float, level: int) -> DataFrame:
    """The open pairs one level finer: sub-boxes of a against sub-boxes of b."""
    cells = left.select(F.explode(F.array("a_cell", "b_cell")).alias("cell")).distinct()
    inside = core.join(cells, "cell", "left_semi").withColumns({
        "micro": _micro(d, eps, level), "parent": _micro(d, eps, level - 1) if level > 1 else F.col("cell")})
    fine = materialize(_boxes(inside, ["cell", "micro"], d, ["parent"]), f"boxes-{level}")
    old = left.select("a_cell", "b_cell",
                      F.col("a_micro" if level > 1 else "a_cell").alias("a_parent"),
                      F.col("b_micro" if level > 1 else "b_cell").alias("b_parent"))
    return (old.join(_sided(fine, "a", d), ["a_cell", "a_parent"])
            .join(_sided(fine, "b", d), ["b_cell", "b_parent"])
            .drop("a_parent", "b_parent"))


def _compare_points(core: DataFrame, left: DataFrame, d: int, eps: float, level: int) -> DataFrame:
    """Open pairs decided point by point; the caller has bounded their number."""
    tag = _micro(d, eps, level) if level else F.col("cell")
    points = core.select("cell", tag.alias("micro"), *[f"x{i}" for i in range(d)])
    a = points.select(F.col("cell").alias("a_cell"), F.col("micro").alias("_am"),
                      *[F.col(f"x{i}").alias(f"ax{i}") for i in range(d)])
    b = points.select(F.col("cell").alias("b_cell"), F.col("micro").alias("_bm"),
                      *[F.col(f"x{i}").alias(f"bx{i}") for i in range(d)])
    pairs = left.select("a_cell", "b_cell", F.col("a_micro" if level else "a_cell").alias("_am"),
                        F.col("b_micro" if level else "b_cell").alias("_bm"))
    close = _squared([F.col(f"ax{i}") for i in range(d)], [F.col(f"bx{i}") for i in range(d)]) <= eps * eps
    met = pairs.join(a, ["a_cell", "_am"]).join(b, ["b_cell", "_bm"]).filter(close)
    return met.select("a_cell", "b_cell").distinct()
