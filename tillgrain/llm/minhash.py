"""Near-duplicate documents: b-bit MinHash candidates, confirmed on full shingle sets.

A document's set holds its distinct shingles of five lower-cased words (fewer words: the
whole sequence).  200 minima per set give 40 band keys of five minima; of the first 128 minima the
lowest two bits are kept in a signature of 256 bits, whose equal pairs estimate the
similarity, corrected for chance matches.  A pair at the threshold shares no band with a chance of 2e-5,
one at 0.4 shares one with a chance of 0.34, one at 0.3 of 0.09.

Documents with equal sets form one class and go on as its smallest id.  Classes that share a
band are candidates: first each with the one smallest member that it shares most bands with,
then, where a band holds several components, the members outside the band's main component
with all members of other components, in blocks of bounded weight.  A pair whose estimate is
too low is dropped, all others are confirmed on the full sets.  So a large group of near
copies is linked by a star, not by all its pairs, and no table of pairs is made of the rest.
Bands are stored with ids only; signatures join them where they are compared.

Null and empty texts have empty sets and are linked with nothing.  Rows that repeat an id are
one document with the set of the text that sorts last.  Rows with a null id are their own
component, under a null id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.components import connected_components
from ..operators.joins import attach
from ..session import Scratch, materialize, scratch
from .arrays import U, groups, joined, mix, seeded, span_hash, window_hash, words
from .common import hinted

SHINGLE = 5
HASHES, ROWS = 200, 5           # 40 bands of 5
BITS = 2
SIGNED = 128                    # minima in the signature
ACROSS = (3, 4)                 # similarity of at least 3/4
ESTIMATE = 0.55                 # more than four standard errors below the threshold
BLOCK = 500_000                 # shingles of a band's members that meet in one task, for either side
PAIRS = 200_000                 # pairs of signatures that are compared at once
ODD = U((1 << 64) // 3)         # 0101...01
PIVOT_SLOT = 200                # members that a pivot's text is joined to at once

_odd = (seeded(np.arange(HASHES, dtype=U), 11) | U(1))
_shift = seeded(np.arange(HASHES, dtype=U), 12)
_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 32


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, text of it), every occurrence, in the order of the texts."""
    data, starts = joined([t.encode() for t in texts])
    data = _lower[data]
    begin, end = words(data)
    hashed = span_hash(data, begin, end)
    of = np.searchsorted(starts, begin, side="right") - 1
    made, at = window_hash(hashed, SHINGLE), of[:max(0, len(of) - SHINGLE + 1)]
    inside = at == of[SHINGLE - 1:]
    count = np.bincount(of, minlength=len(texts))
    out, where = [made[inside]], [at[inside]]
    for n in range(1, SHINGLE):                     # too few words: one shingle of all
        first = np.concatenate([[0], np.cumsum(count)[:-1]])[count == n]
        if len(first):
            out.append(window_hash(hashed, n, 99)[first])
            where.append(of[first])
    made, at = np.concatenate(out), np.concatenate(where)
    order = np.argsort(at, kind="stable")
    return made[order], at[order]


def distinct_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, where each text's set begins, and the end)."""
    made, at = shingles(texts)
    cut = np.searchsorted(at, np.arange(len(texts) + 1))
    sets = [np.unique(made[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    return (np.concatenate(sets) if sets else np.empty(0, U),
            np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64))


def minima(made: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The least value of each hash function over each set that is not empty."""
    cut = cut[:-1]
    out = np.empty((HASHES, len(cut)), U)
    for k in range(HASHES):
        out[k] = np.minimum.reduceat(made * _odd[k] + _shift[k], cut)
    return out


def _summaries(frames):
    for frame in frames:
        texts, ids, k = frame["text"].tolist(), frame["doc_id"].to_numpy(), 0
        while k < len(texts):
            stop, size = k, 0
            while stop < len(texts) and (stop == k or size + len(texts[stop]) < 1_000_000):
                size += len(texts[stop])
                stop += 1
            made, cut = distinct_sets(texts[k:stop])
            n = np.diff(cut)
            some = np.flatnonzero(n)
            if len(some):
                edge = np.append(cut[:-1][some], cut[-1])
                least = minima(made, edge)
                prints = [np.add.reduceat(seeded(made, s), edge[:-1]) for s in (21, 22)]
                low = mix(least) & U((1 << BITS) - 1)
                per = 64 // BITS
                sign = [np.bitwise_or.reduce([low[w * per + j] << U(BITS * j) for j in range(per)])
                        for w in range(SIGNED // per)]
                bands = [seeded(window_hash(least[b:b + ROWS].T.ravel(), ROWS)[::ROWS], b)
                         for b in range(0, HASHES, ROWS)]
                yield pd.DataFrame({
                    "doc_id": ids[k:stop][some], "n_shingles": n[some],
                    "set_a": prints[0].view(np.int64), "set_b": prints[1].view(np.int64),
                    **{f"sign{w}": s.view(np.int64) for w, s in enumerate(sign)},
                    "bands": list(np.array(bands).T.astype(U).view(np.int64))})
            k = stop


WORDS = SIGNED * BITS // 64
_FIELDS = "doc_id long, n_shingles long, set_a long, set_b long, " + \
    "".join(f"sign{w} long, " for w in range(WORDS)) + "bands array<long>"


def estimate(a: str, b: str) -> Column:
    """Similarity from the signatures of two aliases, corrected for chance matches."""
    odd = int(ODD)
    same = F.lit(0)
    for w in range(WORDS):
        differ = F.col(f"{a}.sign{w}").bitwiseXOR(F.col(f"{b}.sign{w}"))
        either = differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(F.lit(odd))
        same = same + (64 // BITS - F.bit_count(either))
    chance = 2.0 ** -BITS
    return (same / float(SIGNED) - chance) / (1 - chance)


def _confirm(least: tuple[int, int]):
    def run(frames):
        for frame in frames:
            pivots, at = np.unique(frame["pivot"].to_numpy(), return_inverse=True)
            first = {p: k for k, p in reversed(list(enumerate(frame["pivot"])))}
            made, cut = distinct_sets([frame["pivot_text"][first[p]] for p in pivots])
            mine, of = distinct_sets(frame["text"].tolist())
            good = []
            for k, p in enumerate(at):
                a, b = made[cut[p]:cut[p + 1]], mine[of[k]:of[k + 1]]
                common = np.isin(b, a, assume_unique=True).sum()
                good.append(least[1] * common >= least[0] * (len(a) + len(b) - common))
            yield frame.loc[good, ["member", "pivot"]]
    return run


def confirmed(pairs: DataFrame, texts: DataFrame, least: tuple[int, int] = ACROSS) -> DataFrame:
    """The pairs (member, pivot) whose full sets are similar enough; stored.

    A pivot's text is joined once per slot of its members, so one with many is no hot key.
    """
    with scratch(texts.sparkSession) as scope:
        return scope.keep(_checked(pairs, texts, least), "links")


def _checked(pairs: DataFrame, texts: DataFrame, least: tuple[int, int]) -> DataFrame:
    pairs = materialize(pairs, "pairs")
    ids = materialize(pairs.select(F.explode(F.array("member", "pivot")).alias("doc_id")).distinct(), "ids")
    involved = materialize(texts.join(hinted(ids, ids.count()), "doc_id", "left_semi"), "texts")
    sizes = pairs.groupBy("pivot").agg(F.count("*").alias("n"))
    slots = materialize(sizes.select("pivot", F.ceil(F.col("n") / PIVOT_SLOT).alias("slots"), "n"), "slots")
    dealt = attach(pairs, slots, "pivot", "n").select(
        "member", "pivot", F.pmod(F.xxhash64("member"), F.col("slots")).alias("slot"))
    right = slots.select("pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot")) \
        .join(involved.select(F.col("doc_id").alias("pivot"), F.col("text").alias("pivot_text")), "pivot")
    left = dealt.join(involved.select(F.col("doc_id").alias("member"), "text"), "member")
    return left.join(right, ["pivot", "slot"]).select("member", "pivot", "text", "pivot_text") \
        .mapInPandas(_confirm(least), "member long, pivot long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document; stored."""
    with scratch(docs.sparkSession) as scope:
        return scope.keep(_grouped(docs, scope), "near-duplicates")


def _grouped(docs: DataFrame, scope: Scratch) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    known = rows.filter("doc_id is not null")
    summaries = materialize(known.mapInPandas(_summaries, _FIELDS).groupBy("doc_id").agg(
        F.max(F.struct(*[x.split()[0] for x in _FIELDS.split(", ")[1:]])).alias("s"))
        .select("doc_id", "s.*"), "summaries")

    # Classes of equal sets, named by their smallest id.
    key = F.xxhash64("set_a", "set_b", "n_shingles")
    classes = materialize(summaries.groupBy(key.alias("set")).agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    members = materialize(attach(summaries.select("doc_id", "n_shingles", key.alias("set")), classes,
                                 "set", "copies").select("doc_id", "n_shingles", "rep"), "members")
    heads = summaries.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    signs = [f"sign{w}" for w in range(WORDS)]
    sketches = materialize(heads.select("doc_id", F.struct("n_shingles", *signs).alias("s")), "sketches")

    # Bands of at least two classes, each row with the band's smallest member.
    spread = heads.select(F.col("doc_id").alias("rep"), F.explode("bands").alias("band"))
    shared = materialize(spread.groupBy("band").agg(
        F.min("rep").alias("pivot"), F.count("*").alias("size"), F.count("*").alias("n")).filter(
        "size > 1"), "bands")
    placed = materialize(attach(spread, shared, "band", "n").filter("pivot is not null").select(
        "rep", "band", "pivot"), "placed")
    scope.drop(summaries, shared, classes)

    # A star per group: each class with the pivot it shares most bands with.
    stars = materialize(placed.filter("rep <> pivot").groupBy(F.col("rep").alias("member"), "pivot").agg(
        F.count("*").alias("bands")), "stars")
    best = stars.groupBy("member").agg(F.max(F.struct("bands", (-F.col("pivot")).alias("low"))).alias("top")) \
        .select("member", (-F.col("top.low")).alias("pivot"))
    links = confirmed(_promising(best, sketches), known)
    scope.drop(stars)
    roots = _roots(links)
    # Then all others of a band, where groups still differ: links between the roots of groups.
    more = _across(placed, roots.select(F.col("member").alias("node"), F.col("pivot").alias("component")), sketches, known)
    sizes = members.groupBy("rep").agg(F.count("*").alias("n"))
    named = sizes.join(roots.withColumnRenamed("member", "rep"), "rep", "left").select(
        "rep", "n", F.coalesce("pivot", "rep").alias("component_id"))
    if not more.isEmpty():
        up = roots.select(F.col("member").alias("node"), F.col("pivot").alias("root"))
        ends = more.join(up.withColumnsRenamed({"node": "member", "root": "a"}), "member", "left").join(
            up.withColumnsRenamed({"node": "pivot", "root": "b"}), "pivot", "left")
        linked = connected_components(ends.select(
            F.coalesce("a", "member").alias("a"), F.coalesce("b", "pivot").alias("b")).distinct())
        named = named.join(linked.withColumnRenamed("node", "component_id"), "component_id", "left").select(
            "rep", "n", F.coalesce("component", "component_id").alias("component_id"))
    named = materialize(named, "named")

    # From classes to documents: classes of many copies are hot keys.
    found = attach(members, named, "rep", "n").select("doc_id", "n_shingles", "component_id")
    ids = known.select("doc_id").distinct().join(found, "doc_id", "left")
    return ids.select("doc_id", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"),
                      F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id") == F.col("component_id")).unionByName(
        rows.filter("doc_id is null").mapInPandas(_lonely, "doc_id long, n_shingles long, component_id long, kept boolean"))


def _roots(links: DataFrame) -> DataFrame:
    """(member, pivot) with the root of each member's tree for its pivot; stored.

    A member has one pivot, which has a smaller id, so links are trees; every round halves the ways.
    A pivot of many members is a hot key.
    """
    with scratch(links.sparkSession) as scope:
        state = links
        while True:
            higher = state.select(F.col("member").alias("pivot"), F.col("pivot").alias("above"))
            lookup = materialize(state.groupBy("pivot").agg(F.count("*").alias("n")).join(higher, "pivot"), "above")
            if lookup.isEmpty():
                return scope.keep(state, "roots")
            state = materialize(attach(state, lookup, "pivot", "n").select(
                "member", F.coalesce("above", "pivot").alias("pivot")), "state")


def _lonely(frames):
    for frame in frames:
        _, cut = distinct_sets(frame["text"].tolist())
        yield pd.DataFrame({"doc_id": pd.array([None] * len(frame), "Int64"), "n_shingles": np.diff(cut),
                            "component_id": pd.array([None] * len(frame), "Int64"), "kept": True})


def _promising(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs of similar signatures and sizes."""
    by_pivot = materialize(pairs.groupBy("pivot").agg(F.count("*").alias("n")).join(
        sketches.select(F.col("doc_id").alias("pivot"), F.col("s").alias("b")), "pivot"), "pivots")
    return attach(pairs.join(sketches.select(F.col("doc_id").alias("member"), F.col("s").alias("a")), "member"),
                  by_pivot, "pivot", "n").filter(_similar("a", "b")).select("member", "pivot")


def _similar(a: str, b: str) -> Column:
    """Whether the sizes allow the threshold and the estimate does not exclude it."""
    m, n = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (ACROSS[1] * F.least(m, n) >= ACROSS[0] * F.greatest(m, n)) & (estimate(a, b) >= ESTIMATE)


def _across(placed: DataFrame, components: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (member, pivot) of full sets between components that share a band; stored.

    A band's main component is not compared with itself: only its other members meet all.
    They meet in blocks of bounded weight, where pairs stay inside the task: first rows with
    no promising partner go, then the rest gets its texts, and a member is linked once to
    each component that it belongs to.
    """
    with scratch(texts.sparkSession) as scope:
        return scope.keep(_between(placed, components, sketches, texts), "across")


def _between(placed: DataFrame, components: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    parts = materialize(sketches.join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        F.col("doc_id").alias("rep"), F.coalesce("component", "doc_id").alias("part"),
        F.col("s.n_shingles").alias("n_shingles")), "parts")
    rows = materialize(placed.select("band", "rep").join(parts, "rep"), "parted")
    weight = F.sum("weight")
    main = materialize(rows.groupBy("band", "part").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("weight")).groupBy("band").agg(
        F.max(F.struct("n", "part", "weight")).alias("top"), F.sum("n").alias("size"),
        weight.alias("weight"), F.count("*").alias("parts")).filter("parts > 1").select(
        "band", F.col("top.part").alias("main"), "size", "weight",
        F.ceil((F.col("weight") - F.col("top.weight")) / BLOCK).alias("lslots"),
        F.ceil(F.col("weight") / BLOCK).alias("rslots")), "main")
    total = main.agg(weight).first()[0]
    if not total:
        return texts.select(F.col("doc_id").alias("member"), F.col("doc_id").alias("pivot")).limit(0)
    opened = materialize(attach(rows, main, "band", "size").filter("main is not null").drop("size", "weight"),
                         "open")

    def slot(count: str):
        return F.pmod(F.xxhash64("rep"), F.col(count))

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    left = opened.filter("part <> main").withColumns({"mine": F.lit(True), "lslot": slot("lslots")}) \
        .withColumn("rslot", every("rslots"))
    right = opened.withColumns({"mine": F.lit(False), "rslot": slot("rslots")}) \
        .withColumn("lslot", every("lslots"))
    alone = (F.col("lslots") == 1) & (F.col("rslots") == 1)          # small bands share blocks
    block = F.when(alone, F.pmod(F.col("band"), F.lit(math.ceil(total / BLOCK)))).otherwise(
        F.xxhash64("band", "lslot", "rslot"))
    keep = ["block", "band", "lslot", "rslot", "mine", "rep", "part", "main", "n_shingles"]
    signs = sketches.select(F.col("doc_id").alias("rep"), *[f"s.sign{w}" for w in range(WORDS)])
    dealt = materialize(left.unionByName(right).withColumn("block", block).select(*keep), "dealt")
    signed = dealt.join(signs, "rep").select(*keep, *[f"sign{w}" for w in range(WORDS)])
    near = materialize(signed.groupBy("block").applyInPandas(_met, signed.schema), "near")
    ids = materialize(near.select(F.col("rep").alias("doc_id")).distinct(), "near-ids")
    few = materialize(texts.join(hinted(ids, ids.count()), "doc_id", "left_semi"), "near-texts")
    held = near.select(F.col("block").alias("meeting"), F.col("rep").alias("doc_id")).distinct().join(few, "doc_id")
    return near.groupBy("block").cogroup(held.groupBy("meeting")).applyInPandas(_linked, "member long, pivot long")


def _meetings(frame: pd.DataFrame):
    """(left rows, right rows) that are similar by size and signature, band by band."""
    band, lslot, rslot = (frame[c].to_numpy() for c in ("band", "lslot", "rslot"))
    mine, rep, part, main, n = (frame[c].to_numpy() for c in ("mine", "rep", "part", "main", "n_shingles"))
    sign = [frame[f"sign{w}"].to_numpy().view(U) for w in range(WORDS)]
    order = np.lexsort((rslot, lslot, band))
    same = np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in (band, lslot, rslot)])
    edges = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(order)]])
    for a, b in zip(edges[:-1], edges[1:]):
        rows = order[a:b]
        lefts, r = rows[mine[rows]], rows[~mine[rows]]
        step = max(1, PAIRS // max(1, len(r)))
        for k in range(0, len(lefts), step):
            x = lefts[k:k + step]
            good = (part[x][:, None] != part[r]) & ((part[r] == main[r]) | (rep[x][:, None] < rep[r]))
            small, large = np.minimum(n[x][:, None], n[r]), np.maximum(n[x][:, None], n[r])
            good &= ACROSS[1] * small >= ACROSS[0] * large
            i, j = np.nonzero(good)
            equal = np.zeros(len(i), np.int64)
            for s in sign:
                differ = s[x[i]] ^ s[r[j]]
                equal += 64 // BITS - np.bitwise_count((differ | (differ >> U(1))) & ODD).astype(np.int64)
            chance = 2.0 ** -BITS
            good = (equal / SIGNED - chance) / (1 - chance) >= ESTIMATE
            yield x[i[good]], r[j[good]]


def _met(frame: pd.DataFrame) -> pd.DataFrame:
    """The rows that have a promising partner in their band."""
    found = np.zeros(len(frame), bool)
    for left, right in _meetings(frame):
        found[left] = found[right] = True
    return frame[found]


def _linked(frame: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """The promising pairs confirmed on full sets, one per left row and component."""
    rep, part = frame["rep"].to_numpy(), frame["part"].to_numpy()
    made, cut = distinct_sets(held["text"].tolist())
    size = np.diff(cut)
    wanted = dict(zip(rep.tolist(), frame["n_shingles"].tolist()))     # of a repeated id the set that counts
    place = {d: k for k, d in enumerate(held["doc_id"].tolist()) if size[k] == wanted.get(d)}
    at = np.array([place[d] for d in rep.tolist()], np.int64)
    known, code = np.unique(made, return_inverse=True)
    flag = np.zeros(len(known), np.int64)
    members, pivots = [], []
    for left, right in _meetings(frame):
        edges = np.concatenate([[0], np.flatnonzero(np.diff(left)) + 1, [len(left)]])
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            own, others = at[left[a]], at[right[a:b]]
            flag[code[cut[own]:cut[own + 1]]] = 1
            upto = np.concatenate([[0], np.cumsum(size[others])])
            take = np.repeat(cut[others] - upto[:-1], size[others]) + np.arange(upto[-1])
            common = np.add.reduceat(flag[code[take]], upto[:-1])
            flag[code[cut[own]:cut[own + 1]]] = 0
            good = ACROSS[1] * common >= ACROSS[0] * (size[own] + size[others] - common)
            _, first = np.unique(part[right[a:b]][good], return_index=True)
            partners = rep[right[a:b]][good][first]
            members.append(np.full(len(partners), rep[left[a]]))
            pivots.append(partners)
    return pd.DataFrame({"member": np.concatenate([*members, np.empty(0, np.int64)]),
                         "pivot": np.concatenate([*pivots, np.empty(0, np.int64)])})
