"""Overlaps of documents with benchmark items that survive substituted, added and left-out words.

Spaced seeds: a fixed mask selects some word positions of a window and ignores the others,
so a window with substitutions at ignored places still has the hash of the original.  The
masks are all choices of three words within five.  An item of which half of the words (eight
at least) stand at the same distances in a document meets one of them whichever words those
are, and two of them unless it has 18 words; so nothing at the threshold is missed.

A pair counts by its hits within a reach of shifts (half of the item, eight words at least):
- the whole item laid against the document at one shift: the share of equal words; or
- the words of all hits together, over the shifts within the reach, so that added and
  left-out words split nothing; each word of the item and of the document counts once; or
- a passage: enough of these words close together, whatever the item's length.

Items of fewer words than `LEAST_WORDS` are sought by all their words in a row.  Items and
documents without words (null texts, too) never match.  Item seeds are broadcast in blocks
of bounded size, whatever the benchmark's size.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import hinted, parts_for

MASKS = ("111", "1101", "1011", "11001", "10101", "10011")
LEAST_WORDS, LEAST_SHARE = 8, 0.5
LONE = 18             # nine of 18 words may meet a single mask, all other lengths meet two
PASSAGE, SPAN = 13, 16          # so many words within so many places are a passage
PLACES = 1 << 32
BLOCK = 200_000       # item seeds that are broadcast at once


def word_hashes(text: Column) -> Column:
    """Lower-cased words of letters and digits, hashed."""
    found = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(found, lambda w: F.xxhash64(w))


def seeds(rows: DataFrame, masks: list[str], keep: list[str]) -> DataFrame:
    """(keep, at, mask, seed): one row per mask and window of the word hashes `h`."""
    at, made = F.col("at"), []
    for k, mask in enumerate(masks):
        chosen = [F.get("h", at + j) for j, bit in enumerate(mask) if bit == "1"]
        made.append(F.when(at + len(mask) <= F.size("h"), F.xxhash64(F.lit(k), *chosen)))
    spread = rows.select(*keep, "h", F.explode(F.sequence(F.lit(0), F.size("h") - 1)).alias("at"))
    return spread.select(*keep, "at", F.posexplode(F.array(*made)).alias("mask", "seed")).filter(
        "seed is not null")


def overlaps(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS,
             least_share: float = LEAST_SHARE, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, matched, item_words, share, start) of each contaminated pair.

    `matched` words of the item stand in the document, which would begin the item at word
    `start`.  An item counts from `least_share` of its words on, and `least_words` of them
    (or all that it has), or from a passage of `PASSAGE` words on.  Of several places the
    best one is returned; rows that repeat an id (null, too) are searched one by one and
    reported once.  Shares below a half are not sure to be found.
    """
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    items = benchmark.select(F.xxhash64("item_id", "text").alias("item"), "item_id",
                             word_hashes(F.col("text")).alias("g")).filter(F.size("g") > 0)
    items = items.withColumn("n", F.size("g")).dropDuplicates(["item"])
    short = [r[0] for r in items.filter(F.col("n") < min(map(len, MASKS))).select(
        "n").distinct().collect()]                              # fewer than a mask is long
    masks = [*MASKS, *("1" * n for n in sorted(short))]
    wanted = seeds(items.withColumnRenamed("g", "h"), masks, ["item", "n"]).withColumnRenamed("at", "item_at")
    seed_count = wanted.count()
    blocks = parts_for(seed_count, block)
    words = rows.select("row", word_hashes(F.col("text")).alias("h")).filter(F.size("h") > 0)
    windows = seeds(words, masks, ["row"]).drop("mask")
    reach = F.greatest(F.lit(least_words), F.floor(F.col("n") * least_share)).cast("int")
    found = None
    for k in range(blocks):
        some = wanted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        hits = windows.join(F.broadcast(some), "seed").select(
            "row", "item", "n", (F.col("at") - F.col("item_at")).alias("shift"), "item_at", "mask")
        found = hits if found is None else found.unionAll(hits)

    # Zones of two reaches that overlap by one: shifts within a reach share a zone.
    zone = F.floor(F.col("shift") / reach)
    zoned = found.withColumn("zone", F.explode(F.array(zone - 1, zone)))
    need = F.when((F.col("n") < LEAST_WORDS) | (F.col("n") == LONE), 1).otherwise(2)
    met = materialize(zoned.groupBy("row", "item", "n", "zone").agg(
        F.collect_set(F.struct("shift", "item_at", "mask")).alias("hits")).filter(
        F.size("hits") >= need).select(
        "row", "item", F.array_distinct(F.transform("hits", lambda x: x["shift"])).alias("shifts"),
        _covered(masks).alias("covered")).withColumn("most", _once(F.col("covered"))), "hits")

    # Only documents with hits are read again, and laid against the items.
    ids = met.select("row").distinct()
    hit_docs = rows.join(hinted(ids, ids.count()), "row", "left_semi").select(
        "row", "doc_id", word_hashes(F.col("text")).alias("h"))
    laid = hit_docs.join(met, "row").join(hinted(items, seed_count), "item")
    enough = F.greatest(F.least(F.lit(least_words), F.col("n")), F.ceil(least_share * F.col("n")))
    # Words over several shifts are added up only where they can be enough, and more than at one shift.
    within = F.transform("shifts", lambda s: _within(s, reach, enough))
    ways = _let(F.transform("shifts", lambda s: _at_one(s, enough)), lambda ones: F.when(
        (F.col("n") < LEAST_WORDS) | (F.col("most") < F.least(enough, F.lit(PASSAGE)))
        | (F.col("most") <= F.coalesce(F.array_max(F.transform(F.filter(ones, lambda x: x["good"]),
                                                               lambda x: x["matched"])), F.lit(0))),
        ones).otherwise(F.concat(ones, within)))
    good = laid.select("doc_id", "item_id", "n", F.explode(F.filter(ways, lambda x: x["good"])).alias("way"))
    return good.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("way.matched", "way.back", "n")).alias("best")).select(
        "doc_id", "item_id", F.col("best.matched").cast("long").alias("matched"),
        F.col("best.n").cast("long").alias("item_words"),
        (F.col("best.matched") / F.col("best.n")).alias("share"),
        (-F.col("best.back")).cast("long").alias("start"))


def _covered(masks: list[str]) -> Column:
    """Shift and place, as one number, of each word of the item that a hit has matched."""
    offsets = F.array(*[F.array(*[F.lit(j) for j, bit in enumerate(m) if bit == "1"]) for m in masks])
    return F.array_distinct(F.flatten(F.transform("hits", lambda x: F.transform(
        F.get(offsets, x["mask"]), lambda j: x["shift"].cast("long") * PLACES + x["item_at"] + j))))


def _way(matched: Column, start: Column, good: Column) -> Column:
    return F.struct(matched.alias("matched"), (-F.greatest(start, F.lit(0))).alias("back"), good.alias("good"))


def _at_one(shift: Column, enough: Column) -> Column:
    """The whole item at one shift, single words included."""
    same = F.size(F.filter(F.sequence(F.lit(0), F.col("n") - 1),
                           lambda q: F.coalesce(F.when(shift + q >= 0, F.get("h", shift + q))
                                                == F.get("g", q), F.lit(False))))
    return _way(same, shift, same >= enough)


def _within(first: Column, reach: Column, enough: Column) -> Column:
    """The words of all hits at shifts from `first` on, up to the reach."""
    def judged(some, matched):
        start = F.array_min(F.transform(some, lambda x: F.struct(_place(x), _shift(x).alias("shift"))))["shift"]
        return _way(matched, start.cast("int"), (F.col("n") >= LEAST_WORDS) & (
            (matched >= enough) | ((matched >= PASSAGE) & _dense(some) & _passage(some))))
    return _let(F.filter("covered", lambda x: (_shift(x) >= first) & (_shift(x) <= first + reach)),
                lambda some: _let(_once(some), lambda matched: judged(some, matched)))


def _dense(some: Column) -> Column:
    """Whether so many different places of a passage lie within its span at all."""
    return _let(F.array_sort(F.array_distinct(F.transform(some, _place))), lambda places: F.exists(
        F.zip_with(places, F.slice(places, PASSAGE, F.greatest(F.size(places), F.lit(1))),
                   lambda a, b: b - a), lambda wide: F.coalesce(wide < SPAN, F.lit(False))))


def _passage(some: Column) -> Column:
    """Whether enough words lie within the span, each of the item and of the document once."""
    return F.exists(some, lambda a: _once(F.filter(some, lambda b: (_place(b) >= _place(a)) & (
        _place(b) < _place(a) + SPAN))) >= PASSAGE)


def _let(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _place(code: Column) -> Column:
    return F.pmod(code, F.lit(PLACES))


def _shift(code: Column) -> Column:
    return F.shiftright(code, 32)


def _once(some: Column) -> Column:
    """Words that are matched, where each of the item and of the document counts once."""
    return F.least(F.size(F.array_distinct(F.transform(some, _place))),
                   F.size(F.array_distinct(F.transform(some, lambda x: _place(x) + _shift(x)))))
