"""Exact order statistics and ranks that never sort the whole data in one task.

Three building blocks:

* `select_ranks`   - the rows that stand at given positions of a global order;
* `exact_quantiles`- interpolated quantiles on top of it;
* `running_totals` - cumulative sums over a globally ordered table, from which
  average ranks, percent ranks, ECDFs and ROC areas follow.

Each first checks the size of what it is about to order.  Up to `SMALL` distinct
keys one task orders them; beyond that the work is split by value range.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import materialize
from .joins import attach

SMALL = 1_000_000     # distinct keys one task may order
SMALL_ROWS = 100_000  # whole rows one task may order
SPLITTERS = 24        # range boundaries per selection round
SAMPLE_ROWS = 5_000   # sampled keys from which boundaries are taken
SKETCH = 10_000       # accuracy of the quantile sketch: rank error n / SKETCH


def _key(names: list[str]) -> Column:
    return F.struct(*[F.col(f"`{n}`").alias(f"k{i}") for i, n in enumerate(names)])


def _literal_key(df: DataFrame, names: list[str], values) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.struct(*[F.lit(v).cast(types[n]).alias(f"k{i}")
                      for i, (n, v) in enumerate(zip(names, values))])


def select_ranks(df: DataFrame, by: list[str], ranks: list[int], weight: str | None = None,
                 limit: int = SMALL) -> list[dict]:
    """What stands at the 1-based positions `ranks` of `df` ordered by `by`.

    `weight` names a count column when a row stands for several.  The result has
    one dict per rank: the key values (`key`), the number of rows before that key
    (`before`), the rows that share it (`equal`) and the input rows behind these
    (`groups`).  Only these few scalars reach the driver.

    A large input is narrowed round by round: a few sampled keys cut the order
    into ranges, one aggregate counts them, and the range holding the position
    is kept.  Rows equal to a boundary are counted apart, so a key shared by a
    third of all rows ends the search instead of stalling it.
    """
    by_columns = [F.col(f"`{n}`") for n in by]
    rows = df.select(*by_columns, (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w"))
    size = rows.count()
    if size <= limit:
        return _select_small(rows, by, ranks)
    return [_select_narrowing(rows, by, rank, size, limit) for rank in ranks]


def _select_small(rows: DataFrame, by: list[str], ranks: list[int], offset: int = 0) -> list[dict]:
    columns = [F.col(f"`{n}`") for n in by]
    keyed = rows.groupBy(*columns).agg(F.sum("_w").alias("_equal"), F.count("*").alias("_groups"))
    # One ordering task: the caller has checked that at most `limit` rows are left.
    upto = F.sum("_equal").over(W.orderBy(*columns).rowsBetween(W.unboundedPreceding, 0))
    keyed = keyed.withColumn("_upto", upto)
    hit = F.lit(False)
    for rank in set(ranks):
        position = F.lit(rank - offset)
        hit = hit | ((F.col("_upto") >= position) & (F.col("_upto") - F.col("_equal") < position))
    found = keyed.filter(hit).collect()
    out = []
    for rank in ranks:
        row = next(r for r in found if r["_upto"] - r["_equal"] < rank - offset <= r["_upto"])
        out.append({"key": tuple(row[n] for n in by),
                    "before": offset + row["_upto"] - row["_equal"],
                    "equal": row["_equal"], "groups": row["_groups"]})
    return out


def _select_narrowing(rows: DataFrame, by: list[str], rank: int, size: int, limit: int) -> dict:
    offset, round_no = 0, 0
    while size > limit:
        round_no += 1
        share = min(1.0, SAMPLE_ROWS / size)
        sample = (rows.sample(False, share, seed=round_no)
                  .select(*[F.col(f"`{n}`") for n in by]).limit(4 * SAMPLE_ROWS).distinct()
                  .orderBy(*[F.col(f"`{n}`") for n in by]).collect())
        if not sample:
            continue
        step = max(1, len(sample) // SPLITTERS)
        cuts = [tuple(r) for r in sample[step // 2::step]]
        literals = [_literal_key(rows, by, cut) for cut in cuts]
        key = _key(by)
        # Range 2i lies strictly between two cuts, range 2i+1 equals cut i.
        place = F.lit(0)
        for literal in literals:
            place = place + (key >= literal).cast("int") + (key > literal).cast("int")
        counts = {r["_place"]: r for r in rows.groupBy(place.alias("_place"))
                  .agg(F.sum("_w").alias("w"), F.count("*").alias("n")).collect()}
        for slot in sorted(counts):
            if rank <= offset + counts[slot]["w"]:
                break
            offset += counts[slot]["w"]
        if slot % 2:
            return {"key": cuts[slot // 2], "before": offset,
                    "equal": counts[slot]["w"], "groups": counts[slot]["n"]}
        if slot > 0:
            rows = rows.filter(key > literals[slot // 2 - 1])
        if slot // 2 < len(literals):
            rows = rows.filter(key < literals[slot // 2])
        size = counts[slot]["n"]
    return _select_small(rows, by, [rank], offset)[0]


def select_ranks_by(df: DataFrame, group: str, by: list[str], ranks: dict[str, list[int]],
                    weight: str | None = None, limit: int = SMALL) -> dict[str, list[dict]]:
    """`select_ranks` in several groups (few, with text names) at once.

    Small groups are ordered together by one job; beyond `limit` rows each group is
    narrowed on its own.
    """
    ranks = {g: r for g, r in ranks.items() if r}
    if not ranks:
        return {}
    columns = [F.col(f"`{n}`") for n in by]
    rows = (df.filter(F.col(group).isin(list(ranks)))
            .select(F.col(group).alias("_g"), *columns,
                    (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w")))
    if rows.count() > limit:
        return {g: select_ranks(df.filter(F.col(group) == g), by, wanted, weight, limit)
                for g, wanted in ranks.items()}
    keyed = rows.groupBy("_g", *columns).agg(F.sum("_w").alias("_equal"),
                                             F.count("*").alias("_groups"))
    order = W.partitionBy("_g").orderBy(*columns).rowsBetween(W.unboundedPreceding, 0)
    keyed = keyed.withColumn("_upto", F.sum("_equal").over(order))
    hit = F.lit(False)
    for g, wanted in ranks.items():
        for rank in set(wanted):
            hit = hit | ((F.col("_g") == g) & (F.col("_upto") >= rank)
                         & (F.col("_upto") - F.col("_equal") < rank))
    found = keyed.filter(hit).collect()   # at most one row per wanted rank
    out = {}
    for g, wanted in ranks.items():
        mine = [r for r in found if r["_g"] == g]
        out[g] = []
        for rank in wanted:
            row = next(r for r in mine if r["_upto"] - r["_equal"] < rank <= r["_upto"])
            out[g].append({"key": tuple(row[n] for n in by), "before": row["_upto"] - row["_equal"],
                           "equal": row["_equal"], "groups": row["_groups"]})
    return out


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]],
                    limit: int = SMALL) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several columns, nulls left out.

    Two narrow scans and no shuffle of the data: a quantile sketch brackets each
    quantile, then the values inside the brackets are counted exactly, together
    with the number of rows below.  A quantile that the sketch failed to bracket
    is searched for in the whole column, so the result is always exact.
    """
    asked = [(c, share) for c, shares in wanted.items() for share in shares]
    margin = 3.0 / SKETCH
    sketch = df.agg(
        *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(wanted)],
        *[F.percentile_approx(F.col(f"`{c}`").cast("double"),
                              [max(0.0, p - margin), min(1.0, p + margin)], SKETCH).alias(f"q{i}")
          for i, (c, p) in enumerate(asked)]).first()
    sizes = {c: sketch[f"n{i}"] for i, c in enumerate(wanted)}
    brackets = {i: sketch[f"q{i}"] for i, (c, _) in enumerate(asked) if sizes[c]}
    if not brackets:
        return {c: [None] * len(shares) for c, shares in wanted.items()}
    # Per bracket: the values inside it, and one null entry for all rows below.
    entries = []
    for i, (low, high) in brackets.items():
        value = F.col(f"`{asked[i][0]}`").cast("double")
        entries.append(F.when(value <= high, F.struct(
            F.lit(str(i)).alias("name"), F.when(value >= low, value).alias("v"))))
    counted = materialize(
        df.select(F.explode(F.array_compact(F.array(*entries))).alias("_e")).select("_e.*")
        .groupBy("name", "v").agg(F.count("*").alias("n")), "brackets")
    below = {r["name"]: r["n"] for r in counted.filter("v is null").collect()}
    inside = {r["name"]: r["n"] for r in counted.filter("v is not null").groupBy("name")
              .agg(F.sum("n").alias("n")).collect()}
    ranks, whole = {}, {}
    for i in brackets:
        column, share = asked[i]
        place = share * (sizes[column] - 1)
        pair = [math.floor(place) + 1, min(math.floor(place) + 2, sizes[column])]
        first = below.get(str(i), 0)
        if first < pair[0] and pair[1] <= first + inside.get(str(i), 0):
            ranks[str(i)] = [r - first for r in pair]
        else:
            whole[i] = pair
    found = {int(name): [hit["key"][0] for hit in hits] for name, hits in select_ranks_by(
        counted.filter("v is not null"), "name", ["v"], ranks, "n", limit).items()}
    for i, pair in whole.items():
        values = (df.select(F.col(f"`{asked[i][0]}`").cast("double").alias("v"))
                  .filter("v is not null").groupBy("v").agg(F.count("*").alias("n")))
        found[i] = [hit["key"][0] for hit in
                    select_ranks(materialize(values, "values"), ["v"], pair, "n", limit)]
    out: dict[str, list[float | None]] = {c: [] for c in wanted}
    for i, (column, share) in enumerate(asked):
        if i not in found:
            out[column].append(None)
            continue
        place = share * (sizes[column] - 1)
        low, high = found[i]
        out[column].append(low + (high - low) * (place - math.floor(place)))
    return out


def _ranged(table: DataFrame, order: list[str]) -> DataFrame:
    """`table` stored in consecutive ranges of an order, numbered by `_range`.

    Spark samples the cuts, so neither the plan nor what reaches the driver grows with the
    rows.  Rows that are equal in the order share a range.
    """
    columns = [F.col(f"`{n}`") for n in order]
    return materialize(table.repartitionByRange(*columns).withColumn("_range", F.spark_partition_id()), "ranged")


def running_totals(table: DataFrame, by: str, totals: list[str], group: str | None = None,
                   limit: int = SMALL) -> DataFrame:
    """`table` plus, for each column of `totals`, its sum over all smaller `by`.

    `by` must be unique within `group`.  Added columns: `<total>_before`, and
    `next_value`, the following `by` of the group.  A table beyond `limit` rows is
    sorted into value ranges that are summed on their own and then shifted by the
    totals of the ranges below.
    """
    keys = [group] if group else []
    n = table.count()
    if n <= limit:
        span = W.partitionBy(*keys).orderBy(by)
        before = span.rowsBetween(W.unboundedPreceding, -1)
        return table.withColumns(
            {f"{t}_before": F.coalesce(F.sum(t).over(before), F.lit(0).cast("long")) for t in totals}
            | {"next_value": F.lead(by).over(span)})
    ranged = _ranged(table, [*keys, by])
    # One row per range and group at most.
    sums = ranged.groupBy(*keys, "_range").agg(
        *[F.sum(t).alias(f"_{t}") for t in totals], F.min(by).alias("_first"))
    below = W.partitionBy(*keys).orderBy("_range")
    offsets = sums.select(
        *keys, "_range",
        *[F.coalesce(F.sum(f"_{t}").over(below.rowsBetween(W.unboundedPreceding, -1)),
                     F.lit(0).cast("long")).alias(f"_{t}_offset") for t in totals],
        F.lead("_first").over(below).alias("_next_first"))
    joined = ranged.join(F.broadcast(offsets), [*keys, "_range"])
    span = W.partitionBy(*keys, "_range").orderBy(by)
    before = span.rowsBetween(W.unboundedPreceding, -1)
    joined = joined.withColumns(
        {f"{t}_before": F.col(f"_{t}_offset")
         + F.coalesce(F.sum(t).over(before), F.lit(0).cast("long")) for t in totals}
        | {"next_value": F.coalesce(F.lead(by).over(span), F.col("_next_first"))})
    return joined.drop("_range", "_next_first", *[f"_{t}_offset" for t in totals])


def value_ranks(df: DataFrame, column: str, limit: int = SMALL) -> DataFrame:
    """One row per distinct value: `n`, `n_before` and the shared average rank."""
    counts = (df.filter(F.col(f"`{column}`").isNotNull())
              .groupBy(F.col(f"`{column}`").alias("_value")).agg(F.count("*").alias("n")))
    ranked = running_totals(counts, "_value", ["n"], limit=limit)
    return ranked.withColumn("avg_rank", F.col("n_before") + (F.col("n") + 1) / 2)


def with_average_rank(df: DataFrame, column: str, out: str, descending: bool = False,
                      percent: bool = False, limit: int = SMALL) -> DataFrame:
    """Add the mean rank of tied values (optionally descending, or over n).

    Null values keep a null rank and do not count.  `df` should be a stored table.
    Beyond `limit` rows the distinct values are ranked range by range and joined
    back; a value shared by many rows is a hot key there and treated as such.
    """
    value = F.col(f"`{column}`")
    total = df.agg(F.count(value).alias("n")).first()["n"]
    if total <= limit:
        first = F.rank().over(W.orderBy(value.asc_nulls_last()))
        ties = F.count(value).over(W.partitionBy(value))
        ranked = df.withColumn("_rank", F.when(value.isNotNull(), first + (ties - 1) / 2))
    else:
        ranks = materialize(value_ranks(df, column, limit).select(
            F.col("_value").alias(column), "n", F.col("avg_rank").alias("_rank")), "ranks")
        ranked = attach(df, ranks, column, "n")
    rank = (F.lit(total + 1) - F.col("_rank")) if descending else F.col("_rank")
    return ranked.withColumn(out, rank / total if percent else rank).drop("_rank")


def with_row_rank(df: DataFrame, by: list[str], out: str, limit: int = SMALL) -> DataFrame:
    """Number all rows 1..n in the order of `by` (a total order of the rows).

    Beyond `limit` rows they are sorted into ranges of the order; each range is numbered where it is
    sorted, in the one shuffle, and shifted by the rows in the ranges below.
    """
    columns = [F.col(f"`{n}`") for n in by]
    n = df.count()
    if n <= limit:
        return df.withColumn(out, F.row_number().over(W.orderBy(*columns)).cast("long"))
    # The task in the upper bits, the place of the row in it in the lower 33.
    ranged = materialize(df.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn(
        "_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)), "ranged")
    below = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_range").agg(F.count("*").alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(below), F.lit(0).cast("long")))
               .drop("_n"))
    place = F.col("_at").bitwiseAND(F.lit(2 ** 33 - 1)) + 1
    return (ranged.join(F.broadcast(offsets), "_range")          # a row per range
            .withColumn(out, (F.col("_offset") + place).cast("long"))
            .drop("_at", "_range", "_offset"))


def split_rules(df: DataFrame, by: list[str], count: int, limit: int = SMALL) -> tuple[Column, Column]:
    """Predicates for the first `count` rows in the order of `by`, and for the others.

    One pass counts the rows per value of the leading column, which is all it reads; whole
    keys are compared only where that column has the value at the cut.  So either predicate
    has a bound of the leading column, which file scans use.
    """
    if count <= 0:
        return F.lit(False), F.lit(True)
    lead = F.col(f"`{by[0]}`")
    counts = materialize(df.groupBy(lead).agg(F.count("*").alias("n")), "lead-counts")
    cut = select_ranks(counts, [by[0]], [count], "n", limit)[0]
    value, inside = cut["key"][0], count - cut["before"]
    if value is None:                                     # the cut lies among rows without a value
        rule = rank_at_most(df, by, count, limit)
        return rule, ~F.coalesce(rule, F.lit(False))
    until = F.lit(value).cast(df.schema[by[0]].dataType)
    first, rest = lead <= until, lead > until
    if inside < cut["equal"]:
        before = (lead < until) | rank_at_most(df.filter(lead == until), by, inside, limit)
        first, rest = first & before, (lead >= until) & ~before
    if not counts.filter(lead.isNull()).isEmpty():        # null comes first
        first = first | lead.isNull()
    return first, rest


def rank_at_most(df: DataFrame, by: list[str], count: int, limit: int = SMALL) -> Column | None:
    """A predicate that keeps the first `count` rows in the order of `by`.

    No row is numbered: the key at position `count` is selected and compared.
    `by` must tell the rows apart; rows with equal keys stay together.
    """
    if count <= 0:
        return F.lit(False)
    cut = select_ranks(df, by, [count], limit=min(limit, SMALL_ROWS))[0]
    return _key(by) <= _literal_key(df, by, cut["key"])
