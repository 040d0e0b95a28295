"""Overlaps at the declared threshold, against plain versions that look at every place."""

import itertools
import random

import pytest

from tillgrain.llm import decontaminate
from tillgrain.llm.common import prepare


def _least_hits(n, m):
    """The least number of mask hits over all choices of m of n words."""
    states = {(0, 0): 0}
    for _ in range(n):
        after = {}
        for (last, chosen), hits in states.items():
            for bit in range(min(1, m - chosen) + 1):
                k = last.bit_count()
                key = (last << 1 | bit) & 15, chosen + bit
                after[key] = min(after.get(key, 10**9), hits + bit * k * (k - 1) // 2)
        states = after
    return min(hits for (_, chosen), hits in states.items() if chosen == m)


def test_masks_meet_every_choice_at_the_threshold():
    chosen = {tuple(i for i, bit in enumerate(m) if bit == "1") for m in decontaminate.MASKS}
    assert chosen == {(0, a, b) for a, b in itertools.combinations(range(1, 5), 2)}
    for n in range(decontaminate.LEAST_WORDS, 130):
        assert _least_hits(n, max(decontaminate.LEAST_WORDS, -(-n // 2))) >= (1 if n == decontaminate.LONE else 2)


def _overlaps(spark, docs, items):
    prepare(spark)
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.overlaps(docs, items).collect()}


def _aligned(doc, item):
    """The most equal words over all shifts."""
    return max(sum(0 <= s + q < len(doc) and doc[s + q] == w for q, w in enumerate(item))
               for s in range(-len(item), len(doc)))


def test_substituted_words_up_to_the_threshold(spark):
    draw, docs, items, want = random.Random(5), [], [], {}
    for n in [8, 9, 11, 13, 15, 16, 17, 18, 18, 18, 19, 20, 24, 25, 30, 38, 59] * 6:
        item, k = [f"i{len(items)}w{j}" for j in range(n)], len(items)
        least = max(8, -(-n // 2))
        kept = set(draw.sample(range(n), least - draw.choice([0, 0, 1])))
        if k % 6 == 0:
            kept = set(list(range(0, n, 2))[:least])           # every second word
        if n == 18 and k % 3 == 0:
            kept = {0, 1, 5, 6, 10, 11, 15, 16, 17}
        body = [w if j in kept else f"x{k}y{j}" for j, w in enumerate(item)]
        doc = [f"b{k}z{j}" for j in range(draw.randrange(20))] + body + ["end"] * draw.randrange(3)
        items.append((k, " ".join(item)))
        docs.append((k, " ".join(doc)))
        if _aligned(doc, item) >= least:
            want[k, k] = _aligned(doc, item)
    assert len(want) > 50
    assert {k: r["matched"] for k, r in _overlaps(spark, docs, items).items()} == want


@pytest.mark.parametrize("case,matched", [
    ("passage", 29), ("long passage", 150), ("inserted", 15), ("deleted", 12), ("short", None),
    ("scattered", None), ("once", None)])
def test_passages_and_moved_parts(spark, case, matched):
    n = {"passage": 59, "long passage": 400, "inserted": 15, "deleted": 15, "short": 59, "scattered": 59, "once": 30}[case]
    item = [f"w{j}" for j in range(n)]
    body = {"passage": item[10:39], "long passage": item[100:250], "short": item[10:22],
            "inserted": item[:5] + ["new"] + item[5:10] + ["more"] + item[10:],
            "deleted": item[:4] + item[5:9] + item[10:14],
            "scattered": sum((item[j:j + 4] + ["x"] * 60 for j in range(0, 59, 8)), []),
            "once": ["a", "b", "c"]}[case]
    if case == "once":
        item = ["a", "b", "c"] * 10                 # three words of a document are no thirty of an item
    found = _overlaps(spark, [(1, " ".join(["before", "it", *body, "after"]))], [(7, " ".join(item))])
    assert {k: r["matched"] for k, r in found.items()} == ({(1, 7): matched} if matched else {})


def test_null_and_repeated_ids(spark):
    item = " ".join(f"w{j}" for j in range(20))
    half = " ".join(f"w{j}" for j in range(8))
    rest = " ".join(f"w{j}" for j in range(12, 19))
    found = _overlaps(spark, [(None, item), (None, "nothing"), (2, half), (2, rest), (3, "no"), (3, item)], [(7, item)])
    assert {k: r["matched"] for k, r in found.items()} == {(None, 7): 20, (3, 7): 20}


def test_repetitive_text_takes_seconds(spark):
    """Every word of the item stands everywhere in the document."""
    import time
    for count, held in ((400, 400), (400, 300), (60, 2000)):
        docs = spark.createDataFrame([(1, " ".join(["0"] * held))], "doc_id long, text string")
        items = spark.createDataFrame([(1, " ".join(["0"] * count))], "item_id long, text string")
        begun = time.time()
        found = decontaminate.overlaps(docs, items).collect()
        assert [(r["matched"], r["item_words"]) for r in found] == [(min(count, held), count)]
        assert time.time() - begun < 60
