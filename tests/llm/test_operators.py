"""Each operator against a plain version, on edge rows, and on an empty table."""

import collections
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tillgrain.llm import (blockdedup, decontaminate, fingerprint, langid, minhash, packing, pii, quality,
                           suffixdedup, tokenfiles)
from tillgrain.session import scratch_path

from tests.llm.conftest import ROWS

KNOWN = sorted((i, t or "") for i, t, *_ in ROWS if i is not None)


def test_fingerprints(spark, docs, nothing):
    rows = fingerprint.edited_fingerprints(docs).collect()
    assert len(rows) == len(ROWS)
    by_text = collections.defaultdict(set)
    for r in fingerprint.fingerprints(docs).collect():
        by_text[r["n_chars"]].add(r["fingerprint"])
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert {r["fingerprint"] for r in rows if r["doc_id"] == 1} == {r["fingerprint"] for r in rows if r["doc_id"] == 2}
    assert fingerprint.edited_fingerprints(nothing).count() == 0
    parts = spark.createDataFrame([(1, "a b\nc d e f"), (2, "c d e f\na b"), (3, "c d e f"), (4, "a b")],
                                  "doc_id long, text string")
    prints = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(parts).collect()}
    assert prints[1] == prints[2]
    one = spark.createDataFrame([(prints[1], prints[3], prints[4])], "x string, y string, z string")
    assert one.select(fingerprint.delete(F.col("x"), F.col("y"))).first()[0] == prints[4]
    assert one.select(fingerprint.insert(F.col("y"), F.col("z"))).first()[0] == prints[1]


def test_decontamination(spark, docs, nothing):
    words = [f"term{i}" for i in range(40)]
    changed = [w if i % 6 else "other" for i, w in enumerate(words)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "one"), (3, None), (4, "")], "item_id long, text string")
    more = docs.select("doc_id", "text").unionAll(spark.createDataFrame(
        [(50, "before " + " ".join(changed) + " after"), (51, "term1 term5 term9")], "doc_id long, text string"))
    found = {(r["doc_id"], r["item_id"]): r["matched"] for r in decontaminate.overlaps(more, items).collect()}
    assert found == {(50, 1): 33, (8, 2): 1}
    assert decontaminate.overlaps(nothing, items).count() == 0
    assert decontaminate.overlaps(docs, items.limit(0)).count() == 0


def test_language(docs, nothing):
    detector = langid.fit(docs)
    rows = docs.select("text", langid.detect(F.col("text"), detector).alias("p")).select("text", "p.*").collect()
    assert all(r["lang_pred"] == "und" for r in rows if not re.search(r"[^\W\d_]", r["text"] or ""))
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert langid.fit(nothing).predict(["abc"])["lang_pred"].tolist() == ["und"]


def test_surrogates_keep_distinctness(docs, nothing):
    using = pii.Replacer("k")
    text = "Mr. Smith wrote ann.b1@mail7.example.com, 49.37.233.206 and 4863730426282943 to Anna Smith"
    made, count = using.replace(text)
    assert count == 5 and using.replace(text)[0] == made and len(made) > 40
    names = re.findall(r"Mr\. (\w+) .* (\w+)$", made)[0]
    assert names[0] == names[1] and "Smith" not in made and "4863730426282943" not in made
    values = {pii._letters(f"{i:03d}", "k", "t") for i in range(1000)}
    assert len(values) == 1000 and all(pii._letters(f"{i:03d}", "k", "t") != f"{i:03d}" for i in range(1000))
    rows = pii.anonymize(docs, "k").collect()
    assert len(rows) == len(ROWS) and sum(r["n_entities"] for r in rows) == 2
    assert pii.anonymize(nothing, "k").count() == 0


def test_block_dedup(docs, nothing):
    seen, want = {}, collections.Counter()
    for i, t in KNOWN:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        gone = set()
        for k in range(len(w) - 12):
            if seen.setdefault(tuple(w[k:k + 13]), i) < i:
                gone.update(range(k, k + 13))
        want[(i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))] += 1
    rows = blockdedup.remove_repeats(docs).filter("doc_id is not null").collect()
    assert collections.Counter(tuple(r) for r in rows) == want
    assert blockdedup.remove_repeats(nothing).count() == 0


def test_suffix_dedup(docs, nothing):
    seen, want = set(), collections.Counter()
    for i, t in KNOWN:
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k:k + 100] in seen:
                gone[k:k + 100] = b"\1" * 100
            seen.add(b[k:k + 100])
        spans = len(re.findall(b"\1+", bytes(gone)))
        want[(i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g))] += 1
    rows = suffixdedup.remove_repeats(docs).filter("doc_id is not null").collect()
    assert collections.Counter((*tuple(r)[:4], bytes(r["kept"])) for r in rows) == want
    assert suffixdedup.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_files(spark, docs, nothing, name):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(name))
    path, start, want = scratch_path(spark, "tokens"), 0, collections.Counter()
    tokenfiles.write_tokens(docs.filter("doc_id is not null"), path, public_tokenizers.path(name))
    for i, t in KNOWN:
        ids = library.encode(t, add_special_tokens=False).ids + [1]
        want[(i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        start += len(ids)
    assert collections.Counter(tuple(r) for r in tokenfiles.stored_documents(spark, path).collect()) == want
    empty = scratch_path(spark, "tokens")
    tokenfiles.write_tokens(nothing, empty, public_tokenizers.path(name))
    assert tokenfiles.stored_documents(spark, empty).count() == 0


def test_quality(spark, docs, nothing):
    good = [(i, f"plain words of text number {i} go on", 1) for i in range(60)]
    bad = [(100 + i, f"junk### words### {i} ###", 0) for i in range(60)]
    known = spark.createDataFrame(good + bad, "doc_id long, text string, label int")
    weights = quality.fit(known, known.select("doc_id", "label"))
    scores = {r["doc_id"]: r["score"] for r in quality.classify(known, weights).collect()}
    assert min(scores[i] for i, *_ in good) > max(scores[i] for i, *_ in bad)
    assert quality.classify(docs, weights).count() == len(ROWS)
    assert quality.classify(nothing, quality.fit(nothing, known.limit(0).select("doc_id", "label"))).count() == 0


def test_near_duplicates(docs, nothing):
    rows = minhash.near_duplicates(docs.filter("doc_id <> 9")).collect()
    groups = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert groups == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 10: 10}
    assert {r["doc_id"]: r["n_shingles"] for r in rows}[8] == 1
    assert minhash.near_duplicates(nothing).count() == 0


def _plain_components(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    group = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    return group


@pytest.mark.parametrize("block", [minhash.BLOCK, 900])
def test_near_copies_around_the_threshold(spark, docs, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)         # small: a band's members meet in many blocks
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    texts = {}
    for i in range(60):
        words = list(base)
        for k in rng.choice(120, rng.integers(1, 5), replace=False):
            words[k] = f"x{i}y{k}"
        texts[i] = " ".join(words)
    frame = spark.createDataFrame(list(texts.items()) + [(60, texts[7]), (60, texts[7])],
                                  "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(frame).collect()}
    assert found == _plain_components(texts | {60: texts[7]})


def test_packing(docs, nothing):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack(docs, path).collect()
    room = collections.defaultdict(list)
    for r in rows:
        room[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    ends = [r for r in rows if r["start"] + r["length"] == r["doc_tokens"]]
    assert len(ends) == len(ROWS)
    assert packing.pack(nothing, path).count() == 0
