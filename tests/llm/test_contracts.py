"""Results that the queries promise, held against plain versions over small tables."""

import collections
import hashlib
import math
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tillgrain.llm import catalog, fingerprint, langid, packing, quality
from tillgrain.llm.common import prepare
from tillgrain.session import scratch_path

from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"
ODD = ["ab-cd\n\n<|endoftext|>", "<|endoftext|>", "a\n\n\n<|endoftext|>\n\nb  c", "<|start", "x <|endoftext|><|endoftext|> y\n\n"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_around_added_tokens(name):
    from tillgrain.llm.tokenize import encoder
    made = encoder(public_tokenizers.path(name))
    for text, ids in zip(ODD, made.encode(ODD)):
        assert ids.tolist() == made.library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_met_again_stay_when_the_cache_is_full(name, monkeypatch):
    from tillgrain.llm import tokenize
    made, learned = tokenize.Encoder(public_tokenizers.path(name)), []
    learn = made._learn
    monkeypatch.setattr(made, "_learn", lambda pieces, led: learned.extend(pieces) or learn(pieces, led))
    monkeypatch.setattr(tokenize, "CACHE", 60)
    monkeypatch.setattr(tokenize, "FILL", 100)
    letters = "abcdefghijklmnopqrst"
    texts = [f"common, words stay.\nrare{a}{b} once{b}{a}q été{a}{b} {k}x{b}" for k, a in enumerate(letters) for b in letters]
    for text, ids in zip(texts, made.encode(texts)):
        assert ids.tolist() == made.library.encode(text, add_special_tokens=False).ids, text
    assert learned.count("common") == learned.count("words") == learned.count("stay") == 1
    assert len(made.keys[0]) + len(made.keys[1]) < 120


def test_packing_holds_every_id_once(spark, docs):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    more = [(100 + k, t) for k, t in enumerate(ODD)] + [(200 + k, "word " * (37 * k)) for k in range(30)]
    known = docs.filter("doc_id is not null").select("doc_id", "text").unionAll(
        spark.createDataFrame(more, "doc_id long, text string")).dropDuplicates(["doc_id"])
    rows = packing.pack(known, path).collect()
    library, texts = Tokenizer.from_file(path), {r["doc_id"]: r["text"] or "" for r in known.collect()}
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids, at = library.encode(text, add_special_tokens=False).ids + [1], 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            part = np.array(ids[at:at + r["length"]], "<u4")
            assert len(part) == r["length"] > 0 and zlib.crc32(part.tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    room = collections.defaultdict(list)
    for r in rows:
        room[r["sequence_id"]].append((r["offset"], r["length"]))
    used = 0
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        used += 2048 if at & (at - 1) else at                 # no padding at a power of two
    assert sum(r["length"] for r in rows) > 0.9 * used


def test_letters_decide_what_has_no_language(docs):
    detector = langid.fit(docs)
    texts = ["\U0001f600", "\U0001f600 123 !", "\U0001d4d0", "中", "", None, "1\n2"]
    assert [langid.symbols([t or ""])[0].tolist()[3:] != [] for t in texts] == [False, False, True, True, False, False, False]
    found = detector.predict([t or "" for t in texts])
    assert [p == "und" for p in found["lang_pred"]] == [True, True, False, False, True, True, True]


def test_language_of_held_out_documents(spark):
    prepare(spark)
    rows = catalog.op3_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.filter("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(held) > 30 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    crc = {r["doc_id"]: r["held_out"] for r in rows.collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in crc.items())


def test_kneser_ney_sums_to_one_and_follows_its_definition():
    texts = ["abra cadabra", "abracadabra abra", "bard"]
    keys, _ = langid.grams(*langid.symbols(texts))
    keys, counts = np.unique(keys, return_counts=True)
    levels = langid.kneser_ney(keys, counts)
    top = levels[-1]
    n = collections.Counter(dict(zip(keys.tolist(), counts.tolist())))
    once, twice = (sum(v == k for v in n.values()) for k in (1, 2))
    discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
    lower = dict(zip(levels[-2]["gram"].tolist(), np.exp(levels[-2]["p"]).tolist()))
    for key, p in zip(top["gram"].tolist(), np.exp(top["p"]).tolist()):
        same = [k for k in n if k >> 16 == key >> 16]
        total = sum(n[k] for k in same)
        weight = discount * len(same) / total
        assert p == pytest.approx((n[key] - discount) / total + weight * lower[key & ((1 << 48) - 1)])


def test_ftrl_steps_as_a_plain_loop():
    draw = np.random.default_rng(3)
    vectors = [(np.unique(draw.integers(0, 50, 6)), None) for _ in range(40)]
    vectors = [(at, draw.normal(0, 1, len(at))) for at, _ in vectors]
    labels = draw.integers(0, 2, 40).tolist()
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(j):
        if abs(z[j]) <= quality.L1:
            return 0.0
        return -(z[j] - math.copysign(quality.L1, z[j])) / ((quality.BETA + math.sqrt(n[j])) / quality.ALPHA + quality.L2)
    order = np.random.default_rng(5)
    for _ in range(quality.EPOCHS):
        for k in order.permutation(40):
            row = [*zip(vectors[k][0].tolist(), vectors[k][1].tolist()), (1 << quality.BITS, 1.0)]
            w = {j: weight(j) for j, _ in row}
            guess = 1 / (1 + math.exp(-max(-30, min(30, sum(w[j] * v for j, v in row)))))
            for j, v in row:
                slope = (guess - labels[k]) * v
                sigma = (math.sqrt(n[j] + slope * slope) - math.sqrt(n[j])) / quality.ALPHA
                z[j] += slope - sigma * w[j]
                n[j] += slope * slope
    made = quality.train(vectors, labels)
    for j in [*range(50), 1 << quality.BITS]:
        assert made[j] == pytest.approx(weight(j), abs=1e-5)


def test_edited_texts_and_their_fingerprints(spark, docs):
    known = docs.filter("doc_id is not null").select("doc_id", "text").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: r["text"] or "" for r in known.collect()}
    ids = sorted(texts)
    edited = {}
    for k, i in enumerate(ids):
        text, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        quarter = len(text) // 4
        edited[i] = text[:len(text) - quarter] + after[:quarter]
    fresh = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(
        spark.createDataFrame(list(edited.items()), "doc_id long, text string")).collect()}
    plain = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(known).collect()}
    for r in fingerprint.edited_fingerprints(known).collect():
        i = r["doc_id"]
        assert r["n_chars"] == len(texts[i])
        assert r["edited_sha256"] == hashlib.sha256(edited[i].encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (plain[i], fresh[i])
        assert (r["near_edited"] == 1.0) >= (texts[i] == edited[i])


CLASHING = ["_row", "_ROW_", "_new", "_found", "n_entities", "row", "component_id", "place"]


def test_stages_leave_other_columns_alone(spark, docs):
    wide = docs.withColumns({c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
                             for c in CLASHING})
    for name, stage in corpus_pipeline.STAGES[:2] + corpus_pipeline.STAGES[3:4]:
        kept = stage(spark, wide, SF)
        assert kept.columns == wide.columns, name
        rows = kept.select("doc_id", *CLASHING).collect()
        assert rows and all(r[c] == f"{c}:{'-' if r['doc_id'] is None else r['doc_id']}" for r in rows for c in CLASHING)


def test_stages_on_an_empty_table(spark, nothing):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0, name


def test_the_whole_pipeline(spark):
    """Every document that the stages keep lies in the sequences, and nothing else does."""
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    made = corpus_pipeline.run(spark, SF)
    kept = collections.Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    ends = made.filter(F.col("start") + F.col("length") == F.col("doc_tokens"))
    assert collections.Counter(r["doc_id"] for r in ends.collect()) == kept and 100 < len(kept) < 200


def test_no_near_copy_is_missed(spark):
    """Components over all documents of the small table against all pairs that share a shingle."""
    import itertools
    import re
    prepare(spark)
    sets, holders = {}, collections.defaultdict(list)
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        made = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
        sets[r["doc_id"]] = made
        for s in made:
            holders[s].append(r["doc_id"])
    shared = collections.Counter(p for ids in holders.values() if len(ids) > 1 for p in itertools.combinations(sorted(ids), 2))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    links = 0
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            links += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in catalog.op9_near_duplicates(
        spark, "/root/testdata/sf0.01").collect()}
    assert links > 50
    assert found == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}
