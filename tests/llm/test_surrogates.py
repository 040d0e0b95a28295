"""Surrogates: coreference, distinctness, formats and clean texts."""

import ipaddress
import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from tillgrain.llm import pii
from tillgrain.llm.common import prepare

KEY = "test key"


def made(text, key=KEY):
    return pii.Replacer(key).replace(text)


def name(word, key=KEY):
    return pii._as(pii.name_surrogate(pii.folded(word), key), word)


@pytest.mark.parametrize("text, names, count", [
    ("Mr. Smith came. Later Smith left, and Smith's car.", ["Smith"], 3),
    ("Anna Smith said: Anna Smith. Anna smiled at ANNA SMITH", ["Anna", "Smith", "ANNA", "SMITH"], 4),
    ("Иван Петров or Mr. Петров; ПЕТРОВ", ["Иван", "Петров", "ПЕТРОВ"], 3),
    ("MR. SMITH met Mrs. O'Brien and O’Brien's son", ["SMITH", "O'Brien", "O’Brien"], 3),
    ("Bob Miller, Wei Zhang, Priya Patel", ["Bob", "Miller", "Wei", "Zhang", "Priya", "Patel"], 3),
    ("my name is Zorblax Quux. Quux it is", ["Zorblax", "Quux"], 2),
    ("John F. Kennedy and Hans von Bülow-Maier; Maier", ["John", "Kennedy", "Hans", "Bülow", "Maier"], 3),
])
def test_every_mention_of_a_person(text, names, count):
    """Against plain replacement of the names that stand in the text."""
    want = text
    for k, word in enumerate(sorted(names, key=len, reverse=True)):
        want = want.replace(word, f"\0{k}\0")
    for k, word in enumerate(sorted(names, key=len, reverse=True)):
        want = want.replace(f"\0{k}\0", name(word))
    assert made(text) == (want, count)
    assert not any(word in made(text)[0] for word in names)


@pytest.mark.parametrize("text", [
    "", "  \n", "Anna smiled at the Smith", "Mr. President spoke", "the anna smith of old, 3.14 and 2001", "std::abc 12:30:45",
    "Dear all, the Quick Brown Fox", "mr smith went",
])
def test_clean_texts_stay(text):
    assert made(text) == (text, 0)


def test_names_never_meet_and_never_stay():
    """All names of some formats, known and unknown ones, with a plain count."""
    short = ["".join(x) for x in itertools.product("abeéñß", "abcdeiou", "abcdeiou")]
    known = [n.lower() for names in pii.GIVEN.values() for n in names]
    random.seed(3)
    long = {"".join(random.choices("abcdeinorst", k=6)) for _ in range(3000)}
    names = sorted({*short, *known, *long})
    for key in ("a", "b"):
        found = [pii.name_surrogate(n, key) for n in names]
        assert len(set(found)) == len(names)
        assert all(a != b and len(a) == len(b) or a in pii._listed for a, b in zip(names, found))
    assert len({pii.name_surrogate("smith", str(k)) for k in range(50)}) > 40


def test_given_names_keep_gender_and_script():
    for names in pii.GIVEN.values():
        assert sorted(name(n) for n in names) == sorted(names) and all(name(n) != n for n in names)


def test_a_name_does_not_depend_on_the_corpus(spark, docs):
    """The same row gets the same text alone and among others."""
    row = docs.limit(1).withColumn("text", F.lit("Mr. Smith wrote to smith@example.com"))
    others = docs.withColumn("text", F.concat(F.lit("Mrs. "), F.initcap("lang"), F.lit("son and Mr. Smithers")))
    alone = {r["text"] for r in pii.anonymize(row, KEY).collect()}
    assert alone < {r["text"] for r in pii.anonymize(row.unionAll(others), KEY).collect()}


def test_collisions_over_a_corpus(spark):
    prepare(spark)
    texts = spark.range(2000).select(F.concat(F.lit("Mr. "), F.initcap(F.translate(
        F.format_string("%05d", "id"), "0123456789", "abcdefghij")), F.lit(" and Anna Smith")).alias("text"))
    names = pii.person_names(texts)
    assert names.count() == 2002 and pii.collisions(names, KEY).isEmpty()


def test_addresses():
    text, count = made("jürgen.müller@exämple.de, 2001:db8::1, 2001:0db8:0000:0000:0000:0000:0000:0001")
    mail, short, long = text.split(", ")
    assert count == 3 and mail.endswith(".de") and [len(x) for x in mail.split("@")] == [13, 10]
    assert "jürgen" not in mail and "exämple" not in mail
    assert short != "2001:db8::1" and short.startswith("2001:") and long.count("0000") == 5
    assert ipaddress.ip_address(short) == ipaddress.ip_address(long)
    hosts = {made(f"fe80::{k:x}")[0] for k in range(1, 3000)}
    assert len(hosts) == 2999


@pytest.mark.parametrize("text", ["a" * 300_000 + "1@", "é" * 300_000 + " Mr. Éa", "Mr. Smith met Anna Ross. " * 10_000,
                                  "a.b-" * 60_000 + "1", "2001:" * 50_000, "Anna " * 60_000])
def test_long_texts_in_linear_time(text):
    start = time.time()
    pii.Replacer(KEY).replace(text)
    assert time.time() - start < 10


def test_tables(spark, docs, nothing):
    """Null and empty texts, repeated rows and an empty table; other columns stay."""
    rows = pii.anonymize(docs.withColumn("_new", F.lit(1)), KEY)
    assert rows.columns == [*docs.columns, "_new", "n_entities"]
    want = [(r["doc_id"], *((None, 0) if r["text"] is None else made(r["text"]))) for r in docs.collect()]
    got = [(r["doc_id"], r["text"], r["n_entities"]) for r in rows.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert pii.anonymize(nothing, KEY).count() == 0
    assert pii.person_names(nothing).count() == 0
