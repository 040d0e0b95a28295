"""Stages of the pipeline on rows whose ids are null or repeated."""

import collections
import tracemalloc

import corpus_pipeline
import numpy as np
import pandas as pd

from tests.llm.conftest import ROWS
from tillgrain.llm import langid


def _rows(found):
    return collections.Counter((r["doc_id"], r["text"]) for r in found.collect())


def test_near_duplicates_decide_by_row(spark, docs):
    left = list(ROWS)
    left = [r for r in left if r[0] not in (2, 7)]              # copies of 1 and 6
    left.remove(next(r for r in left if r[0] == 10))            # the same row twice
    assert _rows(corpus_pipeline.near_duplicates(spark, docs, "")) == collections.Counter(
        (i, t) for i, t, *_ in left)


def test_benchmark_leaks_decide_by_row(spark, docs, tmp_path):
    gone = [(None, "nobody knows this row, +1 (705) 555-6638 or x.y@example.com"), (9, "a" * 350)]
    spark.createDataFrame([(k, t) for k, (_, t) in enumerate(gone)], "item_id long, text string") \
        .write.parquet(str(tmp_path / "benchmark.parquet"))
    want = collections.Counter((i, t) for i, t, *_ in ROWS)
    want.subtract(gone)
    assert _rows(corpus_pipeline.benchmark_leaks(spark, docs, str(tmp_path))) == +want


def _peak(run):
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_language_works_on_a_bounded_number_of_characters(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(w) for w in rng.choice(["the", "fox", "jumps", "über", "lazy", "dog", "soon"], (500, 400))]
    frame = pd.DataFrame({"lang": "en", "text": texts})
    (counted,), counting = _peak(lambda: list(langid._count([frame])))
    models = langid.Models(["en"], {"en": (counted["key"].to_numpy().view(np.uint64), counted["n"].to_numpy())})
    scored, scoring = _peak(lambda: models.entropies(texts))
    assert max(counting, scoring) < 25                  # MB; 41 and 54 before runs were bounded
    monkeypatch.setattr(langid, "CHARS", 10 ** 9)
    (whole,) = langid._count([frame])
    assert whole.equals(counted)
    assert all(np.array_equal(a, b) for a, b in zip(scored, models.entropies(texts)))
    assert list(langid.runs(["", "a" * 10])) == [(0, 2)] and list(langid.runs([])) == []


def test_sequences_need_no_plain_python_workers(spark, docs, monkeypatch):
    """They would stay beside the Arrow functions' workers and take memory in every later stage."""
    def parallelize(*_):
        raise AssertionError("a list went through a Python RDD")
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", parallelize)
    found = corpus_pipeline.sequences(spark, docs, "")
    assert found.select("doc_id").distinct().count() == len({r[0] for r in ROWS})
