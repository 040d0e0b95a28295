"""From raw documents to packed training sequences, stage by stage.

Each stage gets what its predecessor kept, as stored Parquet, and its decisions take effect.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillgrain.llm import decontaminate, langid, minhash, packing, pii
from tillgrain.llm.catalog import PII_KEY, tokenizer
from tillgrain.llm.common import free_name, prepare, table
from tillgrain.session import delete_path, materialize, scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language model accepts go (no letters, or unlike any language)."""
    prepare(spark)
    detector = langid.fit(docs)
    found = free_name(docs, "_found")
    return docs.withColumn(found, langid.detect(F.col("text"), detector)).filter(
        ~F.col(found)["rejected"]).drop(found)


def row_key(docs: DataFrame) -> Column:
    """A key of a row's whole content, as ids may be null or repeated; equal rows share it."""
    kinds = dict(docs.dtypes)
    return F.xxhash64(*[F.col(f"`{c}`").cast("string") if "map<" in kinds[c] else F.col(f"`{c}`")
                        for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, that with the smallest id (null comes last).

    Rows that are equal in all columns are one group, too.
    """
    prepare(spark)
    row = free_name(docs, "_row")
    rows = docs.withColumn(row, row_key(docs))
    with scratch(spark) as scope:
        found = minhash.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
        named = rows.select(F.col(row).alias("row"), "doc_id").join(
            found.select(F.col("doc_id").alias("row"), "component_id"), "row")
        kept = scope.keep(named.groupBy("component_id").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")).alias("first")).select(
            F.col("first.row").alias(row)), "kept-rows")
        repeated = scope.keep(rows.groupBy(row).count().filter("count > 1").select(row), "repeated-rows")
    stay = rows.join(kept, row, "left_semi")
    if repeated.isEmpty():
        return stay.select(*docs.columns)
    alone = stay.join(repeated, row, "left_anti")
    return alone.unionAll(stay.join(repeated, row, "left_semi").dropDuplicates([row])).select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, whatever their id."""
    prepare(spark)
    row = free_name(docs, "_row")
    rows = docs.withColumn(row, row_key(docs))
    with scratch(spark) as scope:
        found = decontaminate.overlaps(rows.select(F.col(row).alias("doc_id"), "text"),
                                       table(spark, sf_dir, "benchmark"))
        found = scope.keep(found.select(F.col("doc_id").alias(row)).distinct(), "leaks")
    return rows.join(found, row, "left_anti").select(*docs.columns)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates; every document stays."""
    prepare(spark)
    return pii.anonymize(docs, PII_KEY, free_name(docs, "n_entities")).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("private_data", private_data),
    ("sequences", sequences),
]

# Models, tokenizers and similarity links are beyond SQL; tests/llm holds the stages against plain rules.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is stored and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark) as scope:
            docs = scope.keep(stage(spark, docs, sf_dir), f"stage-{name}")
        # What the stage has read is not needed any more.
        if before:
            delete_path(spark, before)
        before = docs.inputFiles()[0].rsplit("/", 1)[0]
    return docs
