"""The star-schema test tables as retail transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_single_file(df: DataFrame) -> DataFrame:
    """A small table of one file has few reader tasks; spread its rows over the cores.

    Tables of many files, as on a cluster, are left as they are, and so is a file that is read in parts.
    """
    width = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) != 1 or df.rdd.getNumPartitions() >= width:
        return df
    return df.repartition(width)


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order, customer, nation and part.

    Orders meet their customers before they meet the lines, which are many more.  Lines meet their parts while they
    are narrow, and their orders last: so a large join leaves the lines of an order side by side.
    """
    lines = spread_single_file(table(spark, sf_dir, "lineitem"))
    orders = table(spark, sf_dir, "orders")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    part = table(spark, sf_dir, "part")
    placed = (orders.join(customer, orders.o_custkey == customer.c_custkey)
              .join(nation, customer.c_nationkey == nation.n_nationkey))
    return (lines.join(part, lines.l_partkey == part.p_partkey)
            .join(placed, lines.l_orderkey == orders.o_orderkey))


def _stamp():
    hours = F.expr("make_dt_interval(0, cast(l_orderkey % 24 as int), 0, 0)")
    return F.col("o_orderdate").cast("timestamp") + hours


def plain_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clean, typed transaction line per order line."""
    return joined_lines(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("Invoice"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.col("l_quantity").alias("Quantity"),
        _stamp().alias("InvoiceDate"),
        F.col("l_extendedprice").alias("Price"),
        F.col("o_custkey").cast("string").alias("Customer ID"),
        F.col("n_name").alias("Country"))


SUFFIXES = [" box", " bag", " gift card", " mug", " lamp", " notebook", " toy", " pendant", ""]


def dirty_transactions(spark: SparkSession, sf_dir: str, copy: str | None = None) -> DataFrame:
    """Transaction lines as text, with gaps, bad values, returns and duplicates.

    `copy` names a column for the number of a line among its copies made here (0 or 1).
    """
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]),
                          (F.col("l_partkey") % 9 + 1).cast("int"))
    variant = F.when(line % 3 == 1, " red").when(line % 3 == 2, " set").otherwise("")
    base = joined_lines(spark, sf_dir).select(
        key.alias("_key"),
        key.cast("string").alias("Invoice"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.when((F.col("l_partkey") % 10 == 3) & (line == 1), F.lit(None).cast("string"))
        .otherwise(F.concat("p_name", suffix, variant)).alias("Description"),
        F.when((key % 89 == 0) & (line == 2), "n/a")
        .when(key % 97 == 0, (-F.col("l_quantity")).cast("string"))
        .otherwise(F.col("l_quantity").cast("string")).alias("Quantity"),
        F.when((key % 101 == 0) & (line == 4), "not a date")
        .otherwise(F.date_format(_stamp(), "yyyy-MM-dd HH:mm:ss")).alias("InvoiceDate"),
        F.when((key % 83 == 0) & (line == 3), "free")
        .otherwise(F.col("l_extendedprice").cast("string")).alias("Price"),
        F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey").cast("string")).alias("Customer ID"),
        F.when(key % 71 != 0, F.col("n_name")).alias("Country"))
    copies = F.when(F.col("_key") % 100 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = base.withColumn(copy or "_copy", F.explode(copies)).drop("_key")
    return out if copy else out.drop("_copy")
