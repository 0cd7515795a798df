"""Coverage ledger: how far a feed has been read without a gap.

A feed is fetched in windows of time, a window in pages of (start_index, results, total). A window is complete if its pages
reach from 0 to the total without a gap. The mark of a feed is the end of its gapless prefix of complete windows, so a missing page
is fetched again, however much that came later has landed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def windows_of(pages: DataFrame, keys: list[str]) -> DataFrame:
    """keys, pages, results, total, complete: one row per window. pages: keys, start_index, results, total; repeated and overlapping pages do no harm.

    A page without start_index starts at 0; where pages name different totals the greatest counts, and none is 0.
    """
    p = pages.select(*keys, F.coalesce("start_index", F.lit(0)).cast("long").alias("start_index"), F.coalesce("results", F.lit(0)).cast("long").alias("results"), F.coalesce("total", F.lit(0)).cast("long").alias("total"))
    before = Window.partitionBy(*keys).orderBy("start_index", "results").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.col("start_index") + F.col("results")).over(before), F.lit(0))
    gaps = p.withColumn("gap", F.col("start_index") > reach)
    out = gaps.groupBy(*keys).agg(F.count("*").alias("pages"), F.max(F.col("start_index") + F.col("results")).alias("results"), F.max("total").alias("total"), F.max("gap").alias("gap"))
    return out.withColumn("complete", ~F.col("gap") & (F.col("results") >= F.col("total"))).drop("gap")


def marks(windows: DataFrame, feed: str, low: str = "low", high: str = "high") -> DataFrame:
    """feed, windows, done, mark: windows in all, those of the gapless prefix, and the end of it (null: none).

    Windows are contiguous if each starts no later than the greatest end before it. One with an unknown bound ends the prefix.
    """
    order = Window.partitionBy(feed).orderBy(F.asc_nulls_last(low), high)
    reach = F.max(high).over(order.rowsBetween(Window.unboundedPreceding, -1))
    broken = ~F.col("complete") | F.col(low).isNull() | F.col(high).isNull() | (F.col(low) > F.coalesce(reach, F.col(low)))
    judged = windows.withColumn("__broken", broken).withColumn("__lost", F.max("__broken").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    good = ~F.col("__lost")
    return judged.groupBy(feed).agg(F.count("*").alias("windows"), F.count_if(good).alias("done"), F.max(F.when(good, F.col(high))).alias("mark"))


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """folder, start_index, results, total of the landed pages of a feed; the pages of one window lie in one folder."""
    pages = spark.read.schema("totalResults int, startIndex int, vulnerabilities array<struct<cve:struct<id:string>>>").option("multiLine", True).option("recursiveFileLookup", True).json(path)
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)
    return pages.select(folder.alias("folder"), F.col("startIndex").alias("start_index"), F.coalesce(F.size("vulnerabilities"), F.lit(0)).alias("results"), F.col("totalResults").alias("total"))


def all_landed(spark: SparkSession, path: str) -> bool:
    """True if no landed window lacks a page."""
    return windows_of(landed_pages(spark, path), ["folder"]).where("not complete").limit(1).count() == 0
