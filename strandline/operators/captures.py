"""Capture selection: filters, limits, time buckets, stratified samples. Each window has a site or url key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.urls import archive_url, dedup_url
from strandline.values import Options


def election_year(year: Column) -> tuple[Column, Column]:
    """First and last day of the year as text."""
    return F.concat(year.cast("string"), F.lit("0101")), F.concat(year.cast("string"), F.lit("1231"))


def select_captures(captures: DataFrame, start: Column, end: Column, most: int = Options.max_captures) -> DataFrame:
    """Good HTML captures of the days [start, end], the first ``most`` of each url, with their archive url."""
    good = captures.where(F.substring("timestamp", 1, 8).between(start, end) & (F.col("statuscode") == "200") & (F.col("mimetype") == "text/html"))
    each = Window.partitionBy("original_url").orderBy("timestamp", "ordinal")
    return good.withColumn("_n", F.row_number().over(each)).where(F.col("_n") <= most).drop("_n").withColumn("wayback_url", archive_url(F.col("timestamp"), F.col("original_url")))


def at_limit(captures: DataFrame, most: int = Options.max_captures) -> DataFrame:
    """(original_url, n): urls with ``most`` captures or more, whose selection may be cut short."""
    return captures.groupBy("original_url").agg(F.count("*").alias("n")).where(F.col("n") >= most)


def bucket(timestamp: Column, months: int) -> Column:
    """``<year>Q<bucket>`` with buckets of some months, from 0."""
    at = F.floor((F.substring(timestamp, 5, 2).cast("int") - 1) / months).cast("string")
    return F.concat(F.substring(timestamp, 1, 4), F.lit("Q"), at)


def bucket_dedup(captures: DataFrame, months: int = 3) -> DataFrame:
    """Of each url and bucket the latest capture, of equally late ones the first seen."""
    each = Window.partitionBy(dedup_url(F.col("original_url")), bucket(F.col("timestamp"), months)).orderBy(F.col("timestamp").desc(), "ordinal")
    return captures.withColumn("_n", F.row_number().over(each)).where("_n = 1").drop("_n")


def stratified_sample(captures: DataFrame, most: int, site: str = "site") -> DataFrame:
    """At most ``most`` captures of a site, taken in turn from its months; sites with no more keep all."""
    month = F.substring("timestamp", 1, 6)
    in_month = Window.partitionBy(site, month).orderBy("timestamp", "ordinal")
    in_turn = Window.partitionBy(site).orderBy("_k", month)
    return captures.withColumn("_k", F.row_number().over(in_month)).withColumn("_g", F.row_number().over(in_turn)).where(F.col("_g") <= most).drop("_k", "_g")


def in_order(captures: DataFrame, site: str = "site") -> DataFrame:
    """Captures by time within each site; a site's rows lie together, and nothing is sorted over all sites."""
    return captures.repartition(site).sortWithinPartitions(site, "timestamp", "ordinal")


def not_done(rows: DataFrame, done: DataFrame, url: str, done_url: str = "url") -> DataFrame:
    """Rows whose url is not in the progress log."""
    return rows.join(done.select(F.col(done_url).alias("_done")).distinct(), F.col(url) == F.col("_done"), "left_anti")
