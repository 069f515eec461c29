"""Snapshots: a capture's home page with its frames, and the same-site pages it links to, as joins with a page store."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.text import n_char, n_words, page_text
from strandline.functions.urls import page_type, priority, resolve_frame, resolve_link
from strandline.values import DATA_SOURCE, SEPARATOR, Options


def _with_children(nodes: DataFrame, children: DataFrame, level: int) -> DataFrame:
    """Content of the nodes of a level: own text, then its children's texts that aren't empty, joined, in order."""
    key = ["root", *(f"p{i}" for i in range(1, level + 1))]
    texts = children.where("content <> ''").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col(f"p{level + 1}").alias("p"), "content"))).alias("below"))
    joined = nodes.join(texts, key, "left")
    return joined.withColumn("content", F.concat("content", F.coalesce(F.array_join(F.transform("below", lambda x: x["content"]), SEPARATOR), F.lit("")))).drop("below")


def page_content(homes: DataFrame, store: DataFrame, options: Options = Options()) -> tuple[DataFrame, DataFrame]:
    """((root, content), (root, link)) of the home pages ``homes`` (root), frames followed to the options' depth.

    A fixed number of joins: one for each level of frames.
    """
    parsed = store.select(F.col("url").alias("node"), page_text(F.col("segments"), options.max_repeats).alias("content"), "links", "frames")
    level = homes.select("root", F.col("root").alias("node")).distinct().join(parsed, "node")
    levels = [level]
    for i in range(1, options.frame_depth):
        keep = ["root", *(f"p{k}" for k in range(1, i))]
        sources = levels[-1].select(*keep, "node", F.posexplode("frames").alias(f"p{i}", "src"))
        inner = sources.select(*keep, f"p{i}", resolve_frame(F.col("src"), F.col("node")).alias("node"))
        levels.append(inner.join(parsed, "node"))
    links = None
    for found in levels:
        own = found.select("root", "node", F.explode("links").alias("href"))
        own = own.select("root", resolve_link(F.col("href"), F.col("node"), options.excluded_domains).alias("link")).where("link IS NOT NULL")
        links = own if links is None else links.unionByName(own)
    content = levels[-1]
    for i in range(len(levels) - 2, -1, -1):
        content = _with_children(levels[i], content, i)
    return content.select("root", "content"), links.distinct()


def snapshots(captures: DataFrame, store: DataFrame, options: Options = Options()) -> DataFrame:
    """(wayback_url, snap_url, snap_content, is_home): pages of each capture, equal contents once (the home page first, then by url).

    A capture whose home page isn't in the store gives one row with empty content.
    """
    homes = captures.select(F.col("wayback_url").alias("root")).distinct()
    content, links = page_content(homes, store, options)
    home = homes.join(content, "root", "left").select("root", F.col("root").alias("snap_url"), F.coalesce("content", F.lit("")).alias("snap_content"), F.lit(True).alias("is_home"))
    pages = store.select(F.col("url").alias("link"), page_text(F.col("segments"), options.max_repeats).alias("snap_content"))
    sub = links.where("link <> root").join(pages, "link").select("root", F.col("link").alias("snap_url"), "snap_content", F.lit(False).alias("is_home"))
    return first_of_content(home.unionByName(sub), "root", "snap_content", F.col("is_home").desc(), "snap_url").select(F.col("root").alias("wayback_url"), "snap_url", "snap_content", "is_home")


def first_of_content(rows: DataFrame, group: str, content: str, *order) -> DataFrame:
    """Of the rows of a group with equal content the first in ``order``."""
    (n,) = [c for c in ("_n", "__n", "___n") if c not in rows.columns][:1]
    once = Window.partitionBy(group, content).orderBy(*order)
    return rows.withColumn(n, F.row_number().over(once)).where(F.col(n) == 1).drop(n)


def by_priority(pages: DataFrame, group: str, *then) -> DataFrame:
    """``pages`` (with ``page_type``) and their ``place`` in the group: the more important categories first."""
    return pages.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(priority(F.col("page_type")), *then)))


def page_rows(captures: DataFrame, snaps: DataFrame) -> DataFrame:
    """Page records of captures (with the candidate's columns) and their snapshots; empty pages are left out."""
    stage = F.col("stage").cast("int") if "stage" in captures.columns else F.lit(2)
    joined = captures.join(snaps.where("snap_content <> ''"), "wayback_url")
    return joined.select(
        "candidate", "state", "district", "office", F.col("year").cast("int").alias("year"), "party", stage.alias("stage"), F.col("timestamp").alias("date"),
        F.col("website_url").alias("urlkey"), "snap_url", page_type(F.col("snap_url")).alias("page_type"), F.lit(DATA_SOURCE).alias("data_source"),
        F.lit(0).alias("n_tags"), F.lit(0).alias("n_clean_tags"), F.col("snap_content").alias("text_snap_content"),
        n_char(F.col("snap_content")).alias("n_char"), n_words(F.col("snap_content")).alias("n_words"),
    )


def progress_rows(captures: DataFrame, failed: bool = False) -> DataFrame:
    """Progress records: finished captures, empty ones and failed ones included, so that none is tried again."""
    return captures.select(F.col("wayback_url").alias("url"), "candidate", "state", "office", "year", F.lit(0 if failed else 1).alias("scrape_complete"), F.lit(int(failed)).alias("scrape_error"))


def status_counts(progress: DataFrame) -> DataFrame:
    """Captures finished, failed and in all."""
    return progress.agg(F.count("*").alias("n"), F.coalesce(F.sum("scrape_complete"), F.lit(0)).alias("n_complete"), F.coalesce(F.sum("scrape_error"), F.lit(0)).alias("n_failed"))


def longest_snapshot(pages: DataFrame, key=("candidate", "state", "office", "year")) -> DataFrame:
    """Of each candidate the page with the most characters (ties: date, then url)."""
    order = Window.partitionBy(*key).orderBy(F.col("n_char").desc(), "date", "snap_url")
    return pages.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def page_type_shares(pages: DataFrame, kind: str = "page_type") -> DataFrame:
    """Count and share of each category; the total is a window over the handful of categories."""
    counts = pages.groupBy(kind).agg(F.count("*").alias("n"))
    return counts.select(kind, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))
