"""Second labelling of the pages that their url says nothing about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.text import first_words, parse_label, prompt
from strandline.functions.urls import original_url, url_pattern
from strandline.values import Options


def other_pages(pages: DataFrame, options: Options = Options()) -> DataFrame:
    """(snap_url_pattern, original_url, text_excerpt, source_file): the longest text of each url pattern (ties: file, then url)."""
    own = original_url(F.col("snap_url"))
    rows = pages.where("page_type = 'other'").select(url_pattern(own).alias("snap_url_pattern"), own.alias("original_url"), F.coalesce("text_snap_content", F.lit("")).alias("text"), "source_file")
    order = Window.partitionBy("snap_url_pattern").orderBy(F.length("text").desc(), "source_file", "original_url", "text")
    longest = rows.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return longest.select("snap_url_pattern", "original_url", first_words(F.col("text"), options.excerpt_words).alias("text_excerpt"), "source_file")


def not_labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    return pages.join(labels.select("snap_url_pattern").distinct(), "snap_url_pattern", "left_anti")


def ask(pages: DataFrame, answers: DataFrame, max_errors: int = Options.max_errors) -> DataFrame:
    """Labels from a table of answers (prompt, answer, maybe error); pages without an answer are left for later, as are those with an error.

    In the order of url patterns, labelling stops at the error after the first ``max_errors``.
    """
    asked = pages.withColumn("prompt", prompt(F.col("original_url"), F.col("text_excerpt"))).join(answers, "prompt")
    if "error" in answers.columns:
        first = asked.where("error IS NOT NULL").select("snap_url_pattern").orderBy("snap_url_pattern").limit(max_errors + 1)
        seen = first.agg(F.count("*").alias("n"), F.max("snap_url_pattern").alias("last")).first()
        asked = asked.where("error IS NULL")
        asked = asked.where(F.col("snap_url_pattern") < seen["last"]) if seen["n"] > max_errors else asked
    return asked.select("snap_url_pattern", parse_label(F.col("answer")).alias("page_type_llm"))


def label_with(pages: DataFrame, scorer: Column) -> DataFrame:
    """Labels from an expression over (original_url, text_excerpt): the plug for any scorer."""
    return pages.select("snap_url_pattern", parse_label(scorer).alias("page_type_llm"))


def cost(pages: DataFrame, options: Options = Options()) -> DataFrame:
    each = (options.tokens_in * options.dollars_in + options.tokens_out * options.dollars_out) / 1e6
    return pages.agg(F.count("*").alias("n_pages"), (F.count("*") * F.lit(each)).alias("dollars"))


def preview(pages: DataFrame, n: int = 10) -> DataFrame:
    return pages.orderBy("snap_url_pattern").limit(n).select("snap_url_pattern", F.substring("text_excerpt", 1, 80).alias("text"))


def final_page_type(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``pages`` with ``final_page_type``: the label of the page's url pattern if there is one, else the url's category.

    Of several labels the last by ``labelled_at`` counts, where the labels have it (ties, and without it: the least); null ones don't.
    """
    known = labels.where("page_type_llm IS NOT NULL").groupBy(F.col("snap_url_pattern").alias("_pattern"))
    if "labelled_at" in labels.columns:
        early = F.coalesce(-F.col("labelled_at").cast("double"), F.lit(float("inf")))
        last = known.agg(F.min(F.struct(early, F.col("page_type_llm").alias("label")))["label"].alias("_label"))
    else:
        last = known.agg(F.min("page_type_llm").alias("_label"))
    keyed = pages.withColumn("_key", url_pattern(original_url(F.col("snap_url"))))
    return keyed.join(last, F.col("_key") == F.col("_pattern"), "left").withColumn("final_page_type", F.coalesce("_label", "page_type")).drop("_key", "_pattern", "_label")
