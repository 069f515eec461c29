"""Rosters: candidates from the raw file, and their websites through an ordered chain of lookup tables.

A source with a cache is not asked for rows that the cache has: an entry, empty or not, ends that source, and an empty one
passes the row on to the next. A source that fails is skipped.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.text import clean_name, words
from strandline.functions.urls import committee_url
from strandline.schemas import COMMITTEE_ANSWER
from strandline.values import PARTIES, Options

LOG = logging.getLogger(__name__)
KEY = ["candidate", "state", "district"]


class UrlSource(Protocol):
    """A lookup: ``urls`` gives (roster_id, url) for the rows it knows; an empty url is a known miss."""

    name: str

    def is_available(self) -> bool: ...

    def urls(self, roster: DataFrame) -> DataFrame: ...


def small(df: DataFrame, most: int = Options.broadcast_rows, most_bytes: int = Options.broadcast_bytes) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows and ``most_bytes`` of text; measured, not assumed."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c, kind in df.dtypes if kind == "string"), F.lit(8).cast("long") * len(df.columns))
    found = df.limit(most + 1).agg(F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if found["rows"] <= most and found["bytes"] <= most_bytes else df


def build_roster(raw: DataFrame, year: int, office: str) -> DataFrame:
    """The office's candidates of the two parties, one for each (name, state, district): the first in the file."""
    if office not in ("house", "senate"):
        raise ValueError(f"unknown office: {office}")
    party = F.create_map(*(F.lit(x) for kv in PARTIES.items() for x in kv))
    kept = raw.where((F.col("cand_office") == ("H" if office == "house" else "S")) & F.col("cand_pty_affiliation").isin(*PARTIES))
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = kept.select(
        clean_name(F.col("cand_name")).alias("candidate"), F.col("cand_office_st").alias("state"), empty("cand_office_district").alias("district"),
        F.lit(office).alias("office"), F.lit(year).cast("int").alias("year"), F.try_element_at(party, F.col("cand_pty_affiliation")).alias("party"),
        F.lit("").alias("website_url"), empty("cand_name").alias("raw_name"), empty("cand_pcc").alias("cand_pcc"), empty("cand_id").alias("cand_id"), "ordinal",
    )
    first = Window.partitionBy(*KEY).orderBy("ordinal")
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def committees_from_json(answers: DataFrame) -> DataFrame:
    """(pcc, website) from a lookup service's JSON answers (pcc, body): the first result's website, empty where there is none."""
    first = F.get(F.from_json("body", COMMITTEE_ANSWER)["results"], 0)["website"]
    return answers.select("pcc", F.trim(F.coalesce(first, F.lit(""))).alias("website"))


class CommitteeSource:
    """Websites by the trimmed committee id; blank ids know nothing."""

    name = "committees"

    def __init__(self, committees: DataFrame | None):
        self.committees = committees

    def is_available(self) -> bool:
        return self.committees is not None

    def urls(self, roster: DataFrame) -> DataFrame:
        known = self.committees.groupBy(F.trim("pcc").alias("_pcc")).agg(F.min("website").alias("website"))
        ids = roster.select("roster_id", F.trim("cand_pcc").alias("_pcc")).where("_pcc <> ''")
        return ids.join(known, "_pcc").select("roster_id", committee_url(F.coalesce("website", F.lit(""))).alias("url"))


class NameSource:
    """Websites by last name and the first three letters of the first name; the first match in the knowledge base's order.

    Entries without a website or a name are no match.
    """

    name = "names"

    def __init__(self, websites: DataFrame | None, labels: DataFrame | None, broadcast_rows: int = Options.broadcast_rows):
        self.websites, self.labels, self.broadcast_rows = websites, labels, broadcast_rows

    def is_available(self) -> bool:
        return self.websites is not None and self.labels is not None

    def urls(self, roster: DataFrame) -> DataFrame:
        known = self.websites.where("website <> ''").join(self.labels, "qid").select(F.lower(F.try_element_at(words(F.col("name")), F.lit(-1))).alias("last_name"), F.lower("name").alias("known_name"), "website", "ord")
        parts = words(F.col("candidate"))
        wanted = roster.select("roster_id", F.lower(F.try_element_at(parts, F.lit(-1))).alias("last_name"), F.substring(F.lower(F.try_element_at(parts, F.lit(1))), 1, 3).alias("start"))
        found = wanted.join(small(known, self.broadcast_rows), "last_name").where(F.col("known_name").contains(F.col("start")))
        return found.groupBy("roster_id").agg(F.min(F.struct("ord", "website")).alias("first")).select("roster_id", F.col("first.website").alias("url"))


class CachedSource:
    """A source before which its own fresh cache (candidate, state, year, url) is asked."""

    def __init__(self, source: UrlSource, cache: DataFrame | None):
        self.source, self.cache, self.name = source, cache, source.name

    def is_available(self) -> bool:
        return self.source.is_available()

    def _hits(self, roster: DataFrame) -> DataFrame:
        keyed = self.cache.select("candidate", "state", F.col("year").cast("int").alias("year"), "url")
        return roster.select("roster_id", "candidate", "state", "year").join(keyed, ["candidate", "state", "year"]).select("roster_id", "url")

    def urls(self, roster: DataFrame) -> DataFrame:
        if self.cache is None:
            return self.source.urls(roster)
        hits = self._hits(roster)
        return hits.unionByName(self.source.urls(roster.join(hits.select("roster_id"), "roster_id", "left_anti")).select("roster_id", "url"))

    def new_entries(self, roster: DataFrame, found: DataFrame, now: float) -> DataFrame:
        """Cache entries for the rows of ``roster`` that the cache didn't have, with what was ``found`` for them: empty urls too."""
        asked = roster if self.cache is None else roster.join(self._hits(roster).select("roster_id"), "roster_id", "left_anti")
        answers = found.select(F.col("roster_id").alias("_id"), "url")
        joined = asked.join(answers, F.col("roster_id") == F.col("_id"), "left")
        return joined.select("candidate", "state", F.col("year").cast("string").alias("year"), F.coalesce("url", F.lit("")).alias("url"), F.lit(str(now)).alias("cached_at"))


def fill_urls(roster: DataFrame, sources: Sequence[UrlSource], hold: Callable[[DataFrame], DataFrame] | None = None, told: Callable[[UrlSource, DataFrame, DataFrame], None] | None = None) -> DataFrame:
    """``roster`` (with ``roster_id``) with its website and ``url_source``: of the available sources in order the first that isn't empty.

    ``hold`` writes a table and reads it again: then a source is asked only for rows that still miss a website, one that fails while it
    is read is skipped as well, and ``told`` is called with each source, the rows it was asked for and what it found.
    """
    given = F.coalesce("website_url", F.lit(""))
    out = roster.withColumns({"website_url": given, "url_source": F.when(given != "", "given")})
    for source in sources:
        if not source.is_available():
            LOG.warning("%s: not available", source.name)
            continue
        try:
            missing = out.where("website_url = ''") if hold else roster
            found = source.urls(missing).select("roster_id", "url")
            found = hold(found) if hold else found
            if told:
                told(source, missing, found)
        except Exception:
            LOG.exception("%s: failed, skipped", source.name)
            continue
        answers = found.groupBy(F.col("roster_id").alias("_id")).agg(F.max("url").alias("_url"))
        fills = (F.col("website_url") == "") & (F.coalesce("_url", F.lit("")) != "")
        joined = out.join(answers, F.col("roster_id") == F.col("_id"), "left")
        out = joined.select(*(c for c in out.columns if c not in ("website_url", "url_source")), F.when(fills, F.col("_url")).otherwise(F.col("website_url")).alias("website_url"), F.when(fills, F.lit(source.name)).otherwise(F.col("url_source")).alias("url_source"))
        out = hold(out) if hold else out
    return out.select(*roster.columns, "url_source")


def source_counts(filled: DataFrame, sources: Sequence[UrlSource]) -> DataFrame:
    """(place, source, missing_before, found, missing_after) of each source of a filled roster, in one pass over it."""
    names = [s.name for s in sources]
    sums = filled.agg(F.count_if((F.col("website_url") == "") | (F.col("url_source") != "given")).alias("start"), *(F.count_if(F.col("url_source") == n).alias(f"f{i}") for i, n in enumerate(names)))
    before = F.col("start")
    rows = []
    for i, n in enumerate(names):
        after = before - F.col(f"f{i}")
        rows.append(F.struct(F.lit(i).alias("place"), F.lit(n).alias("source"), before.alias("missing_before"), F.col(f"f{i}").alias("found"), after.alias("missing_after")))
        before = after
    return sums.select(F.inline(F.array(*rows)))


def finish_roster(roster: DataFrame) -> DataFrame:
    """Rows with a website, without the helper columns."""
    return roster.where("website_url <> ''").drop("raw_name", "cand_pcc", "cand_id", "ordinal", "roster_id", "url_source")


def missing(roster: DataFrame) -> DataFrame:
    return roster.agg(F.count("*").alias("n"), F.count_if(F.col("website_url") == "").alias("n_missing"))
