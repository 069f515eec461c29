"""Command line: build a roster, scrape captures against a page store, label pages.

    python -m strandline.plans.cli roster --candidates FILE... --office house --years 2018 2024 --out DIR [--committees T] [--websites T --labels T] [--cache DIR] [--unpacked DIR]
    python -m strandline.plans.cli scrape --roster DIR --captures FILE --store T --office house --year 2020 --out DIR --progress DIR [--csv DIR]
    python -m strandline.plans.cli classify --pages DIR (--all | --office house [--year 2020]) --labels DIR --answers T [--progress DIR] [--dry-run]

Each takes --config FILE, a YAML file of ``Options``.
"""

from __future__ import annotations

import argparse
import logging
import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline import schemas
from strandline.functions.urls import dedup_url
from strandline.operators import captures as C
from strandline.operators import reclassify as R
from strandline.operators import roster as O
from strandline.operators import snapshots as S
from strandline.sources import tables
from strandline.sources.held import hold
from strandline.sources.html import page_store
from strandline.streaming.resume import scrape
from strandline.values import Options


LOG = logging.getLogger(__name__)


def _or_empty(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    """The table, or an empty one where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path) if path else spark.createDataFrame([], schema)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def years(first: int, last: int | None) -> list[int]:
    """Election years from first to last, every second one."""
    return list(range(first, (last or first) + 1, 2))


def roster(spark: SparkSession, a: argparse.Namespace, options: Options) -> None:
    read = lambda p: spark.read.parquet(p) if p else None
    now = time.time()
    sources = [O.CommitteeSource(read(a.committees)), O.NameSource(read(a.websites), read(a.labels), options.broadcast_rows)]
    written: dict[str, list[DataFrame]] = {}
    for year in years(a.years[0], a.years[-1]):
        cycle = tables.election_cycle(year)
        path = tables.first_existing(spark, [p.format(year=cycle, yy=f"{cycle % 100:02d}") for p in a.candidates])
        raw = tables.candidates(spark, path, f"{a.unpacked}/cn{cycle}" if a.unpacked else None)
        cached = [O.CachedSource(s, _cache(spark, a.cache, s.name, now, options)) if a.cache else s for s in sources]

        def told(source, asked: DataFrame, found: DataFrame) -> None:
            if a.cache:
                tables.append(source.new_entries(asked, found, now).withColumn("ordinal", F.monotonically_increasing_id()), f"{a.cache}/{source.name}")

        built = hold(O.build_roster(raw, year, a.office).withColumn("roster_id", F.struct(*O.KEY)).drop("ordinal"))
        filled = hold(O.fill_urls(built, cached, hold, told))
        O.source_counts(filled, cached).orderBy("place").show(truncate=False)
        tables.write_roster(O.finish_roster(filled), a.out)


def _cache(spark: SparkSession, path: str, name: str, now: float, options: Options) -> DataFrame:
    """The fresh entries of a source's cache, as they are now."""
    return hold(tables.url_cache(_or_empty(spark, f"{path}/{name}", schemas.URL_CACHE + ", ordinal long"), now, options.ttl_days))


def scrape_captures(spark: SparkSession, a: argparse.Namespace, options: Options) -> None:
    people = spark.read.schema(schemas.ROSTER).parquet(a.roster).where((F.col("office") == a.office) & (F.col("year") == a.year))
    start, end = C.election_year(F.lit(a.year))
    chosen = C.select_captures(tables.captures(spark, a.captures), start, end, options.max_captures)
    cut_short = C.at_limit(chosen, options.max_captures).count()
    if cut_short:
        LOG.warning("%d urls have %d captures or more; later ones are left out", cut_short, options.max_captures)
    # captures of the site, with or without www. and under either scheme
    site = lambda c: F.regexp_replace(dedup_url(c), "^https?://", "")
    found = people.withColumn("_site", site(F.col("website_url"))).join(chosen.withColumn("_site", site(F.col("original_url"))), "_site").drop("_site")
    done = _or_empty(spark, a.progress, schemas.PROGRESS)
    store = page_store(spark.read.schema(schemas.PAGE_STORE).parquet(a.store), suffixes=options.skip_suffixes)
    pages, finished = scrape(found, store, done, options)
    # The progress log comes last and names the batch: records of a batch that it doesn't have are not read.
    batch, finished = uuid.uuid4().hex, hold(finished)
    pages = hold(pages)
    tables.append_pages(pages, a.out, batch)
    if a.csv:
        tables.write_candidate_csv(pages, f"{a.csv}/{batch}")
    tables.append(finished.withColumn("batch", F.lit(batch)), a.progress)


def classify(spark: SparkSession, a: argparse.Namespace, options: Options) -> None:
    if not (a.all or a.office):
        raise SystemExit("give --all or --office")
    finished = _or_empty(spark, a.progress, schemas.PROGRESS) if a.progress else None
    pages = tables.page_rows(spark, a.pages, None if a.all else a.office, None if a.all else a.year, finished)
    todo = R.not_labelled(R.other_pages(pages, options), _or_empty(spark, a.labels, schemas.LABELS))
    if a.dry_run:
        R.preview(todo).show(truncate=False)
        R.cost(todo, options).show()
        return
    tables.append(R.ask(todo, spark.read.parquet(a.answers), options.max_errors).withColumn("labelled_at", F.current_timestamp()), a.labels)


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(required=True)
    p = commands.add_parser("roster")
    p.add_argument("--candidates", required=True, nargs="+", help="spellings of the path, text or zip; {year} stands for the even year, {yy} for its end")
    p.add_argument("--office", choices=["house", "senate"], required=True)
    p.add_argument("--years", type=int, nargs="+", required=True, help="first and last")
    for name in ("committees", "websites", "labels", "cache", "unpacked"):
        p.add_argument(f"--{name}")
    p.add_argument("--out", required=True)
    p.set_defaults(run=roster)
    p = commands.add_parser("scrape")
    for name in ("roster", "captures", "store", "office", "out", "progress"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--year", type=int, required=True)
    p.add_argument("--csv")
    p.set_defaults(run=scrape_captures)
    p = commands.add_parser("classify")
    for name, needed in (("pages", True), ("labels", True), ("answers", False), ("office", False), ("progress", False)):
        p.add_argument(f"--{name}", required=needed)
    p.add_argument("--year", type=int)
    p.add_argument("--all", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.set_defaults(run=classify)
    for p in commands.choices.values():
        p.add_argument("--config", help="YAML file of options")
    a = top.parse_args(arguments)
    a.run(spark or SparkSession.builder.appName("strandline").getOrCreate(), a, Options.load(a.config) if a.config else Options())


if __name__ == "__main__":
    main()
