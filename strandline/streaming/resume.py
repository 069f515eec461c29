"""Incremental runs: a stream of captures, scraped batch by batch against the progress log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.operators.captures import not_done
from strandline.operators.snapshots import page_rows, progress_rows, snapshots
from strandline.values import Options


def scrape(captures: DataFrame, store: DataFrame, done: DataFrame, options: Options = Options()) -> tuple[DataFrame, DataFrame]:
    """(page rows, progress rows) of the captures that aren't done."""
    fresh = not_done(captures, done, "wayback_url")
    return page_rows(fresh, snapshots(fresh, store, options)), progress_rows(fresh)


def scrape_stream(captures: DataFrame, store: Callable[[], DataFrame], done: Callable[[], DataFrame], pages_path: str, progress_path: str, checkpoint: str) -> StreamingQuery:
    """Scrapes each new batch of captures; all that is there is worked off, then the query ends.

    A batch that runs again overwrites its own folder, so pages and progress are written once.
    """

    def work(batch: DataFrame, number: int) -> None:
        pages, finished = scrape(batch, store(), done().where(F.col("batch") != number) if "batch" in done().columns else done())
        pages.write.mode("overwrite").parquet(f"{pages_path}/batch={number}")
        finished.write.mode("overwrite").parquet(f"{progress_path}/batch={number}")

    return captures.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
