"""Scans and sinks of the engine's tables. Reads are Spark's, with declared schemas; nothing is inferred."""

from __future__ import annotations

import io
import itertools
import zipfile
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline import schemas
from strandline.values import Options


def election_cycle(year: int) -> int:
    return year + year % 2


def file_order() -> Column:
    """Where a row stands in its files: orders the rows of a scan as the files have them, over files and their splits."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))


def candidates(spark: SparkSession, path: str, unpacked: str | None = None) -> DataFrame:
    """Raw candidate file: pipe-separated, Latin-1, no header; rows with too many fields are dropped, short ones padded.

    Of a ``.zip`` file the first member named ``*.txt`` is read; its lines are kept in the table ``unpacked`` and taken from there the next time.
    """
    names = schemas.CANDIDATES_RAW + ", _extra string"
    if path.endswith(".zip"):
        lines = unzip_lines(spark, path, unpacked)
        parsed = lines.select("file", "line", F.from_csv("value", names, {"sep": "|", "quote": '"', "mode": "PERMISSIVE"}).alias("r"))
        raw = parsed.select("r.*", F.struct("file", F.lit(0).cast("long").alias("start"), F.col("line").alias("row")).alias("ordinal"))
    else:
        raw = spark.read.schema(names).csv(path, sep="|", encoding="ISO-8859-1", mode="PERMISSIVE", quote='"').withColumn("ordinal", file_order())
    return raw.where("_extra IS NULL").drop("_extra")


def unzip_lines(spark: SparkSession, path: str, unpacked: str | None = None) -> DataFrame:
    """(file, line, value): lines of the first ``*.txt`` member of each archive, streamed; archives without one have none."""
    schema = "file string, line long, value string"

    def lines(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                    member = next((n for n in archive.namelist() if n.endswith(".txt")), None)
                    if member is None:
                        continue
                    with archive.open(member) as raw:
                        text = enumerate(x.rstrip("\r\n") for x in io.TextIOWrapper(raw, "latin-1", newline="\n"))
                        while some := list(itertools.islice(text, 10_000)):
                            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array([i for i, _ in some], pa.int64()), pa.array([x for _, x in some], pa.string())], names=["file", "line", "value"])

    if unpacked and exists(spark, unpacked):
        return spark.read.schema(schema).parquet(unpacked)
    found = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(lines, schema)
    if not unpacked:
        return found.where("value <> ''")
    found.where("value <> ''").write.parquet(unpacked)
    return spark.read.schema(schema).parquet(unpacked)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there; a written table counts once it is whole."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.exists(at) and (not store.getFileStatus(at).isDirectory() or store.exists(jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS")))


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first path that is there: for files whose names have several spellings."""
    return next((p for p in paths if exists(spark, p)), paths[-1])


def roster(spark: SparkSession, path: str) -> DataFrame:
    """District stays text, so that its zeros survive."""
    return spark.read.schema(schemas.ROSTER).csv(path, header=True, multiLine=True, escape='"').fillna("")


def captures(spark: SparkSession, path: str) -> DataFrame:
    """Capture index lines: four fields parted by spaces; other lines are dropped."""
    parts = F.split("value", " ", 4)
    lines = spark.read.text(path).withColumn("ordinal", file_order())
    return lines.where(F.size(parts) == 4).select(*(parts[i].alias(n) for i, n in enumerate(("timestamp", "original_url", "statuscode", "mimetype"))), "ordinal")


def page_rows(spark: SparkSession, path: str, office: str | None = None, year: int | None = None, finished: DataFrame | None = None) -> DataFrame:
    """Page records, partitioned by office and year (which prune), with their file.

    With the progress log ``finished``, records of batches that it doesn't have are left out: their run was stopped and is repeated.
    """
    df = spark.read.option("ignoreCorruptFiles", "true").parquet(path).withColumn("source_file", F.col("_metadata.file_path"))
    df = df.where(F.col("office") == office) if office else df
    df = df.where(F.col("year") == year) if year else df
    if finished is None or "batch" not in df.columns:
        return df
    whole = finished.select(F.col("batch").cast("string").alias("_batch")).distinct()
    return df.join(whole, F.col("batch").cast("string") == F.col("_batch"), "left_semi")


def progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PROGRESS).parquet(path).select("url").distinct()


def url_cache(cache: DataFrame, now: float, ttl_days: int = Options.ttl_days, ordinal: str = "ordinal") -> DataFrame:
    """Entries not past their time, of each key the last in the file. An empty url is a known miss."""
    from pyspark.sql import Window

    fresh = cache if ttl_days <= 0 else cache.where(F.lit(now) - F.col("cached_at").cast("double") <= ttl_days * 86400)
    last = Window.partitionBy("candidate", "state", "year").orderBy(F.col(ordinal).desc())
    return fresh.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def write_roster(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("office", "year").parquet(path)


def append_pages(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Page records of a run; ``batch`` names it, so that its records count once the progress log has it."""
    named = df if batch is None else df.withColumn("batch", F.lit(batch))
    named.write.mode("append").partitionBy("office", "year", *(["batch"] if batch is not None else [])).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Progress, url cache and labels: appended, later rows win where a key repeats."""
    df.write.mode("append").parquet(path)


def write_candidate_csv(pages: DataFrame, path: str, file_rows: int = 1_000_000) -> None:
    """Page records as CSV with a header, in a folder for each office, year and candidate (``<candidate> (<state>)``), by date within a file."""
    named = pages.withColumn("file", F.concat("candidate", F.lit(" ("), "state", F.lit(")")))
    placed = named.repartition("office", "year", "file").sortWithinPartitions("office", "year", "file", "date", "snap_url")
    placed.write.mode("overwrite").option("header", True).option("escape", '"').option("maxRecordsPerFile", file_rows).partitionBy("office", "year", "file").csv(path)
