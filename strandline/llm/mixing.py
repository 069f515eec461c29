"""Mixing sources to target weights by Poisson replication, in SQL functions only.

A source with ``n`` rows and target weight ``w`` gets the repetition rate ``w * epochs * total / n``. Each row
inverts a Poisson distribution of that mean at a uniform number hashed from the seed, its id, its text and its repeat
number, is exploded into that many copies, and all copies are dealt to partitions and sorted there by a hash of the same
and the copy's number: a global shuffle that any run repeats. Copies are made before the shuffle, so a row's copies part.

A distribution is a table of its cumulated terms, from ten deviations below the mean to ten above it: under 2^-52 is left
on either side. So it has some 20 * sqrt(rate) terms, fewer than the copies that a row of that rate makes.

Skew: counts are pre-aggregated; the distributions meet the rows by a broadcast only while they have at most
``MOST_TERMS`` terms (counted first), else by a join salted over ``SALTS`` keys; the shuffle key never is the source. Rows that
are equal in all columns are found by a narrow count of their hashes; only these are grouped (which sends a row for each
task and different row) and numbered.

Defined cases: a null source is a source of its own; null ids hash as the text ``null``, so rows with null or equal ids are
told apart by their texts, and rows equal in all columns by their repeat numbers; an empty table stays empty; all
columns pass through (they must be groupable: no maps), but a column of the name of ``copy`` or ``shuffle_key`` (parameters) gives
way to the new one. A rate below about 5 leaves some rows without a copy, as a Poisson count may be 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.shared import cut, free

SEED = 17
#: Weight of a source: its share to this power, normalised. 1 keeps the shares, 0 makes them equal.
TEMPERATURE = 0.7
EPOCHS = 1.0
#: Terms of all distributions (8 bytes each), and hashes of repeated rows (8 bytes each), that are broadcast at most.
MOST_TERMS = 1_000_000
MOST_REPEATED = 250_000
SALTS = 64
#: Copies of a row that are exploded at once.
CHUNK = 10_000


def _hashed(seed: int, key: str, text: str, repeat: str, *more) -> Column:
    """MD5, in hexadecimal, of the seed, the row's id, its text's MD5, its repeat number and ``more``."""
    own = F.coalesce(F.md5(F.col(text).cast("string").cast("binary")), F.lit("null"))
    parts = [F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("null")), own, F.col(repeat).cast("string"), *more]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def uniform(digest: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def with_cdf(rates: DataFrame, by: str = "_source") -> DataFrame:
    """(``by``, first, cdf) of each row with a ``rate`` above 0: P(count <= k) for k = first, first + 1, ...

    The first term is e^-rate, or that of a count of 256 or more by Stirling's series, exact to 1e-15 there.
    """
    spread = rates.where("rate > 0").select(by, "rate", F.expr("floor(rate - 10 * sqrt(rate) - 24)").alias("low"), F.expr("cast(ceil(rate + 10 * sqrt(rate)) + 24 as bigint)").alias("last"))
    begun = spread.select(by, "rate", "last", F.when(F.col("low") >= 256, F.col("low").cast("long")).otherwise(F.lit(0).cast("long")).alias("first"))
    terms = begun.select(by, "rate", "first", F.explode(F.sequence("first", "last")).alias("k"))
    log = F.expr("CASE WHEN k > first THEN ln(rate) - ln(k) WHEN first = 0 THEN -rate ELSE k * ln(rate / k) + (k - rate) - 0.5 * ln(2 * pi() * k) - 1 / (12D * k) + 1 / (360D * k * k * k) END")
    up_to = Window.partitionBy(by).orderBy("k")
    summed = terms.withColumn("log", F.sum(log).over(up_to)).withColumn("c", F.sum(F.exp("log")).over(up_to))
    gathered = summed.groupBy(by).agg(F.min("first").alias("first"), F.array_sort(F.collect_list(F.struct("k", "c"))).alias("cdf"))
    return gathered.select(by, "first", F.transform("cdf", lambda x: x["c"]).alias("cdf"))


def source_rates(docs: DataFrame, source: str = "source", weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, epochs: float = EPOCHS) -> DataFrame:
    """(source, n_rows, weight, rate): a row for each source. ``weights`` are normalised; a source not in them gets 0."""
    counts = docs.groupBy(F.col(source).alias("_source")).agg(F.count("*").alias("n_rows"))
    if weights is None:
        raw = F.pow(F.col("n_rows").cast("double"), F.lit(temperature))
    else:
        raw = F.coalesce(*(F.when(F.col("_source") == k, F.lit(float(v))) for k, v in weights.items()), F.lit(0.0))
    weighed = cut(counts.withColumn("raw", raw))
    sums = weighed.agg(F.coalesce(F.sum("raw"), F.lit(0.0)).alias("raw"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows")).first()
    weight = F.col("raw") / F.lit(sums["raw"] or 1.0)
    return weighed.select("_source", "n_rows", weight.alias("weight"), (weight * epochs * F.lit(sums["rows"]) / F.col("n_rows")).alias("rate"))


def _repeats(df: DataFrame, n: str, chunk: str, into: str) -> DataFrame:
    """Each row ``n`` times, numbered from 1 in ``into``; ``CHUNK`` numbers lie in memory at a time."""
    chunks = df.withColumn(chunk, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / CHUNK).cast("long"))))
    numbers = F.sequence(F.col(chunk) * CHUNK + 1, F.least(F.col(n).cast("long"), (F.col(chunk) + 1) * CHUNK))
    return chunks.withColumn(into, F.explode(numbers)).drop(chunk)


def with_repeat_number(docs: DataFrame, into: str) -> DataFrame:
    """``docs`` with 1, 2, ... for the rows that are equal in all columns: 1 for a row that no other equals."""
    digest, n, chunk = free(docs.withColumn(into, F.lit(1)), "_hash", "_n", "_chunk")
    keyed = docs.withColumn(digest, F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    repeated = cut(keyed.groupBy(digest).agg(F.count("*").alias(n)).where(F.col(n) > 1).select(digest))
    few = repeated.limit(MOST_REPEATED + 1).count()
    if not few:
        return docs.withColumn(into, F.lit(1).cast("long"))
    if few <= MOST_REPEATED:
        repeated = F.broadcast(repeated)
    ones = keyed.join(repeated, digest, "left_anti").select(*docs.columns, F.lit(1).cast("long").alias(into))
    groups = keyed.join(repeated, digest, "left_semi").groupBy(*(F.col(f"`{c}`") for c in docs.columns)).agg(F.count("*").alias(n))
    # the numbers of a large group are dealt out by chunks, so that no task writes it alone
    dealt = groups.withColumn(chunk, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / CHUNK).cast("long")))).repartition(chunk, *docs.columns)
    many = dealt.withColumn(into, F.explode(F.sequence(F.col(chunk) * CHUNK + 1, F.least(F.col(n), (F.col(chunk) + 1) * CHUNK))))
    return ones.unionByName(many.select(*docs.columns, into))


def mix_sources(docs: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text", weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, epochs: float = EPOCHS, seed: int = SEED, copy: str = "copy", shuffle_key: str = "shuffle_key") -> DataFrame:
    """``docs`` replicated to the target weights, with ``copy`` (1, 2, ...) and ``shuffle_key``, globally shuffled."""
    of, first, cdf, deal, salt, at, n, repeat, chunk = free(docs, "_source", "_first", "_cdf", "_deal", "_salt", "_u", "_copies", "_repeat", "_part")
    rates = cut(with_cdf(source_rates(docs, source, weights, temperature, epochs)).select(F.col("_source").alias(of), F.col("first").alias(first), F.col("cdf").alias(cdf)))
    terms = rates.agg(F.coalesce(F.sum(F.size(cdf)), F.lit(0)).alias("n")).first()["n"]
    rows = with_repeat_number(docs, repeat).withColumn(at, _hashed(seed, key, text, repeat))
    if terms <= MOST_TERMS:
        joined = rows.join(F.broadcast(rates), F.col(source).eqNullSafe(F.col(of)))
    else:
        salted = rates.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = rows.withColumn(deal, F.pmod(F.xxhash64(at), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, F.col(source).eqNullSafe(F.col(of)) & (F.col(deal) == F.col(salt))).drop(deal, salt)
    counted = joined.withColumn(at, uniform(F.col(at))).withColumn(n, F.col(first) + F.size(F.filter(cdf, lambda c: c <= F.col(at)))).drop(of, first, cdf, at).where(F.col(n) > 0)
    copies = _repeats(counted, n, chunk, copy).drop(n).withColumn(copy, F.col(copy).cast("int"))
    digest = _hashed(seed, key, text, repeat, F.lit("shuffle"), F.col(copy).cast("string"))
    keyed = copies.withColumn(shuffle_key, F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")).drop(repeat)
    return keyed.repartition(shuffle_key).sortWithinPartitions(shuffle_key, copy)


def oracle(seed: int = SEED, temperature: float = TEMPERATURE, epochs: float = EPOCHS) -> str:
    """DuckDB's form of ``mix_sources`` over ``documents``."""
    own = f"'{seed}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null') || ':' || repeat"
    return f"""
WITH c AS (SELECT source AS s, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT s, pow(n::DOUBLE, {temperature}) / (SELECT sum(pow(n::DOUBLE, {temperature})) FROM c) * {epochs} * (SELECT sum(n) FROM c) / n AS rate FROM c),
f AS (SELECT s, rate, CASE WHEN floor(rate - 10 * sqrt(rate) - 24) >= 256 THEN floor(rate - 10 * sqrt(rate) - 24)::BIGINT ELSE 0 END AS first FROM r),
t AS (SELECT s, rate, first, unnest(range(first, (ceil(rate + 10 * sqrt(rate)) + 25)::BIGINT)) AS k FROM f),
l AS (SELECT s, k, first, sum(CASE WHEN k > first THEN ln(rate) - ln(k) WHEN first = 0 THEN -rate
                            ELSE k * ln(rate / k) + (k - rate) - 0.5 * ln(2 * pi() * k) - 1 / (12.0 * k) + 1 / (360.0 * k * k * k) END) OVER (PARTITION BY s ORDER BY k) AS lp FROM t),
p AS (SELECT s, min(first) AS first, list(c ORDER BY k) AS cdf FROM (SELECT s, k, first, sum(exp(lp)) OVER (PARTITION BY s ORDER BY k) AS c FROM l) GROUP BY s),
d AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text, lang, source, n_chars) AS repeat FROM documents),
u AS (SELECT d.*, p.first + len(list_filter(p.cdf, lambda x: x <= ('0x' || substr(md5({own}), 1, 13))::BIGINT / 4503599627370496.0)) AS m
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.s)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, ('0x' || substr(md5({own} || ':shuffle:' || copy), 1, 15))::BIGINT AS shuffle_key
FROM (SELECT *, unnest(range(1, m + 1)) AS copy FROM u WHERE m > 0)"""
