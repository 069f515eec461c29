"""Quality rules as a short-circuit cascade, in SQL functions only.

Each rule is a predicate that rejects a text. On a sample drawn over the whole table by a hash, each rule's cost
and selectivity (share rejected) are estimated, and the rules run in the order of rejections per cost inside one
``CASE``, which stops at the first that rejects. The order changes the cost, never the verdict: a row is
kept if no rule rejects it.

A rule's cost is what it adds to a row: the seconds of a job that evaluates it over the sample, repeated to ``WORK_BYTES``, less those
of a job that reads the same and evaluates nothing, the fastest of ``TRIES`` each. The metrics are columns of the result, so
they are computed for every row and are no rule's cost; what only a rule needs (the passes over letters, lines
and word forms) stands inside the cascade.

All metrics come from one pass over the row with array functions, without an explode or shuffle. Words are hashed once, a
3-word window is a hash of three such numbers; a text whose windows all differ is done there, and of others the (hash, position) pairs
are sorted, n log n in the text's length. A row's arrays are boxed: README.md gives the longest text tried.

Defined cases: null and empty texts have no words and every metric 0, and fail the base rules (under 50 words);
repeated rows each get a row; other columns pass through ``with_metrics``, but those named like a metric, ``_text``, ``_words`` or
``_windows`` give way.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.shared import Scratch, texts

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Rows of the sample on average; bytes of text that a timed job evaluates, about; times that it runs.
SAMPLE_ROWS = 500
WORK_BYTES = 4_000_000
TRIES = 3


@dataclass(frozen=True)
class Rule:
    """``rejects``: SQL over ``_text``, ``_words`` and the metrics of ``METRICS``; null counts as no."""

    name: str
    rejects: str


#: Bounds chosen loosely: what they reject is far outside running prose.
RULES = (
    Rule("symbols", "100 * n_symbols > 30 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 60 * greatest(size(split(_text, '\\n')), 5)"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    Rule("shouting", r"2 * length(regexp_replace(_text, r'[^\p{Lu}]+', '')) > length(regexp_replace(_text, r'[^\p{L}]+', '')) AND n_words >= 20"),
    Rule("few_forms", "n_words >= 100 AND pow(size(array_distinct(_words)), 2) < 2 * n_words"),
)
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def with_words(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("_text", texts(text)).withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))


def _windows() -> Column:
    """The hashes of all 3-word windows of ``_words``."""
    # regexp_extract_all's words hold no space, so windows are equal only if the words are.
    return F.expr("""
        CASE WHEN size(_words) < 4 THEN cast(array() AS array<bigint>) ELSE
          transform(array(transform(_words, w -> xxhash64(w))),
            h -> transform(sequence(0, size(h) - 3), i -> xxhash64(h[i], h[i + 1], h[i + 2])))[0] END""")


def _repeat_words() -> Column:
    """Words covered by 3-word windows that occur at least twice in the row.

    The windows' hashes are sorted with their positions; a window equal to a neighbour is a repeat; the words
    covered by the sorted starts p1 < p2 < ... are min(3, p2 - p1) + ... + 3.
    """
    return F.expr("""
        CASE WHEN size(array_distinct(_windows)) = size(_windows) THEN 0L ELSE
          aggregate(
            transform(array(
              array_sort(transform(_windows, (h, i) -> struct(h, i AS p)))),
              s -> array_sort(transform(
                filter(s, (x, j) -> (j > 0 AND s[j - 1].h = x.h) OR (j < size(s) - 1 AND s[j + 1].h = x.h)),
                x -> x.p)))[0],
            struct(0L AS n, -3 AS last),
            (a, p) -> struct(a.n + least(3, p - a.last) AS n, p AS last),
            a -> a.n) END""")


def with_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), and ``_text`` and ``_words``."""
    words = with_words(df, text).withColumn("_windows", _windows())
    # lines with a word, and of these the distinct ones: what is left are lines equal to an earlier one
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD))
    return words.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.regexp_replace("_text", r"[\x20\x09-\x0D]+", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _repeat_words(),
    }).drop("_windows")


def rejected_by(rule: Rule) -> Column:
    return F.coalesce(F.expr(rule.rejects), F.lit(False))


def _fastest(df: DataFrame, value: Column) -> float:
    """Seconds of a job that sums ``value`` over ``df``, the fastest of ``TRIES``."""
    took = []
    for _ in range(TRIES):
        began = time.perf_counter()
        df.agg(F.sum(value)).collect()
        took.append(time.perf_counter() - began)
    return min(took)


def order_rules(df: DataFrame, rules: tuple = RULES, text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """The rules by rejections per cost on a sample of about ``sample_rows`` whole rows, with their figures.

    Rules that reject nothing there come last, the cheapest first. ``cost`` is in seconds a row of the sample.
    """
    rows = df.count()
    if not rules or not rows:
        return [{"rule": r, "cost": 0.0, "rejects": 0.0} for r in rules]
    scratch = Scratch(df.sparkSession, "rules")
    # rows whose hash is in the least part of all hashes: the same ones in any run
    drawn = df.select(F.col(key), F.col(text)).where(F.xxhash64(F.col(key), texts(text)) <= min(-(2**63) + sample_rows * 2**64 // rows, 2**63 - 1))
    sample = scratch.cut(with_metrics(drawn.select(texts(text).alias("_text")), "_text"), sample_rows)
    first = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("size"), *(F.sum(rejected_by(r).cast("long")).alias(f"r{i}") for i, r in enumerate(rules))).first()
    n, repeats = max(first["n"], 1), max(1, min(1000, WORK_BYTES // max(first["size"], 1)))
    work = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    nothing = _fastest(work, F.length("_text") + F.size("_words"))
    out = []
    for i, rule in enumerate(rules):
        cost = max(_fastest(work, rejected_by(rule).cast("long") + F.length("_text") + F.size("_words")) - nothing, 1e-4)
        out.append({"rule": rule, "cost": cost / (n * repeats), "rejects": (first[f"r{i}"] or 0) / n})
    scratch.close()
    return sorted(out, key=lambda x: (-(x["rejects"] / x["cost"]), x["cost"]))


def cascade(ordered: list[Rule]) -> Column:
    """True where no rule rejects; rules after the first that does are not evaluated."""
    if not ordered:
        return F.lit(True)
    out = None
    for rule in ordered:
        out = F.when(rejected_by(rule), F.lit(False)) if out is None else out.when(rejected_by(rule), F.lit(False))
    return out.otherwise(F.lit(True))


def judge(df: DataFrame, rules: tuple = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row for each row: id, the metrics, base_failed and kept. One pass, no shuffle."""
    ordered = [x["rule"] for x in order_rules(df, rules, text, key)]
    # The words are written out before the metrics, and the metrics before the verdict, so that neither is computed twice.
    base = F.expr(BASE)
    out = with_metrics(df.select(key, text), text).withColumn("base_failed", base)
    return out.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(ordered))).drop(text, "_text", "_words")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dups FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g),
p AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS pos FROM c WHERE n > 1),
r AS (SELECT doc_id, count(*) AS reps FROM p GROUP BY doc_id),
m AS (SELECT d.doc_id, t, w, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(reps, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 60 * greatest(len(string_split(t, chr(10))), 5)
            OR word_chars < 2 * n_words OR word_chars > 14 * n_words
            OR (2 * length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) > length(regexp_replace(t, '[^\p{L}]+', '', 'g')) AND n_words >= 20)
            OR (n_words >= 100 AND pow(len(list_distinct(w)), 2) < 2 * n_words)) AS kept
FROM b"""
