"""Quality classifier: texts compressed with zstandard dictionaries built from good and from bad text.

A text that shares the good dictionary's word forms shrinks more with it than with the bad one. The one feature is
the normalised difference of the two compressed sizes, ``(bad - good) / size``. Training rows that no dictionary saw calibrate it:
isotonic regression (pool adjacent violators) gives the share of good rows at each difference, and the score runs
linearly between the pools.

Only the fit is bounded, by its parameters: at most ``most_rows`` labelled rows for each class (those of the least hash of the id), and of
these, in that order, the rows that fit in ``most_bytes`` of text; a row is taken whole or not at all. So the driver holds
no more than that for each class at any input size. The dictionaries learn from blocks spread over the whole of each text, the
calibration from whole texts. Scoring reads whole texts, in one
pass without a shuffle: each text is compressed in blocks of ``BLOCK`` bytes, so that a text is judged by
the dictionaries and not by its own repeats; memory is that of an Arrow batch and a block.

Defined cases: null and empty texts have a difference of 0; rows whose id is null are never trained on; of rows of one id the
greatest label and text count; a class with one or two rows uses them for dictionary and calibration alike;
without rows of both classes every score is the share of good rows (0.5 without rows).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.shared import flat_bytes, free, no_nulls, release, texts

DICTIONARY = 112_640
BLOCK = 1024
LEVEL = 3
CUT = 0.3


def held_out(key: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves no remainder by 5: rows that no fit may see."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


@dataclass(frozen=True)
class Model:
    """The dictionaries; scores ``ys`` at the ascending differences ``xs``; the share of good rows."""

    good: bytes
    bad: bytes
    xs: tuple = ()
    ys: tuple = ()
    share: float = 0.5


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.compressors = [self._compressor(raw) for raw in (model.good, model.bad)] if model.good and model.bad else []

    @staticmethod
    def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)

    def difference(self, text: memoryview | bytes) -> float:
        """(compressed by bad - compressed by good) / size: above 0 where the good dictionary helps more."""
        size = len(text)
        if not size:
            return 0.0
        view = memoryview(text)
        good, bad = (sum(len(c.compress(view[i : i + BLOCK])) for i in range(0, size, BLOCK)) for c in self.compressors)
        return (bad - good) / size

    def scores(self, differences: np.ndarray) -> np.ndarray:
        """Calibrated scores; a thousandth of them tells apart differences between the same two pools of one level."""
        level = np.interp(differences, self.model.xs, self.model.ys)
        return 0.999 * level + 0.001 * (0.5 + np.arctan(40 * differences) / np.pi)


def calibrate(differences: np.ndarray, labels: np.ndarray) -> tuple[tuple, tuple]:
    """Isotonic regression of the labels: (mean difference, smoothed share of good rows) of each pool, ascending."""
    pools: list[list[float]] = []  # sum of differences, good rows, rows
    at, place = np.unique(differences, return_inverse=True)
    rows, good = np.bincount(place), np.bincount(place, labels)
    for x, y, n in zip((at * rows).tolist(), good.tolist(), rows.tolist()):
        pools.append([x, y, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    share = float(labels.mean())
    levels = np.maximum.accumulate([(good + share) / (n + 1) for _, good, n in pools])
    return tuple(x / n for x, _, n in pools), tuple(levels.tolist())


def _spread(text: bytes, most: int = 3, size: int = 2048) -> list[bytes]:
    """All blocks of a text, or of a longer one a hash-chosen block from each third, so that no text outweighs the others."""
    parts = [text[i : i + size] for i in range(0, len(text), size)]
    if len(parts) <= most:
        return parts
    ends = [k * len(parts) // most for k in range(most + 1)]
    return [parts[a + zlib.crc32(text, k) % (b - a)] for k, (a, b) in enumerate(zip(ends[:-1], ends[1:]))]


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; raw content where there is too little text to train on."""
    parts = [part for s in samples for part in _spread(s)]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(parts)[-DICTIONARY:]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", most_rows: int = 3000, most_bytes: int = 32_000_000) -> Model:
    """A model from the labelled rows of ``docs`` that are not held out: ``most_rows`` and ``most_bytes`` of each class at most."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(key)).select(key, F.col(label).cast("int").alias("_label")).groupBy(key).agg(F.max("_label").alias("_label"))
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("_label") == value).orderBy(F.xxhash64(key), key).limit(most_rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    # chosen has at most 2 * most_rows rows of two numbers: the bound of what is broadcast here.
    labelled = docs.select(key, texts(text).alias("_text")).join(F.broadcast(chosen), key)
    sizes = labelled.groupBy(key).agg(F.max("_label").alias("_label"), F.max(F.octet_length("_text")).alias("_size")).orderBy(F.xxhash64(key), key).collect()
    room, fits = {0: most_bytes, 1: most_bytes}, []
    for r in sizes:
        if r["_size"] <= room[r["_label"]]:
            room[r["_label"]] -= r["_size"]
            fits.append((r[key],))
    if not fits:
        return Model(b"", b"")
    taken = docs.sparkSession.createDataFrame(fits, known.select(key).schema)
    rows = labelled.join(F.broadcast(taken), key).groupBy(key).agg(F.max("_label").alias("_label"), F.max("_text").alias("_text")).orderBy(F.xxhash64(key), key).collect()
    return fit_texts(*([r["_text"].encode() for r in rows if r["_label"] == v and r["_text"]] for v in (1, 0)))


def fit_texts(good: list[bytes], bad: list[bytes]) -> Model:
    """A model from texts: two thirds of each class make its dictionary, the rest calibrates."""
    share = len(good) / (len(good) + len(bad)) if good or bad else 0.5
    if not good or not bad:
        return Model(b"", b"", share=share)
    dictionaries = [_dictionary([s for i, s in enumerate(x) if i % 3] or x) for x in (good, bad)]
    scorer = Scorer(Model(*dictionaries))
    found = [(scorer.difference(s), y) for x, y in ((bad, 0.0), (good, 1.0)) for s in x[::3]]
    return Model(*dictionaries, *calibrate(*np.array(found).T), share)


def score_texts(df: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``df`` with the score of each whole text, 0 to 1, in the column ``into`` (in place of one of that name). One pass, no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY bytes at most, and the pools

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for values in batches:
            if not scorer.compressors:
                yield pa.array(np.full(len(values), shared.value.share))
                continue
            raw, offsets = flat_bytes(no_nulls(values))
            view = memoryview(raw)
            yield pa.array(scorer.scores(np.array([scorer.difference(view[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], np.float64)))
            del raw, view, values
            release()

    return df.withColumn(into, scored(texts(text)))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **bounds) -> DataFrame:
    """A row for each row of ``docs``: id, held_out, score, predicted (1 where the score is at least ``CUT``)."""
    scored = score_texts(docs.select(F.col(key), F.col(text).alias("_text")), fit(docs, labels, key=key, text=text, **bounds), "_text")
    return scored.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **bounds) -> DataFrame:
    """The rows of ``docs`` predicted good, columns unchanged."""
    (score,) = free(docs, "_score")
    return score_texts(docs, fit(docs, labels, key=key, text=text, **bounds), text, score).where(F.col(score) >= CUT).drop(score)
