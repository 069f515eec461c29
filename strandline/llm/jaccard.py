"""N-gram Jaccard join: a blocked sparse product of the documents' incidence with word 5-grams.

Two documents link when 100 * |A and B| >= 75 * |A or B| over their sets of distinct shingles, that is
7 * overlap >= 3 * (|A| + |B|). The incidence matrix is cut to blocks: rows to units of some documents, columns to ranges
of the shingles' hashes. All results are exact for those hashes (48 bits for overlaps, 128 for whole sets).

1. Each unit's blocks go to the tasks of their column range, which count each column's documents. Columns of
   one document never add to an overlap; the others return to their unit with their count. A unit counts the columns that
   several of its own documents hold and sends one number for each; their documents stay with the unit's facts. So
   a column that a third of all rows hold sends an entry a unit, not an entry a row. Ranges are made for every ``RANGE_BYTES`` of
   text, so a range's size does not depend on the input's or on settings. Up to ``FAN`` ranges a unit sends a block to
   each. Beyond that it sends blocks to the square root of their number, where those of as many units are merged and
   sent on, so that blocks stay large and the rows exchanged grow with the input, not with its square.
2. Each document's columns are ordered rarest first. A partner holds at least 75 % of its shingles,
   so one of the first n - ceil(0.75 n) + 1 is common to both. These columns alone enter the product, and documents
   whose rare columns fill them (most of a corpus) have no candidates. Common passages come last in the order.
3. Documents with equal sets are one row of the product (the least id stands for them).
4. The product runs over the columns' lists without expanding a list to all its pairs: in a few rounds one member
   of each list meets the others that are not in its component, at places and sizes that still allow the bound; these
   pairs' overlaps are verified and join components. The lists that still hold different components are then
   multiplied block by block, in tiles of some hundred rows: a tile accumulates overlap counts, drops pairs below
   the bound that their sizes give, and returns only links that join components. So a group of m near copies costs
   about m rows, and no link between components is lost.

Components are joined by least labels and pointer jumping, in tables; nothing but counts reaches the driver. The tables
are deleted when the result has been written. Rows are numbered by task, so an input that is not read from files in their order
is written first.

Defined cases: null and empty texts, and texts without words, have no shingles and are their own component;
fewer than five words are one shingle; repeated rows each get a row; a null id stays null and gives way to any other
as component id; other columns are not read. A text is hashed in parts of ``HASH_BYTES`` at spaces (one word of more is held whole); its
shingles, some 60 bytes for each word, lie in one worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.shared import Scratch, cut, flat_bytes, free, mix, no_nulls, pieces_of, release, steady, texts

WORDS = 5
#: Shingles in a unit (a document counts as ``UNIT_ROW`` more), bytes of text hashed at a time.
UNIT_SHINGLES = 1_500_000
UNIT_ROW = 8
HASH_BYTES = 2_000_000
#: Bytes of text for a column range; ranges that a unit sends blocks to at most.
RANGE_BYTES = 10_000_000
FAN = 1024
#: Rounds of one against the rest in each list, before the rest is multiplied in tiles.
ROUNDS = 2
#: Rows and shingles in a block of a tile, about.
BLOCK_ROWS = 512
BLOCK_SHINGLES = 500_000

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, words before each row and in all) of texts as bytes; A-Z count as a-z."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    firsts = offsets[:-1][np.diff(offsets) > 0]
    begin[firsts] = inside[firsts]
    starts = np.flatnonzero(begin)
    before = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), before
    # the end of a word: the next space, or the next start
    sizes = np.add.reduceat(inside.astype(np.int64), starts)
    place = np.flatnonzero(inside) - np.repeat(starts, sizes)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max()) + 1, _POWER, np.uint64))
        value = _BYTE[_LOWER[raw[inside]]] * powers[place]
        sums = np.add.reduceat(value, np.cumsum(sizes) - sizes)
        return mix(sums + sizes.astype(np.uint64) * _BYTE[0]), before


def text_word_hashes(raw: np.ndarray, offsets: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes``; one text of over ``most`` bytes goes by parts that end at a space."""
    if len(offsets) != 2 or len(raw) <= most:
        return word_hashes(raw, offsets)
    found, at = [], 0
    while at < len(raw):
        to = at + most
        while to < len(raw):
            spaces = np.flatnonzero(_SPACE[raw[to : to + 65536]])
            if len(spaces):
                to += int(spaces[0])
                break
            to += 65536
        to = min(to, len(raw))
        found.append(word_hashes(raw[at:to], np.array([0, to - at]))[0])
        at = to
    hashes = np.concatenate(found)
    return hashes, np.array([0, len(hashes)])


def shingle_hashes(words: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all 5-word windows by row, windows before each row); a row with 1 to 4 words has one."""
    counts = np.diff(before)
    n = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    ends = np.cumsum(n)
    row = np.repeat(np.arange(len(n)), n)
    start = before[:-1][row] + np.arange(int(ends[-1]) if len(ends) else 0) - (ends - n)[row]
    out = np.zeros(len(row), np.uint64)
    width = np.minimum(counts, WORDS)[row]
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    with np.errstate(over="ignore"):
        for k in range(WORDS):
            out = out * _BYTE[3] + np.where(k < width, padded[np.minimum(start + k, len(words))], np.uint64(0))
        return mix(out + width.astype(np.uint64) * _BYTE[5]), np.concatenate([[0], ends]).astype(np.int64)


def _pack(grams: np.ndarray, owners: np.ndarray) -> bytes:
    """Ascending grams as differences, and their owners, by byte planes, compressed."""
    step = np.diff(grams, prepend=np.uint64(0))
    wide = bool(len(step)) and int(step[1:].max(initial=0)) >= 2**32
    first = int(step[0]) if len(step) else 0
    step[:1] = 0
    tall = bool(len(owners)) and int(owners.max()) >= 2**16
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() for x in (step.astype("<u8" if wide else "<u4"), owners.astype("<u4" if tall else "<u2")) if len(x)]
    head = np.array([len(grams), wide + 2 * tall, first], "<u8").tobytes()
    return head + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, flags, first = (int(x) for x in np.frombuffer(blob[:24], "<u8"))
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[24:]), np.uint8)
    a, b = (8 if flags & 1 else 4), (4 if flags & 2 else 2)
    step = np.ascontiguousarray(raw[: n * a].reshape(a, n).T).view(f"<u{a}").ravel().astype(np.uint64)
    owners = np.ascontiguousarray(raw[n * a :].reshape(b, n).T).view(f"<u{b}").ravel().astype(np.uint32)
    return np.cumsum(step) + np.uint64(first), owners


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


#: What a row holds: a unit's facts; columns of one of its documents with that document; columns of several with their number.
FACTS, SINGLE, SEVERAL = 0, 1, 2
BLOCKS = pa.schema([("block", pa.int32()), ("unit", pa.int64()), ("kind", pa.int32()), ("data", pa.binary()), ("held", pa.binary())])
UNITS = pa.schema([("unit", pa.int64()), ("kind", pa.int32()), ("data", pa.binary()), ("held", pa.binary())])
ROWS = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("same", pa.binary()), ("prefix", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64()))])
_DDL = {
    "blocks": "block int, unit long, kind int, data binary, held binary",
    "units": "unit long, kind int, data binary, held binary",
    "rows": "key long, doc_id long, n long, same binary, prefix array<long>, grams array<long>",
}
_INFO = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<i8"), ("same", "S16")])


def _runs(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first, number) of each run of equal values."""
    first = np.flatnonzero(np.r_[True, ascending[1:] != ascending[:-1]]) if len(ascending) else np.zeros(0, np.int64)
    return first, np.diff(np.r_[first, len(ascending)])


def _bound(block: int, blocks: int) -> int:
    """The least column of a range, of ``blocks`` equal ones."""
    return ((block << 48) + blocks - 1) // blocks


def _to_blocks(blocks: int):
    """Rows (id, text) to the blocks of the incidence matrix, and a row for each unit: its facts, and who holds its columns of several."""
    bounds = [_bound(b, blocks) for b in range(blocks)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        grams, owners, facts, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            unit = part << 16 | seq
            g, o = np.concatenate(grams), np.concatenate(owners)
            order = np.argsort(g, kind="stable")
            g, o = g[order], o[order]
            info = np.zeros(len(facts), _INFO)
            digests = b"".join(f[2] for f in facts)
            info["doc_id"], info["null"], info["n"] = [f[0] or 0 for f in facts], [f[0] is None for f in facts], [f[1] for f in facts]
            raw = np.ascontiguousarray(info).view(np.uint8).reshape(len(facts), _INFO.itemsize)
            raw[:, -16:] = np.frombuffer(digests, np.uint8).reshape(len(facts), 16)
            first, count = _runs(g)
            several = np.repeat(count > 1, count)
            rows = [(unit % blocks, unit, FACTS, raw.tobytes(), _pack(g[several], o[several]))]
            for kind, columns, values in ((SINGLE, g[~several], o[~several]), (SEVERAL, g[first[count > 1]], count[count > 1].astype(np.uint32))):
                cuts = np.r_[np.searchsorted(columns, np.array(bounds, np.uint64)), len(columns)]
                rows += [(b, unit, kind, _pack(columns[x:y], values[x:y]), b"") for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x]
            return _batch(rows, BLOCKS)

        for batch in batches:
            for some in pieces_of(batch, "_text", HASH_BYTES):
                raw, offsets = flat_bytes(no_nulls(some.column("_text")))
                hashes, at = shingle_hashes(*text_word_hashes(raw, offsets, HASH_BYTES))
                for key, a, b in zip(some.column("_key").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    own = np.unique(hashes[a:b])
                    same = xxhash.xxh3_128_digest(own.tobytes())
                    short = np.unique(own >> np.uint64(16))
                    grams.append(short)
                    owners.append(np.full(len(short), len(facts), np.uint32))
                    # The set's size is that of the full hashes; the least hashes differ from it only if two agree in 48 bits.
                    facts.append((key, len(own), same))
                    held += len(own) + UNIT_ROW
                    if held >= UNIT_SHINGLES:
                        yield flush()
                        grams, owners, facts, held, seq = [], [], [], 0, seq + 1
                        release()
        if facts:
            yield flush()
        grams, owners, facts = [], [], []
        release()

    return run


def _count_columns(table: pa.Table) -> pa.Table:
    """A column range: keeps the columns of two documents or more, with the class of their count, by unit."""
    rows, grams, values, at = [], [], [], []
    for unit, kind, data, held in zip(table.column("unit").to_pylist(), table.column("kind").to_pylist(), table.column("data"), table.column("held")):
        if kind == FACTS:
            rows.append((unit, FACTS, data.as_py(), held.as_py()))
        else:
            g, v = _unpack(data.as_py())
            grams.append(g)
            values.append(v)
            at.append((unit, kind))
    if grams:
        g = np.concatenate(grams)
        weight = np.concatenate([v if kind == SEVERAL else np.ones(len(v), np.uint32) for v, (_, kind) in zip(values, at)])
        order = np.argsort(g, kind="stable")
        first, entries = _runs(g[order])
        count = np.add.reduceat(weight[order].astype(np.int64), first)
        each = np.zeros(len(g), np.uint8)
        each[order] = np.repeat(np.minimum(np.floor(4 * np.log2(count)), 255).astype(np.uint8), entries)
        del weight, order
        ends = np.cumsum([len(x) for x in grams])
        for (unit, kind), g, v, b in zip(at, grams, values, ends.tolist()):
            classes = each[b - len(g) : b]
            more = classes > 0
            if more.any():
                rows.append((unit, kind, _pack(g[more], v[more] if kind == SINGLE else np.zeros(int(more.sum()), np.uint32)), classes[more].tobytes()))
    return pa.Table.from_batches([_batch(rows, UNITS)] if rows else [], UNITS)


def _merge(ranges: int, coarse: int):
    """Blocks of several units in one coarse range: a row for each range in it, of the columns with their documents in all."""

    def run(table: pa.Table) -> pa.Table:
        origin, block = table.column("origin")[0].as_py(), table.column("block")[0].as_py()
        parts = [(*_unpack(data.as_py()), kind) for kind, data in zip(table.column("kind").to_pylist(), table.column("data"))]
        g = np.concatenate([x[0] for x in parts])
        weight = np.concatenate([v if kind == SEVERAL else np.ones(len(v), np.uint32) for _, v, kind in parts]).astype(np.int64)
        order = np.argsort(g, kind="stable")
        first, _ = _runs(g[order])
        columns, sums = g[order][first], np.add.reduceat(weight[order], first)
        low, high = block * ranges // coarse, (block + 1) * ranges // coarse
        cuts = np.r_[np.searchsorted(columns, np.array([_bound(r, ranges) for r in range(low, high)], np.uint64)), len(columns)]
        rows = [(low + i, origin, SEVERAL, _pack(columns[x:y], np.minimum(sums[x:y], 2**32 - 1).astype(np.uint32)), b"") for i, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x]
        return pa.Table.from_batches([_batch(rows, BLOCKS)], BLOCKS)

    return run


def _spread(units: pa.Table, counted: pa.Table) -> pa.Table:
    """The merged units' columns that the ranges have kept, with their classes, by unit again."""
    kept = [(_unpack(data.as_py())[0], np.frombuffer(held.as_py(), np.uint8)) for data, held in zip(counted.column("data"), counted.column("held"))]
    if not kept:
        return pa.Table.from_batches([], UNITS)
    columns, classes = (np.concatenate(x) for x in zip(*kept))
    order = np.argsort(columns)
    columns, classes = columns[order], classes[order]
    rows = []
    for unit, kind, data in zip(units.column("unit").to_pylist(), units.column("kind").to_pylist(), units.column("data")):
        g, v = _unpack(data.as_py())
        at = np.minimum(np.searchsorted(columns, g), len(columns) - 1)
        more = columns[at] == g
        if more.any():
            rows.append((unit, kind, _pack(g[more], v[more] if kind == SINGLE else np.zeros(int(more.sum()), np.uint32)), classes[at[more]].tobytes()))
    return pa.Table.from_batches([_batch(rows, UNITS)] if rows else [], UNITS)


def prefix_size(n: np.ndarray) -> np.ndarray:
    """Shingles of which a partner must hold one: n - ceil(0.75 n) + 1."""
    return n - (3 * n + 3) // 4 + 1


def _to_rows(table: pa.Table) -> pa.Table:
    """A unit: a row for each document; candidates with their prefix and all their shared columns."""
    facts, parts, several = None, [], []
    for kind, data, held in zip(table.column("kind").to_pylist(), table.column("data"), table.column("held")):
        if kind == FACTS:
            facts = np.frombuffer(data.as_py(), _INFO)
            same = np.frombuffer(data.as_py(), np.uint8).reshape(len(facts), _INFO.itemsize)[:, -16:]
            holders = _unpack(held.as_py())
        else:
            (parts if kind == SINGLE else several).append((*_unpack(data.as_py()), np.frombuffer(held.as_py(), np.uint8)))
    unit = table.column("unit")[0].as_py()
    if several:
        columns, _, counts = (np.concatenate(x) for x in zip(*several))
        order = np.argsort(columns)
        parts.append((*holders, counts[order][np.searchsorted(columns[order], holders[0])]))
    if parts:
        grams, owners, counts = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((grams, counts, owners))
        grams, owners = grams[order].astype(np.int64), owners[order]
    else:
        grams, owners = np.zeros(0, np.int64), np.zeros(0, np.uint32)
    cuts = np.searchsorted(owners, np.arange(len(facts) + 1))
    take = prefix_size(facts["n"]) - (facts["n"] - np.diff(cuts))
    take[facts["n"] == 0] = 0
    rows = []
    for i, (a, b, p) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), take.tolist())):
        own = grams[a:b] if p > 0 else None
        rows.append((unit << 22 | i, None if facts["null"][i] else int(facts["doc_id"][i]), int(facts["n"][i]), same[i].tobytes(), None if own is None else own[:p], own))
    return pa.Table.from_batches([_batch(rows, ROWS)], ROWS)


def document_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(key, doc_id, n, same, prefix, grams): a row for each document, written to the shared folder.

    ``key`` numbers the rows; ``same`` is equal for equal sets; ``prefix`` and ``grams`` are null for documents
    that can link only to documents with an equal set.
    """
    scratch = scratch or Scratch(docs.sparkSession, "jaccard")
    rows = steady(docs.select(F.col(key).cast("long").alias("_key"), texts(text).alias("_text")))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text").cast("long") + UNIT_ROW), F.lit(0)).alias("n")).first()["n"]
    ranges = max(1, -(-size // RANGE_BYTES))
    if ranges <= FAN:
        counted = rows.mapInArrow(_to_blocks(ranges), _DDL["blocks"]).groupBy("block").applyInArrow(_count_columns, _DDL["units"])
    else:
        counted = _counted_by_two(rows, ranges, scratch)
    return scratch.cut(counted.groupBy("unit").applyInArrow(_to_rows, _DDL["rows"]))


def _counted_by_two(rows: DataFrame, ranges: int, scratch: Scratch) -> DataFrame:
    """The units' facts and counted columns, by two exchanges each way: units to coarse ranges, merged, to ranges, and back."""
    coarse = int(np.ceil(np.sqrt(ranges)))
    # a unit has about RANGE_BYTES of text or more, so a band has at most about ``coarse`` units
    bands = max(1, ranges // coarse)
    matrix = scratch.cut(rows.mapInArrow(_to_blocks(coarse), _DDL["blocks"]).withColumn("origin", F.col("block") + F.lit(coarse).cast("long") * F.pmod(F.xxhash64("unit"), F.lit(bands))))
    columns = matrix.where(F.col("kind") != FACTS)
    counted = columns.groupBy("origin").applyInArrow(_merge(ranges, coarse), _DDL["blocks"]).groupBy("block").applyInArrow(_count_columns, _DDL["units"])
    spread = columns.groupBy("origin").cogroup(counted.withColumnRenamed("unit", "origin").groupBy("origin")).applyInArrow(_spread, _DDL["units"])
    return spread.unionByName(matrix.where(F.col("kind") == FACTS).select("unit", "kind", "data", "held"))


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, comp): the least vertex that each vertex of the edges (a, b) reaches."""
    edges = scratch.cut(edges.select("a", "b"))
    most = 2 * edges.count()
    both = scratch.cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), most)
    labels = scratch.cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("comp")), most)
    while True:
        near = both.join(labels, both.b == labels.v).groupBy("a").agg(F.min("comp").alias("m"))
        lower = labels.join(near, labels.v == near.a).select("v", F.least("comp", "m").alias("low"), F.col("comp").alias("old"))
        # a vertex's new label is its lower label's own lowest so far, looked up twice
        one, two = (labels.select(F.col("v").alias(f"v{i}"), F.col("comp").alias(f"c{i}")) for i in (1, 2))
        jumped = lower.join(one, F.col("low") == F.col("v1"), "left").join(two, F.col("c1") == F.col("v2"), "left")
        after = scratch.cut(jumped.select("v", F.least("low", "c1", "c2").alias("comp"), "old"), most)
        labels = after.select("v", "comp")
        if after.where("comp <> old").isEmpty():
            return labels


def _merged(comps: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Components (key, n, comp) after joining those of each link's ends."""
    ends = comps.select(F.col("key").alias("k"), F.col("comp").alias("c"))
    contracted = links.join(ends, F.col("a") == F.col("k")).select(F.col("c").alias("x"), "b").join(ends, F.col("b") == F.col("k")).select(F.least("x", "c").alias("a"), F.greatest("x", "c").alias("b")).where("a <> b").distinct()
    found = connected(contracted, scratch).withColumnRenamed("comp", "into")
    return scratch.cut(comps.join(found, comps.comp == found.v, "left").select("key", "n", F.coalesce("into", "comp").alias("comp")))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by their exact overlap."""
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.where(7 * F.size(F.array_intersect("grams_a", "grams_b")) >= 3 * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _may_link(a: str, b: str):
    """The sizes and places of a column in two rows allow a link if no column before it is common.

    Then the overlap is at most what is left of either row from there on. The first common column of a link passes.
    """
    left = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    return 7 * left >= 3 * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _postings(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(gram, row: key, n, pos, most) of the prefixes' columns that some other row can meet.

    ``pos`` is the column's place in its row, columns of one document first; ``most`` is the largest partner that the
    place allows. A column's rows without a partner small enough, or without one that allows their size, go.
    """
    placed = sets.select("key", "n", (F.col("n") - F.size("grams")).alias("u"), F.posexplode("prefix").alias("i", "gram")).withColumn("pos", F.col("u") + F.col("i"))
    ranged = placed.withColumn("most", F.floor((4 * F.col("n") - 7 * F.col("pos")) / 3)).select("gram", F.struct("key", "n", "pos", "most").alias("row"))
    ranged = scratch.cut(ranged)
    ends = ranged.groupBy("gram").agg(F.count("*").alias("m"), F.min("row.n").alias("least_n"), F.max("row.most").alias("most_n")).where("m > 1")
    met = ranged.join(ends, "gram").where("row.most >= least_n AND row.n <= most_n").select("gram", "row")
    return scratch.cut(met)


def link_components(sets: DataFrame, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """(key, n, comp) for ``sets`` (key, n, prefix, grams), one row for each different set: the components of all links."""
    postings = _postings(sets, scratch)
    comps = scratch.cut(postings.select("row.key", "row.n").distinct().select("key", "n", F.col("key").alias("comp")))
    done = None
    for turn in range(rounds + 1):
        live = postings.withColumn("key", F.col("row.key")).join(comps.select("key", "comp"), "key").select("gram", "row", "comp")
        # A link's smaller row has the column early enough for partners of its own size: such rows are hubs.
        early = F.col("row.most") >= F.col("row.n")
        by_comp = live.groupBy("gram", "comp").agg(F.count("*").alias("m"), F.count_if(early).alias("e"), F.min(F.struct((~early).alias("late"), F.xxhash64(F.lit(turn), "row.key").alias("h"), "row", "comp")).alias("hub"))
        lists = by_comp.groupBy("gram").agg(F.sum("m").alias("members"), (F.sum("m") * F.sum("e") - F.sum(F.col("m") * F.col("e"))).alias("cross"), F.min("hub").alias("hub")).where("cross > 0")
        lists = scratch.cut(lists)
        left = lists.agg(F.count("*").alias("lists"), F.coalesce(F.sum("cross"), F.lit(0)).alias("cross"), F.coalesce(F.sum("members"), F.lit(0)).alias("members")).first()
        if not left["lists"]:
            break
        last = turn == rounds
        if last:
            return _merged(comps, _tile_links(live.join(lists.select("gram"), "gram", "left_semi"), sets, scratch), scratch)
        star = live.join(lists.select("gram", "hub"), "gram").where((F.col("comp") != F.col("hub.comp")) & _may_link("row", "hub.row"))
        pairs = star.select(F.least("row.key", "hub.row.key").alias("a"), F.greatest("row.key", "hub.row.key").alias("b")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = scratch.cut(pairs)
        comps = _merged(comps, scratch.cut(_verified(pairs, sets)), scratch)
        done = pairs if done is None else done.unionByName(pairs)
    return comps


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _product(table: pa.Table) -> pa.Table:
    """A tile of the product: overlaps of one block's rows with the other's; the links that join components of the tile."""
    n, comp, key, block = (table.column(c).to_numpy() for c in ("n", "comp", "key", "block"))
    lists = table.column("grams").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy().astype(np.int64))
    owner = np.repeat(np.arange(len(n)), sizes)
    column = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
    by_column = np.argsort(column, kind="stable")
    rows_of = owner[by_column]
    bounds = np.searchsorted(column[by_column], np.arange(int(column.max(initial=-1)) + 2))
    bounds_by_row = np.r_[0, np.cumsum(sizes)]
    left = np.flatnonzero(block == block.min())
    one_block = len(left) == len(n)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for i in left.tolist():
        own = column[bounds_by_row[i] : bounds_by_row[i + 1]]
        first, count = bounds[own], bounds[own + 1] - bounds[own]
        ends = np.cumsum(count)
        at = np.repeat(first - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)
        overlap = np.bincount(rows_of[at], minlength=len(n))
        # the bound that the sizes give
        hit = (7 * overlap >= 3 * (n[i] + n)) & (comp != comp[i])
        hit &= np.arange(len(n)) > i if one_block else block != block[i]
        for j in np.flatnonzero(hit).tolist():
            x, y = root(int(comp[i])), root(int(comp[j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((min(int(key[i]), int(key[j])), max(int(key[i]), int(key[j]))))
    return pa.Table.from_batches([_batch(out, LINKS)] if out else [], LINKS)


def _tile_links(live: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): links that join the components of the rows of the lists ``live`` (gram, row, comp), by blocks of rows.

    Blocks lie within a cluster of lists; a large component has blocks of its own, small ones share some.
    Only block pairs that meet in a list and hold different components are multiplied, and a tile gives at most a link for
    each of its rows. So rows left over beside a large component meet it once, and nothing is expanded to pairs.
    """
    hubs = live.groupBy("gram").agg(F.min("row.key").alias("b"))
    clusters = connected(live.select("gram", F.col("row.key").alias("a")).join(hubs, "gram").where("a <> b").select("a", "b").distinct(), scratch)
    weighed = sets.select("key", "n", "grams", F.size("grams").alias("w"))
    rows = live.select(F.col("row.key").alias("key"), "comp").distinct().join(clusters.select(F.col("v").alias("key"), F.col("comp").alias("cluster")), "key").join(weighed.select("key", "w"), "key")
    by_comp = rows.groupBy("cluster", "comp").agg(F.count("*").alias("m"), F.sum("w").alias("w")).withColumn("own", (F.col("m") >= BLOCK_ROWS / 2) | (F.col("w") >= BLOCK_SHINGLES / 2))
    owned = by_comp.groupBy("cluster", "own", F.when(F.col("own"), F.col("comp")).alias("owner")).agg(F.ceil(F.greatest(F.sum("m") / BLOCK_ROWS, F.sum("w") / BLOCK_SHINGLES)).cast("long").alias("k"))
    dealt = by_comp.select("cluster", "comp", "own", F.when(F.col("own"), F.col("comp")).alias("owner")).join(owned.select(F.col("cluster").alias("c2"), F.col("owner").alias("o2"), "k"), (F.col("cluster") == F.col("c2")) & F.col("owner").eqNullSafe(F.col("o2")))
    placed = rows.select("key", "comp", "cluster").join(dealt.select("cluster", "comp", "own", "owner", "k"), ["cluster", "comp"])
    placed = scratch.cut(placed.withColumn("block", F.xxhash64("cluster", F.coalesce("owner", F.lit(-1)), F.pmod(F.xxhash64(F.when(F.col("own"), F.col("key")).otherwise(F.col("comp"))), F.col("k")))).select("key", "comp", "own", "block", "owner"))
    met = live.select("gram", F.col("row.key").alias("key")).join(placed.select("key", "block", "owner"), "key").select("gram", "block", "owner").distinct()
    one, two = met.select("gram", F.col("block").alias("x"), F.col("owner").alias("ox")), met.select("gram", F.col("block").alias("y"), F.col("owner").alias("oy"))
    tiles = one.join(two, "gram").where("x <= y AND NOT coalesce(ox = oy, false)").select("x", "y").distinct().withColumn("tile", F.xxhash64("x", "y"))
    ends = tiles.select("tile", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    members = ends.join(placed.select("block", "key", "comp"), "block").join(weighed.select("key", "n", "grams"), "key")
    return members.select("tile", "block", "key", "comp", "n", "grams").groupBy("tile").applyInArrow(_product, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, n_copies, is_first): a row for each row of ``docs``.

    ``component_id`` is the least id of the component; ``n_copies`` counts the rows with an equal set; ``is_first`` marks one row
    of each component.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    rows = document_rows(docs, key, text, scratch)
    # One row for each different set: the one with the least id (null last), then the least row number.
    filled = rows.where("n > 0")
    order = F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("id"), F.col("key").alias("k"))
    classes = scratch.cut(filled.groupBy("same").agg(F.min(order).alias("least"), F.count("*").alias("n_copies")).select("same", F.col("least.id").alias("id"), F.col("least.k").alias("rep"), "n_copies"))
    sets = scratch.cut(filled.where("prefix is not null").join(classes, F.col("key") == F.col("rep"), "left_semi").select("key", "n", "prefix", "grams"))
    comps = link_components(sets, scratch)
    placed = classes.join(comps.select("key", "comp"), F.col("rep") == F.col("key"), "left").select("same", "id", "rep", "n_copies", F.coalesce("comp", "rep").alias("comp"))
    least = placed.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("x"), "id", F.col("rep").alias("k"))).alias("first"))
    named = scratch.cut(placed.join(least, "comp").select("same", "n_copies", F.col("first.id").alias("component_id"), F.col("first.k").alias("first_key")))
    some = filled.select("key", "doc_id", "n", "same").join(named, "same").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_copies", (F.col("key") == F.col("first_key")).alias("is_first"))
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("n_copies"), F.lit(True).alias("is_first"))
    result = cut(some.unionByName(none))
    scratch.close()
    return result


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one whose id is the least (null last); columns unchanged.

    Rows are told apart by numbers written with them, so ids may be null, repeated or of any type that has an order.
    """
    number, least, one, x = free(docs, "_number", "_least", "_one", "_null")
    numbered = cut(steady(docs).withColumn(number, F.monotonically_increasing_id()))
    found = jaccard_components(numbered, number, text).select(F.col("doc_id").alias(one), F.col("component_id").alias(least))
    ids = numbered.select(F.col(key).isNull().alias(x), key, number)
    first = found.join(ids, F.col(one) == F.col(number)).groupBy(least).agg(F.min(F.struct(x, key, number)).alias(one))
    stay = first.select(F.col(one)[number].alias(one))
    return numbered.join(stay, F.col(number) == F.col(one), "left_semi").drop(number)
