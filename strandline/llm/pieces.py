"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

The lattice of a text has a node at each byte boundary that a piece can reach and an edge for each vocabulary
piece found there; characters outside the vocabulary are chains of byte pieces. A segmentation's probability is
proportional to the product of its pieces' weights. Forward filtering sums the weights of all ways to
each node; backward sampling walks from the end, drawing each last piece in proportion to its share. Draws are hashes of
(seed, row key, place in the text, step), so a row's segmentation is the same in any run, batch or partition.

No piece reaches over the start of a run of spaces or over a newline, so the lattice falls into units there.
The filter runs once for each distinct unit of a batch, over all units at once; the sampler draws for all
occurrences at once, a step at a time. Rows go in slices of ``SLICE_BYTES`` of text, and a longer text in parts that begin at a unit,
so a worker holds an Arrow batch, the ids of one slice or text, and about 70 bytes for each byte of a slice. Only a run of that
length without a space or newline is held whole.

The vocabulary of a BPE model has ranks in place of log-probabilities; a piece of rank r weighs
(r + ``SHIFT``) ** -``SHARPNESS``, after Zipf's law.

Defined cases: null and empty texts have no pieces; null keys count as 0; rows with equal key and text get equal
pieces; every text decodes to itself, with any spaces, control characters and characters outside the vocabulary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.shared import flat_bytes, mix, no_nulls, release, slices

SEED = 29
SHIFT = 10.0
SHARPNESS = 1.0
SLICE_BYTES = 1_000_000
#: Weight of each byte of a character outside the vocabulary.
BYTE_WEIGHT = 1e-6

_GOLD = np.uint64(0x9E3779B97F4A7C15)


class Trie:
    """The pieces' bytes as a trie whose moves (node, byte) -> node lie in an open-addressed hash table."""

    def __init__(self, words: list[bytes], ids: list[int]):
        moves: dict[int, int] = {}
        piece = {0: -1}
        count = 1
        for w, i in zip(words, ids):
            node = 0
            for b in w:
                key = node << 8 | b
                if key not in moves:
                    moves[key] = count
                    piece[count] = -1
                    count += 1
                node = moves[key]
            piece[node] = i
        self.piece = np.array([piece[n] for n in range(count)], np.int32)
        self.depth = max(map(len, words), default=0)
        keys = np.fromiter(moves.keys(), np.int64, len(moves))
        values = np.fromiter(moves.values(), np.int32, len(moves))
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[at[todo]] == -1
            some = todo[free]
            slot, first = np.unique(at[some], return_index=True)
            self.keys[slot], self.values[slot] = keys[some[first]], values[some[first]]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * _GOLD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """The node after each byte; -1 where there is none."""
        keys = nodes.astype(np.int64) << 8 | bytes_
        out = np.full(len(keys), -1, np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            have = self.keys[at[todo]]
            hit = have == keys[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            on = ~hit & (have != -1)
            todo = todo[on]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
        return out


class Sampler:
    """A sentencepiece model's vocabulary as lattice pieces; one for each worker and setting."""

    opened: dict[tuple, Sampler] = {}

    def __init__(self, model: str, sharpness: float = SHARPNESS):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
        scores = np.array([sp.get_score(i) for i in plain])
        # Ranks from the scores; special scores (runs of spaces) come last.
        ranks = np.argsort(np.argsort(-scores, kind="stable"), kind="stable")
        self.log = np.zeros(n)
        self.log[plain] = -sharpness * np.log(ranks + SHIFT)
        words = [sp.id_to_piece(i).replace("▁", " ").encode() for i in plain]
        self.trie = Trie(words, plain)
        self.byte_id = np.zeros(256, np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(sp.id_to_piece(i)[3:-1], 16)] = i
        self.log[self.byte_id] = sharpness * np.log(BYTE_WEIGHT)
        spelled = [b""] * n
        for i, w in zip(plain, words):
            spelled[i] = w
        for b, i in enumerate(self.byte_id):
            spelled[i] = bytes([b])
        self.sizes = np.array([len(w) for w in spelled], np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)

    @classmethod
    def of(cls, model: str, sharpness: float = SHARPNESS) -> Sampler:
        if (model, sharpness) not in cls.opened:
            cls.opened[model, sharpness] = cls(model, sharpness)
            release()  # the model's file and the tables' first forms
        return cls.opened[model, sharpness]

    def _edges(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of all edges over ``raw``; ``ends[i]`` is where the unit of byte i ends."""
        n = len(raw)
        head = (raw & 0xC0) != 0x80
        at = np.flatnonzero(head).astype(np.int32)  # a slice has under 2^31 bytes: half the memory of the default
        node = np.zeros(len(at), np.int32)
        width = np.ones(n, np.int8)
        width[raw >= 0xC0], width[raw >= 0xE0], width[raw >= 0xF0] = 2, 3, 4
        single = np.zeros(n, bool)  # characters that are pieces
        found = []
        for length in range(1, self.trie.depth + 1):
            inside = at + np.int32(length) <= ends[at]
            at, node = at[inside], node[inside]
            if not len(at):
                break
            node = self.trie.step(node, raw[at + length - 1])
            live = node >= 0
            at, node = at[live], node[live]
            piece = self.trie.piece[node]
            whole = piece >= 0
            found.append((at[whole], at[whole] + np.int32(length), piece[whole]))
            single[at[whole & (width[at] == length)]] = True
        lone = head & ~single  # heads of characters that no piece is
        owner = np.maximum.accumulate(np.where(head, np.arange(n, dtype=np.int32), np.int32(0)))
        chain = np.flatnonzero(lone[owner]).astype(np.int32)
        found.append((chain, chain + np.int32(1), self.byte_id[raw[chain]]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _filter(self, raw: np.ndarray, starts: np.ndarray, stops: np.ndarray):
        """Forward filtering over units raw[start:stop].

        Gives the edges ordered by (end), the running share of each edge among those with its end, and each end's
        number, first edge and last edge.
        """
        n = len(raw)
        begin = np.repeat(starts.astype(np.int32), stops - starts)
        a, b, piece = self._edges(raw, np.repeat(stops.astype(np.int32), stops - starts))
        order = np.argsort(b, kind="stable")
        a, b, piece = a[order], b[order], piece[order]
        del order
        # alpha by node; a unit's start has its own place, as the end of the unit before may be the same byte boundary
        alpha = np.full(n + 1, -np.inf)
        first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
        node = b[first]
        sizes = np.diff(np.r_[first, len(b)])
        # ends by their distance from the unit's start
        far = node - begin[node - 1]
        by = np.argsort(far, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(far[by]) > 0, True])
        share = np.empty(len(b))
        at_start = a == begin[a] if len(a) else np.zeros(0, bool)
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            ks = by[lo:hi]
            m = sizes[ks]
            to = np.cumsum(m)
            edges = np.repeat(first[ks] - (to - m), m) + np.arange(to[-1])
            value = np.where(at_start[edges], 0.0, alpha[a[edges]]) + self.log[piece[edges]]
            top = np.maximum.reduceat(value, to - m)
            top = np.where(np.isfinite(top), top, 0.0)
            with np.errstate(divide="ignore", invalid="ignore"):
                every = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, m)), to - m))
                alpha[node[ks]] = every
                share[edges] = np.nan_to_num(np.exp(value - np.repeat(every, m)), nan=0.0)
        # Each node's shares are summed by themselves, so that they round alike wherever the node lies.
        ladder, last = share, first + sizes - 1
        for k in range(1, int(sizes.max(initial=1))):
            at = first[sizes > k] + k
            ladder[at] += ladder[at - 1]
        ladder[ladder >= np.repeat(ladder[last], sizes)] = 1.0
        rank = np.full(n + 1, -1, np.int32)
        rank[node] = np.arange(len(first))
        return a, piece, ladder, rank, first, last

    @staticmethod
    def _drawn(ladder: np.ndarray, low: np.ndarray, high: np.ndarray, u: np.ndarray) -> np.ndarray:
        """For each draw the first edge from ``low`` to ``high`` whose cumulative share is above ``u``."""
        for _ in range(int((high - low).max(initial=0)).bit_length()):
            middle = (low + high) >> 1
            right = (low < high) & (ladder[middle] <= u)
            low, high = np.where(right, middle + 1, low), np.where(right, high, middle)
        return low

    def sample(self, values: pa.Array, keys: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
        """(all piece ids, offsets by row) of texts without nulls; keys: uint64 by row."""
        raw, offsets = flat_bytes(values)
        if len(offsets) != 2 or len(raw) <= SLICE_BYTES:
            return self._sample(raw, offsets, keys, seed)
        found = [self._sample(raw[a:b], np.array([0, b - a]), keys, seed, a)[0] for a, b in unit_parts(raw, SLICE_BYTES)]
        ids = np.concatenate(found)
        return ids, np.array([0, len(ids)])

    def _sample(self, raw: np.ndarray, offsets: np.ndarray, keys: np.ndarray, seed: int, begun: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """``sample`` of texts as bytes; ``begun``: the place in its text where the (one) row begins."""
        rows = len(offsets) - 1
        filled = np.flatnonzero(np.diff(offsets) > 0)
        if not len(filled):
            return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
        if not begun:
            raw = np.insert(raw, offsets[filled], 32)  # the space before the first word
            grown = np.zeros(rows + 1, np.int64)
            grown[filled + 1] = 1
            offsets = offsets + np.cumsum(grown)
        space, line = raw == 32, raw == 10
        cut = line.copy()
        cut[1:] |= line[:-1] | (space[1:] & ~space[:-1])
        cut[offsets[filled]] = True
        starts = np.flatnonzero(cut)
        row = np.searchsorted(offsets, starts, side="right") - 1
        place = (starts - offsets[row] + (begun + 1 if begun else 0)).astype(np.uint64)
        bounds = np.r_[starts, len(raw)]
        units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = units.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        own, unit_ends = flat_bytes(coded.dictionary)
        unit_starts, unit_ends = unit_ends[:-1], unit_ends[1:]
        a, piece, ladder, rank, first, to = self._filter(own, unit_starts, unit_ends)
        with np.errstate(over="ignore"):
            base = mix(mix(keys + np.uint64(seed) * _GOLD)[row] + place * _GOLD)
        live = np.arange(len(starts))
        at = unit_ends[codes].copy()
        floor = unit_starts[codes]
        drawn_unit, drawn_piece = [], []
        counts = np.zeros(len(starts), np.int64)
        step = 0
        while len(live):
            step += 1
            with np.errstate(over="ignore"):
                u = (mix(base[live] + np.uint64(step) * _GOLD) >> np.uint64(11)).astype(np.float64) / 2.0**53
            node = rank[at[live]]
            edge = self._drawn(ladder, first[node], to[node], u)
            drawn_unit.append(live)
            drawn_piece.append(piece[edge])
            counts[live] = step
            at[live] = a[edge]
            live = live[at[live] > floor[live]]
        last = np.cumsum(counts)  # pieces were drawn from the end
        out = np.empty(int(last[-1]), np.int32)
        for k, (unit, ids) in enumerate(zip(drawn_unit, drawn_piece)):
            out[last[unit] - 1 - k] = ids
        per_row = np.zeros(rows, np.int64)
        np.add.at(per_row, row, counts)
        return out, np.r_[0, np.cumsum(per_row)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets by row) of piece ids: the pieces spelled out, without the space before the first word."""
        if not len(ids):
            return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
        ends = np.cumsum(self.sizes[ids])
        parts = []
        for at in range(0, len(ids), 200_000):
            some = ids[at : at + 200_000]
            sizes = self.sizes[some]
            to = np.cumsum(sizes)
            parts.append(self.spelled[np.repeat(self.firsts[some] - (to - sizes), sizes) + np.arange(int(to[-1]))])
        raw = np.concatenate(parts)
        bounds = np.r_[0, ends][offsets]
        filled = np.diff(bounds) > 0
        raw = np.delete(raw, bounds[:-1][filled])
        return raw, bounds - np.r_[0, np.cumsum(filled)]


def row_keys(values: pa.Array) -> np.ndarray:
    return values.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def unit_parts(raw: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """[start, end) of a long text's parts of about ``most`` bytes, each of which begins where a unit does."""
    at = 0
    while at < len(raw):
        to = at + most
        while to < len(raw):
            some = raw[to - 1 : to + 65536]
            line, space = some == 10, some == 32
            cuts = np.flatnonzero(line[1:] | line[:-1] | (space[1:] & ~space[:-1]))
            if len(cuts):
                to += int(cuts[0])
                break
            to += 65536
        yield at, min(to, len(raw))
        at = to


def sample_pieces(text: Column, key: Column, model: str, seed: int = SEED, sharpness: float = SHARPNESS) -> Column:
    """The sampled pieces' ids of a text, ``array<int>``, drawn by the row's integer key."""

    def encode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        sampler = Sampler.of(model, sharpness)
        for values, keys in batches:
            values, keys = no_nulls(values), row_keys(keys)
            parts = []
            for a, b in slices(values, SLICE_BYTES):
                ids, offsets = sampler.sample(values.slice(a, b - a), keys[a:b], seed)
                parts.append(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))
        release()

    encode.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(encode, "array<int>")(F.coalesce(text.cast("string"), F.lit("")), key.cast("long"))


def decode_pieces(ids: Column, model: str) -> Column:
    """The text of piece ids."""

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sampler = Sampler.of(model)
        for values in batches:
            values = values.fill_null([]) if values.null_count else values
            offsets = values.offsets.to_numpy().astype(np.int64)
            raw, bounds = sampler.decode(values.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0])
            yield pa.Array.from_buffers(pa.large_string(), len(values), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]).cast(pa.string())

    decode.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(decode, "string")(ids)


def encode_documents(df: DataFrame, model: str, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """``df`` with the column ``pieces`` (in place of one of that name). One pass, no shuffle; results stream out by slices."""
    df = df.drop("pieces")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, pieces array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler.of(model)
        for batch in batches:
            values = no_nulls(batch.column(text).cast(pa.string()))
            for a, b in slices(values, SLICE_BYTES):
                ids, offsets = sampler.sample(values.slice(a, b - a), row_keys(batch.column(key).slice(a, b - a)), seed)
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))], names=[*own.schema.names, "pieces"])
            del batch, values, own, ids, offsets
            release()

    return df.mapInArrow(run, schema)


def encode_and_check(df: DataFrame, model: str, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """A row for each row: id, n_pieces, pieces_crc32 (ids as 4-byte integers), lossless, pieces. Each text is decoded again and compared."""
    schema = pa.schema([(key, pa.int64()), ("n_pieces", pa.int64()), ("pieces_crc32", pa.int64()), ("lossless", pa.bool_()), ("pieces", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler.of(model)
        for batch in batches:
            values = no_nulls(batch.column("_text"))
            for a, b in slices(values, SLICE_BYTES):
                some, own = values.slice(a, b - a), batch.column("_key").slice(a, b - a)
                ids, offsets = sampler.sample(some, row_keys(own), seed)
                raw, bounds = sampler.decode(ids, offsets)
                source, source_bounds = flat_bytes(some)
                same = np.array_equal(bounds, source_bounds) and np.array_equal(raw, source)
                lossless = [True] * (b - a) if same else [bool(np.array_equal(raw[bounds[i] : bounds[i + 1]], source[source_bounds[i] : source_bounds[i + 1]])) for i in range(b - a)]
                data = ids.astype("<i4").tobytes()
                crcs = [zlib.crc32(data[4 * x : 4 * y]) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([own, pa.array(np.diff(offsets)), pa.array(crcs, pa.int64()), pa.array(lossless), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))], schema=schema)
            del batch, values, some, own, ids, offsets, raw, bounds, source
            release()

    rows = df.select(F.col(key).cast("long").alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    return rows.mapInArrow(run, f"{key} long, n_pieces long, pieces_crc32 long, lossless boolean, pieces array<int>")
