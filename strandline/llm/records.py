"""Token-ID output: length-delimited binary records with masked checksums, and an offset index beside each file.

A file is a run of frames: length (8 bytes, little-endian), masked CRC-32C of the length (4), payload, masked
CRC-32C of the payload (4); this is the public TFRecord framing. A payload is one byte of flags (1: the id is null,
2: ids are 4 bytes wide), the row's id (8 bytes), and the token ids (2 bytes each where the vocabulary allows).
``<file>.idx`` holds each frame's offset as 8 bytes, so that a shuffled reader fetches record i with two reads.

Rows are range-partitioned and sorted by id, then by a hash of the text; each task writes its files under its own attempt's name, and only
files that a finished task reports are read; a lost executor's task is just run again. Whole texts are
encoded by the tokenizers library. Where the tokenizer drops white space between words, each distinct word is
encoded once by the library and the ids are put together per row, which gives the same ids. Only a mark after a letter that stays
one letter (``PLAIN``) is parted from its word: others may change into letters with marks of their own, which join the mark.

The driver gets a row for each file (of ``FILE_BYTES``, one a task at least), to number the ids across files.

Defined cases: null and empty texts give just the end id; null ids come first; rows with equal ids are
ordered by the xxhash64 of the text and each gets a record; rows equal in id and text may lie on both sides of a file's end; an empty
table gives no file and no row. A text is held whole by one worker, with about 30 bytes for each of its tokens.
"""

from __future__ import annotations

import json
import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.shared import file_system, no_nulls, pieces_of, release, shared_folder, steady, texts

END_ID = 2
FILE_BYTES = 512_000_000
#: Words that a worker keeps encoded; marks that are parted from words.
STORED = 500_000
MARKS = frozenset(".,;:!?|")
#: Letters (Latin, Greek, Cyrillic) that stay one letter when normalised and lower-cased, so that a mark behind them begins a piece.
PLAIN = frozenset(c for c in map(chr, range(0x41, 0x500)) if c.isalpha() and len(c.lower()) == 1 and all(unicodedata.normalize("NFC", x) == x and x.isalpha() for x in (c, c.lower())))


def _tables() -> np.ndarray:
    """Eight tables of the CRC-32C (reflected polynomial 0x82F63B78), for eight bytes a step."""
    t = np.zeros((8, 256), np.uint32)
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0x82F63B78), c >> 1)
    t[0] = c
    for k in range(1, 8):
        t[k] = (t[k - 1] >> 8) ^ t[0][t[k - 1] & 255]
    return t


def _pair_tables() -> list[np.ndarray]:
    """Four tables for two bytes each, made of the eight."""
    t, x = _tables(), np.arange(65536)
    return [t[k + 1][x & 255] ^ t[k][x >> 8] for k in (6, 4, 2, 0)]


_T = _pair_tables()


def crc32c_many(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32C of each raw[start:end] (at least 4 bytes long), all of about one length at once.

    Leading zeros do not change a register of zero, so messages are aligned at their ends; the usual
    initial value is the same as inverting a message's first four bytes.
    """
    sizes = ends - starts
    steps = -(-sizes // 8)
    out = np.zeros(len(sizes), np.uint32)
    bucket = np.ceil(np.log2(np.maximum(steps, 1))).astype(np.int64)
    for b in np.unique(bucket):
        which = np.flatnonzero(bucket == b)
        width = int(steps[which].max()) * 8
        for at in range(0, len(which), max(1, 8_000_000 // width)):
            some = which[at : at + max(1, 8_000_000 // width)]
            lanes = np.zeros((len(some), width), np.uint8)
            for lane, i in enumerate(some):
                n = int(sizes[i])
                lanes[lane, width - n :] = raw[starts[i] : ends[i]]
                lanes[lane, width - n : width - n + 4] ^= 255
            columns = np.ascontiguousarray(lanes.view("<u2").T)
            crc = np.zeros(len(some), np.uint32)
            for w in range(0, width // 2, 4):
                low, high = crc.astype(np.uint16) ^ columns[w], (crc >> 16).astype(np.uint16) ^ columns[w + 1]
                crc = _T[0].take(low) ^ _T[1].take(high) ^ _T[2].take(columns[w + 2]) ^ _T[3].take(columns[w + 3])
            out[some] = ~crc
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    return (((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)).astype(np.uint32)


class Encoder:
    """Encodes batches of texts with a tokenizers file; one for each worker and path."""

    opened: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        split = [p for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if p.get("type") == "Split"]
        # White space only parts words if the words' pattern is what is kept and the rest is removed.
        lowers = "Lowercase" in json.dumps(spec.get("normalizer") or {})
        self.by_word = lowers and bool(split) and split[0]["behavior"] == "Removed" and split[0]["invert"] and r"[^\s" in split[0]["pattern"].get("Regex", "") and not (spec.get("post_processor"))
        special = [t for t in spec.get("added_tokens", []) if t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])]
        self.mark = (special[0]["content"], special[0]["id"]) if special else None
        self.by_word = self.by_word and self.mark is not None
        self._empty()
        suffix = spec["model"].get("end_of_word_suffix")
        self.ends = None
        if suffix:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for w, i in vocabulary.items() if w.endswith(suffix)]] = True
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 65536 else 4

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls.opened:
            cls.opened[path] = cls(path)
        return cls.opened[path]

    def _fresh(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, their counts): many words go in one call.

        Words of letters alone are parted by spaces: each is one piece, whose last token bears the word end. Others are
        parted by a special token; words that hold one go alone, as do those of a call whose word ends don't match.
        """
        mark, mark_id = self.mark
        letters = self.ends is not None and all(w.isalpha() for w in words)
        ids, sizes = [], []
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            if letters:
                got = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
                last = np.flatnonzero(self.ends[got])
                if len(last) == len(some) and last[-1] == len(got) - 1:
                    ids.append(got)
                    sizes.append(np.diff(last, prepend=-1))
                    continue
            elif not any(mark in w for w in some):
                got = np.array(self.tokenizer.encode_batch_fast([mark.join(some)], add_special_tokens=False)[0].ids, np.uint32)
                between = np.flatnonzero(got == mark_id)
                sizes.append(np.diff(np.r_[-1, between, len(got)]) - 1)
                ids.append(got[got != mark_id])
                continue
            for w in some:
                ids.append(np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint32))
                sizes.append(np.array([len(ids[-1])]))
        return (np.concatenate(ids), np.concatenate(sizes)) if ids else (np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _store(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.sizes), len(self.sizes) + len(words))))
        self.flat, self.sizes = np.concatenate([self.flat, ids]), np.concatenate([self.sizes, sizes.astype(np.int32)])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int32)])
        self.first = np.cumsum(self.sizes, dtype=np.int32) - self.sizes

    def _gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the stored words at these places, their running counts)."""
        n = self.sizes[places]
        ends = np.cumsum(n, dtype=np.int32)
        index = np.repeat(self.first[places] - (ends - n), n)
        index += np.arange(len(index), dtype=np.int32)
        return self.flat[index], ends

    def _trim(self) -> None:
        """Keeps of an overfull store the words that at least two batches used; of a store full of those, none."""
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > STORED // 2:
            keep = keep[:0]
        named = {i: w for w, i in self.known.items()}
        keep = keep[[i in named for i in keep.tolist()]] if len(keep) else keep
        words = [named[i] for i in keep.tolist()]
        ids, sizes = (self._gather(keep)[0], self.sizes[keep]) if len(keep) else (np.zeros(0, np.uint32), np.zeros(0, np.int32))
        self._empty()
        self._store(words, ids, sizes)
        self.uses += 1

    def _empty(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.sizes, self.uses = np.zeros(0, np.uint32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _places(self, words: list[str]) -> np.ndarray:
        """The words' numbers in the store of encoded words, which is trimmed first if it has over ``STORED`` words."""
        if len(self.known) > STORED:
            self._trim()
        known = self.known
        places = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(places < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            parts = self._parts(new)
            fresh = [w for w in dict.fromkeys(["", *MARKS, *(s for s, _ in parts)]) if w not in known]
            for some in ([w for w in fresh if w.isalpha()], [w for w in fresh if not w.isalpha()]):
                if some:
                    self._store(some, *self._fresh(some))
            made = [(w, p) for w, p in zip(new, parts) if p[0] is not w]
            if made:
                ids, to = self._gather(np.fromiter((known[x] for _, pair in made for x in pair), np.int64, 2 * len(made)))
                self._store([w for w, _ in made], ids, np.diff(to[1::2], prepend=0))
            places[missing] = np.fromiter(map(known.__getitem__, new), np.int64, len(new))
        self.uses[places] += 1
        return places

    def _parts(self, words: list[str]) -> list[tuple[str, str]]:
        """(stem, mark) of each word: a mark of ``MARKS`` that follows a letter of ``PLAIN`` at the word's end, or none.

        Such a letter stays one, so the mark begins a piece of its own, whatever is before. That is not so of all letters:
        U+0130 in lower case and U+0958 normalised end in marks, which the tokenizer joins with the next. Stems of ASCII
        letters are lower-cased, as the tokenizer does with all.
        """
        out = []
        for w in words:
            mark = w[-1:]
            if mark in MARKS and w[-2:-1] in PLAIN:
                w = w[:-1]
            else:
                mark = ""
            out.append((w.lower() if w.isascii() and w.isalpha() and not w.islower() else w, mark))
        return out

    def encode(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets by row) of an array of texts without nulls."""
        if not self.by_word:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(values.to_pylist(), add_special_tokens=False)]
            offsets = np.cumsum([0, *map(len, ids)], dtype=np.int64)
            return np.fromiter((i for x in ids for i in x), np.uint32, int(offsets[-1])), offsets
        split = pc.ascii_split_whitespace(values)
        coded = split.values.dictionary_encode()
        places = self._places(coded.dictionary.to_pylist())
        ids, ends = self._gather(places[coded.indices.to_numpy(zero_copy_only=False)])
        rows = split.offsets.to_numpy().astype(np.int64)
        return ids, np.concatenate([[0], ends])[rows - rows[0]].astype(np.int64)


_HEAD = np.dtype([("flags", "u1"), ("key", "<i8")])


def frames(keys: list, ids: np.ndarray, offsets: np.ndarray, width: int) -> tuple[bytes, np.ndarray]:
    """(frames, their sizes) of rows with the given keys (None: null) and token ids."""
    heads = np.zeros(len(keys), _HEAD)
    heads["flags"] = [(k is None) + 2 * (width == 4) for k in keys]
    heads["key"] = [k or 0 for k in keys]
    head, body = heads.tobytes(), ids.astype("<u2" if width == 2 else "<u4").tobytes()
    h = _HEAD.itemsize
    parts = [head[h * i : h * i + h] + body[a * width : b * width] for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist()))]
    sizes = np.diff(offsets) * width + h
    ends = np.cumsum(sizes)
    checks = masked(crc32c_many(np.frombuffer(b"".join(parts), np.uint8), ends - sizes, ends)).astype("<u4").tobytes()
    lengths = sizes.astype("<u8").tobytes()
    at = np.arange(len(parts)) * 8
    length_checks = masked(crc32c_many(np.frombuffer(lengths, np.uint8), at, at + 8)).astype("<u4").tobytes()
    framed = [x for i, p in enumerate(parts) for x in (lengths[8 * i : 8 * i + 8], length_checks[4 * i : 4 * i + 4], p, checks[4 * i : 4 * i + 4])]
    return b"".join(framed), sizes + 16


MANIFEST = "part int, seq int, path string, n_records long, n_tokens long"


def write_records(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Writes the rows of ``df`` in ascending order of ``key``; returns the files, (part, seq, path, n_records, n_tokens, base).

    ``base`` is the number of ids in all files before. The list has a row for each file and is made at once.
    """
    spark = df.sparkSession
    folder = folder or shared_folder(spark, "records")
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_records", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        fs, base = file_system(folder)
        part = TaskContext.get().partitionId()
        seq, out, at, done = 0, None, 0, []
        sizes: list[np.ndarray] = []

        def close():
            out.close()
            starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))[:-1]]).astype("<u8")
            with fs.open_output_stream(path + ".idx") as index:
                index.write(starts.tobytes())
            done.append((part, seq, f"{folder}/{path.rsplit('/', 1)[1]}", len(starts), tokens))

        for batch in batches:
            for some in pieces_of(batch, "_text", 8_000_000):
                ids, offsets = encoder.encode(no_nulls(some.column("_text")))
                n = len(offsets) - 1
                ids = np.insert(ids, offsets[1:], end_id)
                offsets = offsets + np.arange(n + 1)
                data, lengths = frames(some.column("_key").to_pylist(), ids, offsets, encoder.width)
                if out is None:
                    fs.create_dir(base, recursive=True)
                    path = f"{base}/part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.rec"
                    out, at, sizes, tokens = fs.open_output_stream(path), 0, [], 0
                out.write(data)
                at += len(data)
                sizes.append(lengths)
                tokens += len(ids)
                if at >= FILE_BYTES:
                    close()
                    seq, out = seq + 1, None
        if out is not None:
            close()
        release()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), schema)], schema=schema)

    # The hash parts rows of one id, the row's number those that are alike in all, so that neither fills a partition.
    rows = steady(df.select(F.col(key).cast("long").alias("_key"), texts(text).alias("_text")))
    rows = rows.withColumns({"_hash": F.xxhash64("_text"), "_row": F.monotonically_increasing_id()})
    dealt = rows.repartitionByRange("_key", "_hash", "_row").sortWithinPartitions("_key", "_hash", "_row").select("_key", "_text")
    files = sorted(dealt.mapInArrow(run, MANIFEST).collect())  # a row for each file, not for each record
    bases = np.cumsum([0, *(f["n_tokens"] for f in files)]).tolist()
    return spark.createDataFrame([(*f, b) for f, b in zip(files, bases)], MANIFEST + ", base long")


def split_frames(data: memoryview) -> tuple[list[tuple[int, int]], int]:
    """((start, end) of each whole frame's payload, bytes used)."""
    found, at = [], 0
    while at + 16 <= len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        if at + 16 + n > len(data):
            break
        found.append((at + 12, at + 12 + n))
        at += 16 + n
    return found, at


def parse(payload: memoryview) -> tuple[int | None, np.ndarray]:
    """(id, token ids) of a payload."""
    flags = payload[0]
    key = None if flags & 1 else int.from_bytes(payload[1:9], "little", signed=True)
    return key, np.frombuffer(payload[9:], "<u4" if flags & 2 else "<u2")


def check_frames(raw: np.ndarray, spans: list[tuple[int, int]]) -> None:
    """Raises ValueError if a frame's length or payload does not match its checksum."""
    if not spans:
        return
    a, b = np.array(spans, np.int64).T
    stored = lambda at: sum(raw[at + k].astype(np.uint32) << np.uint32(8 * k) for k in range(4))
    if (masked(crc32c_many(raw, a - 12, a - 4)) != stored(a - 4)).any() or (masked(crc32c_many(raw, a, b)) != stored(b)).any():
        raise ValueError("a record does not match its checksum")


def read_file(path: str, chunk: int = 8_000_000) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """The records of a file in order, some at a time, checked."""
    fs, local = file_system(path)
    with fs.open_input_stream(local) as f:
        left = b""
        while True:
            more = f.read(chunk)
            data = left + more
            spans, used = split_frames(memoryview(data))
            check_frames(np.frombuffer(data, np.uint8), spans)
            if spans:
                yield [parse(memoryview(data)[a:b]) for a, b in spans]
            left = data[used:]
            if len(more) == 0:
                if left:
                    raise ValueError(f"{path} ends within a record")
                return
            if len(left) > chunk:
                chunk = len(left)


def read_at(path: str, i: int) -> tuple[int | None, np.ndarray]:
    """Record ``i`` of a file, by the index: for shuffled reads."""
    fs, local = file_system(path)
    with fs.open_input_file(local + ".idx") as f:
        f.seek(8 * i)
        at = int.from_bytes(f.read(8), "little")
    with fs.open_input_file(local) as f:
        f.seek(at)
        head = f.read(12)
        n = int.from_bytes(head[:8], "little")
        data = head + f.read(n + 4)
    check_frames(np.frombuffer(data, np.uint8), [(12, 12 + n)])
    return parse(memoryview(data)[12 : 12 + n])


def read_records(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row for each record of the files: id, start (ids before it), n_tokens, ids_crc32 (over 4-byte ids)."""
    schema = pa.schema([(key, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                at = base
                for some in read_file(path):
                    out = []
                    for k, ids in some:
                        out.append((k, at, len(ids), zlib.crc32(ids.astype("<u4"))))
                        at += len(ids)
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    return files.select("path", "base").repartition(max(files.count(), 1), "path").mapInArrow(run, f"{key} long, start long, n_tokens long, ids_crc32 long")
