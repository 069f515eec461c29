"""Media columns: archives of images in the shared folder, and a data source that reads them by byte ranges.

``write_archives`` stores each text as a grey PNG of 8-bit samples, ``WIDTH`` to a row, in uncompressed zip archives, and
notes for each archive where in it, and where in its directory, every ``RANGE_BYTES`` of members begin. The data source
``strandline_archive`` plans a partition for each byte range of each archive over these notes. A partition opens the archive once,
reads its own part of the directory, then the members whose header begins in its range, in order and ``AHEAD`` bytes at
a time, and streams their bytes as Arrow batches. (Of an archive without notes it reads the whole directory.) A member that
fails is read again by its offset from a newly opened file, up to ``retries`` times, without reading the others again; then the
task fails, or with ``onError=row`` the row has the error.

Executors write under names of their own attempt, and only archives that a finished task reports are in the
folder's list. Equal texts give equal media, whatever their id. The driver holds a line for each archive (``ARCHIVE_BYTES`` of media, one
a task at least) and plans at most about ``MOST_RANGES`` ranges: beyond that they grow. A worker holds a batch (``BATCH_BYTES``) or one member.

Defined cases: null text counts as empty; empty text is stored as ``WIDTH`` spaces; a null id is stored as such;
repeated rows are members of their own; an empty table gives a folder without archives and no row; stored and deflated members are
read, others and damaged ones are errors; a row with an error has its id and size and no other figure; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import math
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strandline.llm.shared import file_system, shared_folder, texts

WIDTH = 192
ARCHIVE_BYTES = 128_000_000
RANGE_BYTES = 16_000_000
MOST_RANGES = 200_000
AHEAD = 2_000_000
BATCH_BYTES = 8_000_000
LEVEL = 3


def padded(text: bytes) -> bytes:
    """The payload: spaces up to a positive multiple of ``WIDTH`` bytes."""
    n = max(1, -(-len(text) // WIDTH)) * WIDTH
    return text + b" " * (n - len(text))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """A grey image of 8-bit samples, ``WIDTH`` wide, rows unfiltered."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)
    lines[:, 1:] = rows
    return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def from_png(media: bytes) -> np.ndarray:
    """The samples (rows, ``WIDTH``) of such an image; raises ValueError if it isn't one or is damaged."""
    if media[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, data, shape = 8, [], None
    while at < len(media):
        n, kind = struct.unpack(">I4s", media[at : at + 8])
        body = media[at + 8 : at + 8 + n]
        if struct.unpack(">I", media[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + body):
            raise ValueError("a chunk of the PNG is damaged")
        if kind == b"IHDR":
            shape = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    if shape is None or shape[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not a grey PNG of 8-bit samples")
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(shape[1], shape[0] + 1)
    if lines[:, 0].any():
        raise ValueError("the PNG has filtered rows")
    return lines[:, 1:]


def feature(samples: np.ndarray) -> str:
    """Mean, deviation and a 64-bit difference hash over 8 x 9 cells of the image."""
    values = np.arange(256, dtype=np.int64)
    counts = np.bincount(samples.ravel(), minlength=256)
    total, squares, n = int(counts @ values), int(counts @ values**2), samples.size
    columns = np.add.reduceat(samples, np.arange(9) * WIDTH // 9, axis=1, dtype=np.float64)
    bands = (np.arange(8) * len(samples)) // 8
    ends = np.maximum(((np.arange(8) + 1) * len(samples)) // 8, bands + 1)
    sums = np.concatenate([np.zeros((1, 9)), np.cumsum(columns, 0)])
    cells = (sums[ends] - sums[bands]) / (ends - bands)[:, None] / np.diff(np.r_[np.arange(9) * WIDTH // 9, WIDTH])
    bits = np.packbits((cells[:, 1:] > cells[:, :-1]).ravel()).tobytes().hex()
    return f"{total / n:.4f}:{math.sqrt((squares * n - total * total) / n**2):.4f}:{bits}"


def _cuts(members: list[zipfile.ZipInfo], directory: int) -> list[tuple[int, int]]:
    """(place in the archive, place in its directory) of the first member, of the first in each further ``RANGE_BYTES``, and of the ends."""
    out, at = [], directory
    for m in members:
        if not out or m.header_offset >= out[-1][0] + RANGE_BYTES:
            out.append((m.header_offset, at))
        at += 46 + len(m.filename.encode()) + len(m.extra) + len(m.comment)
        if max(m.header_offset, m.file_size) >= 2**32 - 1:
            return []  # its directory has wider entries
    return [*out, (directory, at)]


def write_archives(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None) -> str:
    """Stores the texts of ``df``; returns the folder. Members are named ``<id or null>_<bytes of the text>_<number>.png``."""
    spark = df.sparkSession
    folder = folder or shared_folder(spark, "media")
    schema = pa.schema([("archive", pa.string()), ("bytes", pa.int64()), ("cuts", pa.list_(pa.list_(pa.int64())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        part, number, out, done = TaskContext.get().partitionId(), 0, None, []

        def close():
            members = archive.infolist()
            archive.close()
            done.append((name, out.tell(), _cuts(members, archive.start_dir)))
            out.close()

        for batch in batches:
            for k, value in zip(batch.column("_key").to_pylist(), batch.column("_text")):
                raw = value.as_buffer().to_pybytes()
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.zip"
                    out = fs.open_output_stream(f"{base}/{name}")
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
                info = zipfile.ZipInfo(f"{'null' if k is None else k}_{len(raw)}_{number}.png")
                archive.writestr(info, to_png(padded(raw)))
                number += 1
                if out.tell() >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), schema)], schema=schema)

    rows = df.select(F.col(key).cast("long").alias("_key"), texts(text).alias("_text"))
    found = rows.mapInArrow(run, "archive string, bytes long, cuts array<array<long>>").collect()  # a row for each archive
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/_archives.json") as out:
        out.write(json.dumps([(r["archive"], r["bytes"], r["cuts"]) for r in sorted(found, key=lambda r: r["archive"])]).encode())
    return folder


class _Range(InputPartition):
    """Members whose header begins in [start, end); ``entries``: the place of theirs in the directory, if known."""

    def __init__(self, archive: str, start: int, end: int, entries: tuple[int, int] | None = None):
        super().__init__((archive, start, end))
        self.archive, self.start, self.end, self.entries = archive, start, end, entries


class _Member(NamedTuple):
    offset: int
    name: str
    method: int
    crc: int
    stored: int
    size: int


#: An entry of a zip archive's directory.
_ENTRY = struct.Struct("<4s6H3I5H2I")


def _entries(raw: bytes) -> list[_Member]:
    """The members of a part of an archive's directory."""
    out, at = [], 0
    while at < len(raw):
        sign, _, _, flags, method, _, _, crc, stored, size, name, extra, comment, _, _, _, offset = _ENTRY.unpack_from(raw, at)
        if sign != b"PK\x01\x02":
            raise ValueError("the archive's directory is damaged")
        said = raw[at + 46 : at + 46 + name].decode("utf-8" if flags & 0x800 else "cp437")
        out.append(_Member(offset, said, method, crc, stored, size))
        at += 46 + name + extra + comment
    return out


class ArchiveSource(DataSource):
    """Options: path (a folder's URI), rangeBytes, retries, onError (``fail`` or ``row``)."""

    @classmethod
    def name(cls) -> str:
        return "strandline_archive"

    def schema(self) -> str:
        return "archive string, member string, offset long, media binary, error string"

    def reader(self, schema):
        return ArchiveReader(self.options)


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"].rstrip("/")
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.retries = int(options.get("retries", 3))
        self.row_errors = options.get("onError", "fail") == "row"

    def partitions(self):
        from pyarrow import fs as arrow_fs

        fs, base = file_system(self.folder)
        if fs.get_file_info(f"{base}/_archives.json").type == arrow_fs.FileType.File:
            with fs.open_input_stream(f"{base}/_archives.json") as f:
                archives = json.loads(f.read())
        else:
            archives = sorted((i.base_name, i.size, []) for i in fs.get_file_info(arrow_fs.FileSelector(base)) if i.base_name.endswith(".zip"))
        width = max(self.range_bytes, sum(a[1] for a in archives) // MOST_RANGES)
        ranges = []
        for name, size, cuts in archives:
            if cuts:
                chosen = cuts[:1]
                for cut in cuts[1:-1]:
                    if cut[0] >= chosen[-1][0] + width:
                        chosen.append(cut)
                ranges += [_Range(name, a[0], b[0], (a[1], b[1])) for a, b in zip(chosen, [*chosen[1:], cuts[-1]])]
            else:
                ranges += [_Range(name, at, min(at + width, size)) for at in range(0, size, width)]
        return ranges or [_Range("", 0, 0)]
    def tried(self, read):
        """What ``read()`` gives, tried ``retries`` times more."""
        for tries in range(self.retries + 1):
            try:
                return read()
            except (OSError, ValueError, zipfile.BadZipFile, zlib.error):
                if tries == self.retries:
                    raise
                time.sleep(min(0.05 * 2**tries, 2))

    @staticmethod
    def members(f, partition) -> list[_Member]:
        """The members of a range, in order."""
        if partition.entries:
            f.seek(partition.entries[0])
            return _entries(f.read(partition.entries[1] - partition.entries[0]))
        with zipfile.ZipFile(f) as directory:
            found = [_Member(i.header_offset, i.filename, i.compress_type, i.CRC, i.compress_size, i.file_size) for i in directory.infolist()]
        return sorted(m for m in found if partition.start <= m.offset < partition.end)

    def read(self, partition):
        schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("media", pa.binary()), ("error", pa.string())])
        if not partition.archive:
            return
        fs, base = file_system(self.folder)
        path = f"{base}/{partition.archive}"

        def opened():
            with fs.open_input_file(path) as f:
                return self.members(f, partition)

        members = self.tried(opened)
        window = _Window(fs, path)
        rows, held = [], 0
        for m in members:
            try:
                try:
                    data, error = window.member(m), None
                except (OSError, ValueError, zlib.error):
                    if not self.retries:
                        raise
                    data, error = self.again(fs, path, m), None
            except (OSError, ValueError, zlib.error) as e:
                if not self.row_errors:
                    raise
                data, error = None, str(e)
            rows.append((partition.archive, m.name, m.offset, data, error))
            held += len(data or b"")
            if held >= BATCH_BYTES or len(rows) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
                rows, held = [], 0
        window.close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    def again(self, fs, path: str, m: _Member) -> bytes:
        """A member that failed, by its offset alone, each time from a newly opened file."""
        for tries in range(self.retries):
            time.sleep(min(0.05 * 2**tries, 2))
            window = _Window(fs, path, ahead=0)
            try:
                return window.member(m)
            except (OSError, ValueError, zlib.error):
                if tries == self.retries - 1:
                    raise
            finally:
                window.close()


class _Window:
    """An opened archive, read ``ahead`` bytes at a time: members asked for in order cost no read of their own."""

    def __init__(self, fs, path: str, ahead: int = AHEAD):
        self.fs, self.path, self.ahead, self.file, self.at, self.held = fs, path, ahead, None, 0, b""

    def bytes(self, at: int, n: int) -> memoryview:
        if at < self.at or at + n > self.at + len(self.held):
            if self.file is None:
                self.file = self.fs.open_input_file(self.path)
            self.file.seek(at)
            self.at, self.held = at, self.file.read(max(n, self.ahead))
            if len(self.held) < n:
                raise ValueError(f"{self.path} ends before {at + n}")
        return memoryview(self.held)[at - self.at : at - self.at + n]

    def member(self, m: _Member) -> bytes:
        """A member's bytes; after an error the next one opens the archive anew."""
        try:
            head = self.bytes(m.offset, 30)
            if head[:4] != b"PK\x03\x04":
                raise ValueError(f"no member at {m.offset} of {self.path}")
            name, extra = struct.unpack("<HH", head[26:30])
            data = bytes(self.bytes(m.offset + 30 + name + extra, m.stored))
            if m.method == zipfile.ZIP_DEFLATED:
                data = zlib.decompressobj(-15).decompress(data, m.size + 1)
            elif m.method != zipfile.ZIP_STORED:
                raise ValueError(f"the member at {m.offset} of {self.path} is packed by method {m.method}")
            if len(data) != m.size or zlib.crc32(data) != m.crc:
                raise ValueError(f"the member at {m.offset} of {self.path} is damaged")
            return data
        except (OSError, ValueError, zlib.error):
            self.close()
            raise

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.file, self.held = None, b""


def read_archives(spark: SparkSession, folder: str, **options) -> DataFrame:
    """(archive, member, offset, media, error) of all members of the archives in a folder."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("strandline_archive").options(path=folder, **options).load()


def describe(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row for each member, computed from the stored bytes: sizes, digests and the feature of the decoded samples.

    A member that could not be read has its id and size, null figures and the error.
    """
    schema = pa.schema([(key, pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, media, error in zip(batch.column("member").to_pylist(), batch.column("media"), batch.column("error").to_pylist()):
                k, n, _ = name.split("_")
                own = (None if k == "null" else int(k), int(n))
                media = media.as_py()
                if media is None:
                    rows.append((*own, *[None] * 6, error))
                    continue
                samples = from_png(media)
                payload = samples.tobytes()
                rows.append((*own, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples), error))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    return media.select("member", "media", "error").mapInArrow(run, f"{key} long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string")
