"""URL filters: allow and block rules looked up in memory-mapped arrays of sorted 64-bit digests.

A rule is a host and a path prefix (``example.net/en/``) with a verdict. It fits its host and all
subdomains if the url's path starts with the rule's; of the rules that fit, the longest wins (at equal
length the one with the longer host, then ``block``).

The index has files of about ``FILE_ENTRIES`` entries, each sorted and written by a task: ascending xxhash64 keys of full
rules and of ``<host> <length>`` entries, one for each length of path that rules of a host have; then the full strings
with their offsets and verdicts. Spark copies the files once to each executor, whose workers map them. A probe digests the host
suffixes of a batch's urls with each known length of path, finds the digests by a vectorised binary search, then
probes the rules that these hosts can have, and compares full strings, so that a collision of digests never
gives a verdict. So a url costs its host's suffixes times the lengths that any rule has, and beyond these only the rules' paths of its
own hosts.

Defined cases: null urls and urls without ``://`` have an empty host and path, no rule and the default
verdict; repeated rows each get a row; without rules every url gets the default verdict; equal rules count once, ``block`` if any is;
null rules and verdicts are left out; other columns pass through, but those of the new columns' names (parameters) give way.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkFiles, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.shared import file_system, free, shared_folder

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DEFAULT = "allow"
#: Entries in a file of the index, about.
FILE_ENTRIES = 4_000_000
#: What an entry says: a length of path that a host's rules have, or a rule's verdict.
LENGTH, ALLOW, BLOCK = 0, 1, 2


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def digests(strings: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, strings), np.uint64, len(strings))


def write_index(spark: SparkSession, rules: DataFrame | Iterable[tuple[str, str]]) -> tuple[str, ...]:
    """Writes the index of rules, (verdict, rule) pairs or a table of them, to the shared folder, and has it copied to the executors.

    Returns the files' names. A rule without a slash counts as one with an empty path.
    """
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "verdict string, rule string")
    once = rules.where("verdict IS NOT NULL AND rule IS NOT NULL").groupBy("rule").agg(F.max((F.col("verdict") == "block").cast("int")).alias("block"))
    host = F.substring_index("rule", "/", 1)
    lengths = once.select(F.concat_ws(" ", host, (F.length("rule") - F.length(host)).cast("string")).alias("entry")).distinct().withColumn("says", F.lit(LENGTH))
    entries = once.select(F.col("rule").alias("entry"), (F.col("block") + ALLOW).alias("says")).unionByName(lengths)
    folder, parts = shared_folder(spark, "urls"), max(1, -(-entries.count() // FILE_ENTRIES))
    schema = pa.schema([("path", pa.string()), ("labels", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None  # FILE_ENTRIES rows, about
        if table is None:
            return
        strings = [s.encode() for s in table.column("entry").to_pylist()]
        keys, says = digests(strings), table.column("says").to_numpy().astype(np.uint8)
        order = np.argsort(keys, kind="stable")
        sizes = np.array([len(s) for s in strings], np.uint64)[order]
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        name = f"strandline-urls-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        with fs.open_output_stream(f"{base}/{name}") as out:
            out.write(np.array([len(keys)], "<u8").tobytes())
            out.write(keys[order].astype("<u8").tobytes())
            out.write(np.r_[np.zeros(1, np.uint64), np.cumsum(sizes)].astype("<u8").tobytes())
            out.write(says[order].tobytes())
            out.write(b"".join(strings[i] for i in order.tolist()))
        some = [s.decode().rpartition(" ") for s, k in zip(strings, says.tolist()) if k == LENGTH]
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([sorted({h.count(".") + 1 for h, _, _ in some})], pa.list_(pa.int64())), pa.array([sorted({int(n) for _, _, n in some})], pa.list_(pa.int64()))], schema=schema)

    made = entries.repartition(parts, "entry").mapInArrow(run, "path string, labels array<long>, lengths array<long>").collect()  # a row for each file
    for r in made:
        spark.sparkContext.addFile(r["path"])
    meta = {"labels": sorted({x for r in made for x in r["labels"]}), "lengths": sorted({x for r in made for x in r["lengths"]})}
    return json.dumps(meta), *(r["path"].rsplit("/", 1)[1] for r in made)


class Part:
    """A file of the index, mapped."""

    def __init__(self, path: str):
        n = int(np.fromfile(path, "<u8", 1)[0])
        self.keys = np.memmap(path, "<u8", "r", 8, (n,))
        self.offsets = np.memmap(path, "<u8", "r", 8 + 8 * n, (n + 1,))
        self.says = np.memmap(path, "u1", "r", 16 + 16 * n, (n,))
        left = os.path.getsize(path) - 16 - 17 * n
        self.strings = np.memmap(path, "u1", "r", 16 + 17 * n, (left,)) if left else np.zeros(0, np.uint8)

    def find(self, strings: list[bytes], keys: np.ndarray, into: np.ndarray) -> None:
        """Writes to ``into`` what the entry equal to each string says."""
        at = np.searchsorted(self.keys, keys)
        live = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == keys))
        for i in live.tolist():
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == keys[i]:
                if self.strings[int(self.offsets[k]) : int(self.offsets[k + 1])].tobytes() == strings[i]:
                    into[i] = self.says[k]
                    break
                k += 1


class Index:
    """The opened index; one for each worker and index."""

    opened: dict[tuple, Index] = {}

    def __init__(self, names: tuple[str, ...]):
        self.parts = [Part(SparkFiles.get(n)) for n in names[1:]]
        self.meta = json.loads(names[0])

    @classmethod
    def of(cls, names: tuple[str, ...]) -> Index:
        if names not in cls.opened:
            cls.opened[names] = cls(names)
        return cls.opened[names]

    def find(self, strings: list[bytes]) -> np.ndarray:
        """What the entry equal to each string says, or -1."""
        out = np.full(len(strings), -1, np.int8)
        if strings:
            keys = digests(strings)
            for part in self.parts:
                part.find(strings, keys, out)
        return out

    def host_rules(self, hosts: list[str]) -> list[list[tuple[str, int]]]:
        """For each host the (suffix, length of path) pairs that some rule has."""
        made: dict[str, int] = {}
        own = []
        for host in hosts:
            labels = host.split(".") if host else []
            suffixes = [".".join(labels[len(labels) - n :]) for n in self.meta["labels"] if n <= len(labels)]
            own.append([(s, n, made.setdefault(f"{s} {n}", len(made))) for s in suffixes for n in self.meta["lengths"]])
        says = self.find([s.encode() for s in made])
        return [[(s, n) for s, n, k in pairs if says[k] == LENGTH] for pairs in own]

    def judge(self, hosts: pa.Array, paths: pa.Array) -> list[str | None]:
        """The winning rule of each url with its verdict first (``block net/``), or None."""
        coded = pc.dictionary_encode(hosts)
        known = self.host_rules(coded.dictionary.to_pylist())
        some = np.flatnonzero(np.array([bool(k) for k in known], bool)[coded.indices.to_numpy(zero_copy_only=False)]) if known else []
        out: list[str | None] = [None] * len(hosts)
        made: dict[str, int] = {}
        own = []
        for i in some.tolist() if len(some) else []:
            path = paths[i].as_py()
            own.append((i, [(s, made.setdefault(s + path[:n], len(made)), n) for s, n in known[coded.indices[i].as_py()] if n <= len(path)]))
        says, names = self.find([s.encode() for s in made]), list(made)
        for i, candidates in own:
            fits = [(len(names[k]), len(s), int(says[k]), names[k]) for s, k, _ in candidates if says[k] in (ALLOW, BLOCK)]
            if fits:
                _, _, verdict, rule = max(fits)
                out[i] = ("block " if verdict == BLOCK else "allow ") + rule
        return out


def filter_urls(df: DataFrame, rules: DataFrame | Iterable[tuple[str, str]] = RULES, url: str = "url", default: str = DEFAULT, host: str = "host", path: str = "path", rule: str = "rule", verdict: str = "verdict") -> DataFrame:
    """``df`` with the columns ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``. One pass, no shuffle of ``df``."""
    names = write_index(df.sparkSession, rules)
    of, at, judged = free(df, "_host", "_path", "_judged")

    @F.arrow_udf("string")
    def judge(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array(Index.of(names).judge(hosts, paths), pa.string())

    parsed = df.withColumns({of: host_of(F.col(url)), at: path_of(F.col(url))})
    found = parsed.withColumn(judged, judge(F.col(of), F.col(at)))
    new = {host: F.col(of), path: F.col(at), rule: F.substring(judged, 7, 2**31 - 1), verdict: F.coalesce(F.substring(judged, 1, 5), F.lit(default))}
    return found.withColumns(new).drop(of, at, judged)
