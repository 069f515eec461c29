"""The registered queries over small tables against brute force, column by column."""

import collections
import hashlib
import io
import math
import random
import re
import struct
import zipfile
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from strandline.llm import chat, media, mixing, pieces, quality, queries, records, rules, secrets, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n=120):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(["the", "an", "re", "on", "st", "li"]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def junk(seed, n=100):
    return " | ".join(w + "!!" for w in prose(seed, n).upper().split())


def nasty(seed):
    """Text with keys, digests, hex runs, words of the allow-list and near misses."""
    rnd = random.Random(seed)
    run = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    some = [
        lambda: "password = " + run("abcDEF019/+=.-_", rnd.randint(4, 9)), lambda: "API_KEY:'" + run("xyz789", 30) + "'", lambda: "AKIA" + run("ABCD0123", rnd.randint(14, 24)),
        lambda: run("0123456789abcdef", rnd.randint(20, 70)), lambda: run("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", rnd.randint(15, 50)),
        lambda: "sha256-" + run("abcdefghijklmnopqrstuvwxyzABCDEF0123456789", 43) + "=", lambda: "example/" + run("abcdefghijkmnpqrstuvwxyz23456789", 26), lambda: prose(rnd.random(), 3), lambda: "é🙂ſ", lambda: "token=" + "AKIA" + run("ABCD0123", 20),
    ]
    return "".join(rnd.choice(some)() + rnd.choice([" ", "\n", "", ";"]) for _ in range(rnd.randint(0, 12)))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of documents (odd, near and exact copies, secrets, null and repeated ids, a 10 MB text) and labels."""
    good = [(i, prose(i, 150)) for i in range(60)]
    bad = [(100 + i, junk(500 + i)) for i in range(60)]
    copies = [(300, good[0][1] + " end"), (301, good[1][1] + " password=abcdef99"), (302, good[2][1])]
    odd = [(None, None), (None, ""), (None, "null id"), (None, "null id"), (400, None), (401, ""), (402, " \n\t "), (403, "one"), (403, "one"), (404, "Ünï ▁ \x00 日本 🙂 <|endoftext|> it's")]
    rows = good + bad + copies + odd + [(500 + i, nasty(i)) for i in range(60)] + [(900, prose(77, 1_600_000))]
    at = str(tmp_path_factory.mktemp("sf"))
    table = spark.createDataFrame([(k, t, "en", None if k is None else f"s{k % 3}", len(t or "")) for k, t in rows], DOCS)
    table.repartition(6).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(302, None, 0), (401, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    assert len(rows[-1][1]) > 10_000_000
    return at, rows


def entropy_spans(text):
    """The entropy spans of a text by direct counts, without suppression."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        for a, b in secrets.not_public(m.group()):
            part, found = m.group()[a:b], []
            for i in range(len(part) - 19):
                window = part[i : i + 20]
                kind = secrets.kind_of(window)
                bits = -sum(c / 20 * math.log2(c / 20) for c in collections.Counter(window).values())
                if kind and bits >= secrets.THRESHOLDS[kind] - 1e-9 and not secrets.reads_as_words(window, kind):
                    if found and i <= found[-1][2]:
                        found[-1] = (max(found[-1][0], kind, key=secrets.KINDS.index), found[-1][1], i + 20)
                    else:
                        found.append((kind, i, i + 20))
            out += [(k, m.start() + a + s, m.start() + a + e) for k, s, e in found]
    return out


def brute_secrets(text):
    base, at = [], 0
    words = ["password", "passwd", "secret", "token", "api_key", "apikey"]
    safe = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    while at < len(text):
        word = next((w for w in words if lower.startswith(w, at)), None)
        end = start = 0
        if word:
            # the optional parts may also be left out where that alone lets the rest match
            for quote in (1, 0):
                i = at + len(word)
                if quote and text[i : i + 1] not in ("'", '"') or quote and not text[i : i + 1]:
                    continue
                i += quote
                while text[i : i + 1] == " ":
                    i += 1
                if text[i : i + 1] in (":", "=") and text[i : i + 1]:
                    i += 1
                    while text[i : i + 1] == " ":
                        i += 1
                    if text[i : i + 1] in ("'", '"') and text[i : i + 1]:
                        i += 1
                    start = end = i
                    while end < len(text) and text[end] in safe:
                        end += 1
                    if end > start:
                        break
                    end = start = 0
        if end > start:
            base.append(("assign", at, end, end - start >= 6))
            at = end
        else:
            at += 1
    spans = [x[:3] for x in base if x[3]]
    for kind, head, letters, least in (("access", "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20), ("hex", "", set("0123456789abcdef"), 24)):
        at = 0
        while at < len(text):
            end = at + len(head)
            if text.startswith(head, at) and text[end : end + 1] and text[end] in letters:
                while end < len(text) and text[end] in letters:
                    end += 1
                if end - at >= least:
                    spans.append((kind, at, end))
                at = end
            else:
                at += 1
    extra = [x for x in entropy_spans(text) if not any(s <= x[1] and x[2] <= e for _, s, e in spans)]
    order = lambda x: (x[1], secrets.KINDS.index(x[0]), x[2])
    return sorted(spans, key=order), sorted(spans + extra, key=order)


def test_op1_equals_brute_force(spark, tables):
    at, rows = tables
    joined = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    want = []
    for k, t in rows:
        base, every = brute_secrets(t or "") if k != 900 else ([], [])
        kinds = collections.Counter(x[0] for x in base)
        want.append((k, kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
    got = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in queries.op1_secret_scan(spark, at).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(len(w[5]) for w in want) > 1000


def test_secrets_in_a_long_list_take_time_in_proportion():
    import time

    rnd = random.Random(4)
    line = lambda: "%032x  AKIA%s token=%x\n" % (rnd.getrandbits(128), "".join(rnd.choice("ABCDEFGH01234567") for _ in range(16)), rnd.getrandbits(60))
    took = []
    for n in (2000, 16000):
        text = "".join(line() for _ in range(n))
        began = time.process_time()
        assert len(secrets.scan(text)) >= 3 * n
        took.append(time.process_time() - began)
    assert took[1] < 20 * took[0]


def test_op3_scores_equal_plain_compression(spark, tables):
    at, rows = tables
    got = queries.op3_quality(spark, at).collect()
    assert len(got) == len(rows)
    model = quality.fit(spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet"))

    def size(text, raw):
        packer = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=False, write_checksum=False, write_dict_id=False)
        return sum(len(packer.compress(text[i : i + quality.BLOCK])) for i in range(0, len(text), quality.BLOCK))

    want = []
    for k, t in rows:
        raw = (t or "").encode()
        d = (size(raw, model.bad) - size(raw, model.good)) / len(raw) if raw else 0.0
        score = 0.999 * float(np.interp(d, model.xs, model.ys)) + 0.001 * (0.5 + math.atan(40 * d) / math.pi)
        want.append((k, zlib.crc32(str(k).encode()) % 5 == 0 if k is not None else False, round(score, 9), int(score >= 0.3)))
    assert sorted(((r.doc_id, r.held_out if r.doc_id is not None else False, round(r.score, 9), r.predicted) for r in got), key=str) == sorted(want, key=str)
    assert list(model.ys) == sorted(model.ys) and list(model.xs) == sorted(model.xs)


def test_fit_uses_any_number_of_rows_and_no_held_out_one(spark, tables):
    at, rows = tables
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    held = [r.doc_id for r in labels.where(quality.held_out()).collect()]
    changed = docs.withColumn("text", F.when(F.col("doc_id").isin(held), "changed").otherwise(F.col("text")))
    assert quality.fit(changed, labels) == quality.fit(docs, labels)
    few = quality.fit_texts([prose(1).encode()], [junk(2).encode()])
    scorer = quality.Scorer(few)
    a, b = scorer.scores(np.array([scorer.difference(prose(1).encode()), scorer.difference(junk(2).encode())]))
    assert a > b and quality.fit_texts([b"x"], []).share == 1.0


def oracle_rows(at, sql, columns):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{at}/documents.parquet/*.parquet'")
    out = con.execute(sql).fetchall()
    names = [d[0] for d in con.description]
    return sorted((tuple(r[names.index(c)] for c in columns) for r in out), key=str)


def test_op4_with_null_and_repeated_ids_equals_sql(spark, tmp_path):
    rows = [(None, f"text {i}", "en", "a", 1) for i in range(600)] + [(None, "same", "en", "a", 1)] * 700 + [(7, "same id", "en", "b", 1)] * 300 + [(i, "t", "en", None, 1) for i in range(100)] + [(None, None, None, "b", None)] * 3
    rows += [(10**6 + i, "x", "en", "tiny", 1) for i in range(2)]
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["doc_id", "text", "lang", "source", "n_chars", "copy", "shuffle_key"]
    out = mixing.mix_sources(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    got = out.select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == oracle_rows(tmp_path, mixing.oracle(), columns)
    same = [r for r in got if r.text == "same"]
    assert 0.7 < len(same) / 700 < 1.3 and len({r.copy for r in same}) > 2 and len({r.shuffle_key for r in same}) == len(same)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert out.where("text = 'same'").select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("rate", [0.2, 3.0, 140.0, 700.0, 40_000.0, 3e6])
def test_distributions_of_any_rate(spark, rate):
    row = mixing.with_cdf(spark.createDataFrame([("s", rate)], "_source string, rate double")).first()
    pick = random.Random(1).sample(range(len(row.cdf)), min(len(row.cdf), 60)) if rate < 1e5 else range(0, len(row.cdf), 2000)
    exact = lambda k: math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
    assert row["first"] == 0 or rate > 400
    assert abs(row.cdf[-1] - 1) < 1e-8 and len(row.cdf) < 25 * math.sqrt(rate) + 60
    for i in pick:
        if i:
            assert abs(row.cdf[i] - row.cdf[i - 1] - exact(row["first"] + i)) < 1e-9
    assert abs(row.cdf[0] - exact(row["first"])) < 1e-12


def test_large_rates_make_their_copies(spark):
    docs = spark.createDataFrame([(1, "a", "en", "x", 1), (2, "b", "en", "y", 1)], DOCS)
    out = mixing.mix_sources(docs, weights={"x": 1.0}, epochs=30_000.0)
    r = out.agg(F.count("*").alias("n"), F.max("copy").alias("m"), F.countDistinct("copy").alias("d"), F.max("source").alias("s")).first()
    assert abs(r.n - 60_000) < 2000 and r.n == r.m == r.d and r.s == "x"


def unpack_png(raw):
    at, data = 8, b""
    while at < len(raw):
        n, kind = struct.unpack(">I4s", raw[at : at + 8])
        if kind == b"IHDR":
            width, height = struct.unpack(">II", raw[at + 8 : at + 16])
        if kind == b"IDAT":
            data += raw[at + 8 : at + 8 + n]
        at += 12 + n
    lines = zlib.decompress(data)
    return b"".join(lines[i * (width + 1) + 1 : (i + 1) * (width + 1)] for i in range(height)), width, height


def brute_feature(payload, width):
    rows = [payload[i : i + width] for i in range(0, len(payload), width)]
    n, total = len(payload), sum(payload)
    variance = sum((x - total / n) ** 2 for x in payload) / n
    edges, bits = [c * width // 9 for c in range(9)] + [width], ""
    for band in range(8):
        a, b = band * len(rows) // 8, (band + 1) * len(rows) // 8
        b = max(b, a + 1)
        means = [sum(sum(r[edges[c] : edges[c + 1]]) for r in rows[a:b]) / (b - a) / (edges[c + 1] - edges[c]) for c in range(9)]
        bits += "".join("1" if y > x else "0" for x, y in zip(means, means[1:]))
    return f"{total / n:.4f}:{math.sqrt(variance):.4f}:{int(bits, 2):016x}"


def test_op5_equals_brute_force(spark, tables):
    at, rows = tables
    want = []
    for k, t in rows:
        raw = (t or "").encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        stored = media.to_png(payload)
        back, width, _ = unpack_png(stored)
        assert back == payload and width == 192
        want.append((k, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), brute_feature(payload, 192) if k != 900 else None))
    got = [tuple(r)[:8] for r in queries.op5_media(spark, at).collect()]
    assert sorted((x if x[0] != 900 else (*x[:7], None) for x in got), key=str) == sorted(want, key=str)


def test_archives_of_others_errors_and_ranges(spark, tmp_path):
    """Deflated members, damaged ones and foreign archives; ranges by notes and without give the same rows."""
    docs = spark.createDataFrame([(i, prose(i, 60)) for i in range(300)], "doc_id long, text string").coalesce(1)
    folder = media.write_archives(docs)
    plain = sorted(map(str, media.describe(media.read_archives(spark, folder)).collect()))
    reader = media.ArchiveReader({"path": folder, "rangeBytes": "20000"})
    assert len(plain) == 300 and len(reader.partitions()) == 1  # notes are RANGE_BYTES apart
    local = folder.removeprefix("file://")
    import json
    import os

    notes = json.load(open(f"{local}/_archives.json"))
    archive = notes[0][0]
    members = zipfile.ZipFile(f"{local}/{archive}").infolist()
    old = media.RANGE_BYTES
    try:
        media.RANGE_BYTES = 5000
        cuts = media._cuts(members, zipfile.ZipFile(f"{local}/{archive}").start_dir)
    finally:
        media.RANGE_BYTES = old
    assert len(cuts) > 5
    json.dump([[archive, notes[0][1], cuts]], open(f"{local}/_archives.json", "w"))
    assert sorted(map(str, media.describe(media.read_archives(spark, folder, rangeBytes=6000)).collect())) == plain
    os.remove(f"{local}/_archives.json")
    assert sorted(map(str, media.describe(media.read_archives(spark, folder, rangeBytes=7000)).collect())) == plain
    with zipfile.ZipFile(tmp_path / "d.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(4):
            z.writestr(f"{i}_5_{i}.png", media.to_png(media.padded(b"abc d" if i != 2 else bytes(random.Random(2).randbytes(5)))))
    raw = bytearray((tmp_path / "d.zip").read_bytes())
    at = zipfile.ZipFile(io.BytesIO(bytes(raw))).infolist()[1].header_offset
    raw[at + 30 + 9 + 20] ^= 255
    (tmp_path / "d.zip").write_bytes(raw)
    out = {r.doc_id: r for r in media.describe(media.read_archives(spark, f"file://{tmp_path}", onError="row", retries=1)).collect()}
    assert out[0].payload_sha256 == hashlib.sha256(media.padded(b"abc d")).hexdigest() and out[0].error is None
    assert out[1].error and out[1].feature is None and out[1].n_bytes == 5 and set(out) == {0, 1, 2, 3}


def test_op6_and_op2_on_these_tables(spark, tables, monkeypatch):
    at, rows = tables
    from tests.llm.test_operators import brute_components, brute_metrics

    monkeypatch.setattr(rules, "TRIES", 1)
    got = queries.op6_quality_rules(spark, at)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    once = lambda found: [r for r in found if r[0] is not None and r[0] != 403]  # the SQL joins by id
    assert once(sorted(map(tuple, got.select(*columns).collect()), key=str)) == once(oracle_rows(at, rules.ORACLE, columns))
    by = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got.collect())
    assert by == collections.Counter((k, *brute_metrics(t)) for k, t in rows)
    known = [(k, t) for k, t in rows if k is not None and k != 900]
    joined = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op2_ngram_jaccard(spark, at).collect()}
    want = brute_components(list(dict(known).items()))
    assert {k: v for k, v in joined.items() if k in want} == want
    words = WORD.findall(rows[-1][1])
    assert joined[900] == (len({tuple(words[i : i + 5]) for i in range(len(words) - 4)}), 900)


def test_op7_and_op9_on_these_tables(spark, tables):
    at, rows = tables
    sampler = pieces.Sampler.of(public_tokenizers.path("piece_bpe_32k.model"))
    for r in queries.op7_sentencepiece(spark, at).collect():
        assert r.lossless and r.n_pieces == len(r.pieces) and r.pieces_crc32 == zlib.crc32(np.array(r.pieces, "<u4").tobytes())
        if r.doc_id == 404:
            raw, _ = sampler.decode(np.array(r.pieces, np.int32), np.array([0, len(r.pieces)]))
            assert raw.tobytes().decode() == dict(rows)[404]
    tokenizer = records.Encoder.of(public_tokenizers.path("word_bpe_49k.json")).tokenizer
    out = queries.op9_token_records(spark, at).orderBy("start").collect()
    assert [r.doc_id for r in out] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    ids = collections.Counter((k, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])) for k, t in rows)
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == collections.Counter({(k, len(x), zlib.crc32(np.array(x, "<u4").tobytes())): n for (k, x), n in ids.items()})
    starts = np.cumsum([0, *(r.n_tokens for r in out)])[:-1].tolist()
    assert [r.start for r in out] == starts


def test_long_rows_go_by_parts():
    sampler = pieces.Sampler.of(public_tokenizers.path("piece_bpe_32k.model"))
    rnd = random.Random(6)
    text = "  " + "".join(rnd.choice(["the ", "naïve ", "日本", "  ", "\n", "x" * 30, "▁", "\t", "of "]) for _ in range(60_000))
    whole = sampler.sample(pa.array([text]), np.array([7], np.uint64))[0]
    old = pieces.SLICE_BYTES
    try:
        pieces.SLICE_BYTES = 10_000
        parts, offsets = sampler.sample(pa.array([text]), np.array([7], np.uint64))
    finally:
        pieces.SLICE_BYTES = old
    assert np.array_equal(whole, parts) and sampler.decode(parts, offsets)[0].tobytes().decode() == text


def test_words_of_any_letters_equal_the_library():
    encoder = records.Encoder.of(public_tokenizers.path("word_bpe_49k.json"))
    rnd = random.Random(8)
    pool = ["a", "Z", "é", "ß", "İ", "ı", "ſ", "Σ", "К", "日", "ｆ", "！", ".", ",", "!", "?", "|", ":", "'s", "'LL", "\u0301", "\u0307", "\u0958", "\ufb1d", "\u212a", " ", "\u00a0", "\u200d", "\x00", "\t", "\x1c", "\u0085", "<|endoftext|>", "<|", "0", "½", "🙂", "각", "The"]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 14))) for _ in range(6000)] + [f"x{chr(c)}. {chr(c)}! y" for c in range(0x80, 0x3000)]
    ids, offsets = encoder.encode(pa.array(texts))
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == want


def test_records_of_one_id_lie_in_order_over_all_files(spark):
    rows = [(5, f"text {i} " + prose(i, 5)) for i in range(3000)] + [(4, "before"), (6, "after"), (None, "first")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        files = records.write_records(df, public_tokenizers.path("word_bpe_49k.json"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    digest = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    tokenizer = records.Encoder.of(public_tokenizers.path("word_bpe_49k.json")).tokenizer
    by_ids = {(k, tuple([*tokenizer.encode(t, add_special_tokens=False).ids, 2])): digest[t] for k, t in rows}
    found = [(k, by_ids[k, tuple(ids.tolist())]) for f in files.orderBy("part", "seq").collect() for some in records.read_file(f.path) for k, ids in some]
    assert len(found) == len(rows) and files.count() > 2
    assert found == sorted(found, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


@pytest.mark.parametrize("template", [chat.Template(open="<|{role}|>", close="<|end|>", loss=("user",)), chat.Template(open="aba{role}aab", close="aba"), chat.Template(open="{role}>", close="\n--\n")])
def test_any_template_round_trips(spark, template):
    rnd = random.Random(3)
    pool = [*" #<|>/\\:ab-\n", template.open, template.close, template.close.strip(), "<|end|>", "</turn>", "Assistant"]
    rows = [(c, t, rnd.choice(["user", "assistant", "User", "(user)", "a>b", ""]), "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 12)))) for c in range(60) for t in range(rnd.randint(1, 5))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segments = chat.format_chats(df, template)
    marks = [m.strip() for m in (template.name_begin, template.close) if m.strip()]
    for r in segments.where("part = 1").collect():
        plain = re.sub(r"\\[\s\S]", "\0", r.text)
        assert not any(m in plain for m in marks)
    for r in chat.read_back(segments, template).collect():
        own = [(role, text) for c, _, role, text in rows if c == r.conv_id]
        said = "".join(t for role, t in own if role in template.loss)
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())


def test_templates_that_cannot_be_read_back_are_errors():
    for wrong in ({"open": "x"}, {"open": "{role} "}, {"close": " \n"}, {"close": "\\end"}, {"names": {"a": "(b)"}}, {"names": {"a": "x", "b": "x"}}):
        with pytest.raises(ValueError):
            chat.Template(**wrong)


def test_urls_keep_columns_and_take_many_rules(spark, monkeypatch):
    rnd = random.Random(1)
    hosts = ["a.com", "b.a.com", "net", "x.net", "example.org", "org"]
    some = [(rnd.choice(["allow", "block"]), rnd.choice(hosts) + "/" + "".join(rnd.choice("xy/") for _ in range(rnd.randint(0, 4)))) for _ in range(200)] + [(None, "c.com/"), ("block", None)]
    table = [(i, f"http://{rnd.choice(['', 'www.'])}{rnd.choice(hosts)}/" + "".join(rnd.choice("xy/") for _ in range(rnd.randint(0, 6)))) for i in range(300)] + [(1000, None), (1001, "none")]
    df = spark.createDataFrame([(*r, "kept", "kept", "kept") for r in table], "page_id long, url string, host string, _judged string, _host string")
    monkeypatch.setattr(urls, "FILE_ENTRIES", 40)
    out = urls.filter_urls(df, spark.createDataFrame(some, "verdict string, rule string"), host="of").collect()
    kept = collections.defaultdict(set)
    for verdict, rule in some:
        if verdict and rule:
            kept[rule].add(verdict)
    assert len(out) == len(table)
    for r in out:
        assert (r.host, r["_judged"], r["_host"]) == ("kept", "kept", "kept")
        host, _, path = (r.url or "").partition("://")[2].partition("/") if "://" in (r.url or "") else ("", "", "")
        path = "/" + path if host else ""
        fits = [(len(x), len(x.partition("/")[0]), x) for x in kept if host and (host == x.partition("/")[0] or host.endswith("." + x.partition("/")[0])) and path.startswith("/" + x.partition("/")[2])]
        best = max(fits)[2] if fits else None
        assert (r.of, r.path, r.rule, r.verdict) == (host, path, best, "allow" if best is None else ("block" if "block" in kept[best] else "allow"))


def test_pipeline_equals_brute_force(spark, tables, tmp_path):
    """Every stage on its predecessor's rows, by other means: compression, sets of shingles, redaction, draws, decoding."""
    import corpus_pipeline
    from tests.llm.test_operators import brute_components

    at, rows = tables
    docs = [r for r in spark.read.parquet(f"{at}/documents.parquet").collect() if r.doc_id is not None and r.doc_id != 900 and r.doc_id != 403]
    spark.createDataFrame(docs, DOCS).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{at}/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in queries.op3_quality(spark, str(tmp_path)).collect()}
    docs = [r for r in docs if scores[r.doc_id]]
    comps = brute_components([(r.doc_id, r.text) for r in docs])
    docs = [r for r in docs if comps[r.doc_id][1] == r.doc_id]
    table = [(r.doc_id, None if r.text is None else secrets.redact(r.text), r.source) for r in docs]
    assert any("<assign>" in (t or "") for _, t, _ in table)
    counts = collections.Counter(s for _, _, s in table)
    raw = {s: n**mixing.TEMPERATURE for s, n in counts.items()}
    want = collections.Counter()
    for k, t, s in table:
        rate = raw[s] / sum(raw.values()) * len(table) / counts[s]
        own = "null" if t is None else hashlib.md5(t.encode()).hexdigest()
        u = int(hashlib.md5(f"{mixing.SEED}:{k}:{own}:1".encode()).hexdigest()[:13], 16) / 2**52
        n, below = 0, math.exp(-rate)
        term = below
        while below <= u:
            n += 1
            term *= rate / n
            below += term
        want[k, t, s] += n
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert collections.Counter((r.doc_id, r.text, r.source) for r in out) == +want
    sampler = pieces.Sampler.of(public_tokenizers.path("piece_bpe_32k.model"))
    for r in out:
        assert r.n_chars == (len(r.text) if r.text is not None else None)
        assert sampler.decode(np.array(r.pieces, np.int32), np.array([0, len(r.pieces)]))[0].tobytes().decode() == (r.text or "")
        assert r.pieces == sampler.sample(pa.array([r.text or ""]), pieces.row_keys(pa.array([r.doc_id])))[0].tolist()
