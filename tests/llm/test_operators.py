"""The training-data operators on small tables: against brute force, by round trips, and with odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from strandline.llm import chat, jaccard, media, mixing, pieces, quality, records, rules, secrets, urls

DOCS = "doc_id long, text string, source string, secrets string, score string, pieces string, key string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "Ünï ▁ \x00 日本 🙂 <|endoftext|> it's"), (6, "word " * 5000), (7, "x" * 70000)]


def docs(spark, rows=None):
    return spark.createDataFrame([(k, t, None if k is None else f"s{k % 2}", "a", "b", "c", "d") for k, t in (ODD if rows is None else rows)], DOCS)


def prose(seed, n=120):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(["the", "an", "re", "on", "st", "li"]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


# --- secrets


def test_secret_kinds_and_spans():
    key = "AKIA" + "B1" * 8
    text = f'x password = "abc123" {key} {"0a" * 13} token=abc Secret: short5 y'
    got = secrets.scan(text)
    assert [k for k, *_ in got] == ["assign", "access", "hex", "assign"]
    assert text[got[1][1] : got[1][2]] == key
    assert secrets.scan("paſsword=abcdef1") == []  # letters of other alphabets are no keywords


def test_entropy_windows_equal_direct_counts():
    rnd = random.Random(3)
    for _ in range(30):
        text = "".join(rnd.choice("abcdef0123456789XYZ") for _ in range(rnd.randint(10, 60)))
        covered = set()
        for i in range(len(text) - 19):
            counts = collections.Counter(text[i : i + 20]).values()
            if -sum(c / 20 * math.log2(c / 20) for c in counts) >= 3.5 - 1e-9:
                covered |= set(range(i, i + 20))
        assert {i for a, b in secrets.windows(text, 3.5) for i in range(a, b)} == covered


def test_entropy_adds_and_allow_list_suppresses():
    assert [k for k, *_ in secrets.scan("k Zx9Qp2Lm8Vb4Nc7Ty1Rw5K z")] == ["entropy_base64"]
    assert secrets.scan("id 123e4567-e89b-12d3-a456-426614174000 end") == []
    assert secrets.scan("internationalization-and-localization of words") == []


def test_entropy_finds_random_keys_of_any_alphabet_and_no_words():
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    rnd = random.Random(5)
    for letters in (upper, lower, upper + lower, upper + "234567", lower + digits, upper + digits, upper + lower + digits):
        for n, share in ((20, 0.9), (32, 0.97)):
            found = sum(bool(secrets.scan("key " + "".join(rnd.choice(letters) for _ in range(n)))) for _ in range(200))
            assert found >= share * 200, (letters, n, found)
    for words in ("src/main/resources/application_properties", "RegistryPostProcessorFactoryBean", "release-notes-2024-05-for-customers", "donaudampfschifffahrtsgesellschaft"):
        assert secrets.scan(words) == [], words
    assert secrets.scan("a1B" + "x" * 60) == []


def test_allow_list_suppresses_its_own_part_only():
    key = "Zx9Qp2Lm8Vb4Nc7Ty1Rw5K"
    digest = "uU0nuZNNPgilLlLX2n2r+sSE7+N6U4DukIj3rOLvzek="
    for text in (f"backups/samples/{key}", f"{key}/0123456789", f"id=example_{key}", f"sha256-{digest}/{key}", f"md5={key}{key}", f"123e4567-e89b-12d3-a456-426614174000/{key}"):
        covered = {i for _, a, b in secrets.scan(text) for i in range(a, b)}
        assert covered >= set(range(text.index(key), text.index(key) + len(key))), text
    for text in (f"sha256-{digest}", f"{key}example", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"):
        assert secrets.scan(text) == [], text


def test_secret_report_odd_rows(spark):
    out = secrets.secrets_report(docs(spark)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(out) == len(ODD) and all(r.base_sha256 == empty and r.spans == "" for r in out)
    rows = [(1, "a password=abcdef77 b"), (2, None)]
    assert [r.text for r in secrets.redact_secrets(docs(spark, rows)).orderBy("doc_id").collect()] == ["a <assign> b", None]
    assert secrets.secrets_report(docs(spark, [])).count() == 0


# --- joins


def brute_components(rows):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(fold))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    least = {c: min(rows[i][0] for i in range(len(rows)) if comp[i] == c) for c in set(comp)}
    return {rows[i][0]: (len(sets[i]), least[comp[i]]) for i in range(len(rows))}


def near_copies():
    rnd = random.Random(5)
    rows = []
    for g in range(4):
        base = prose(g, 90).split()
        for _ in range(25):
            own = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 4, 5])):
                own[rnd.randrange(len(own))] = f"w{rnd.randrange(10**6)}"
            rows.append(" ".join(own).upper() if rnd.random() < 0.2 else " ".join(own))
    passage = prose(99, 60)
    rows += [passage + " " + prose(1000 + i, rnd.randint(3, 40)) for i in range(40)]
    rows += ["a b c", "A b  c", "a b", "", " "]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("rounds", [0, 2])
def test_components_equal_brute_force(spark, monkeypatch, rounds):
    rows = near_copies()
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 7)  # many tiles
    plain = jaccard.link_components
    monkeypatch.setattr(jaccard, "link_components", lambda sets, scratch: plain(sets, scratch, rounds))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs(spark, rows)).collect()}
    assert got == brute_components(rows)


@pytest.mark.parametrize("fan", [1, 1000])
def test_ranges_units_and_levels_change_no_result(spark, monkeypatch, fan):
    """Many small units, ranges from one to many, with merged exchanges in between; empty rows fill units too."""
    rows = near_copies()
    rows += [(1000 + i, "") for i in range(400)]
    for name, value in (("UNIT_SHINGLES", 300), ("RANGE_BYTES", 3000), ("FAN", fan)):
        monkeypatch.setattr(jaccard, name, value)
    got = jaccard.jaccard_components(docs(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows[:-400]) | {k: (0, k) for k, _ in rows[-400:]} and len(got) == len(rows)


def test_long_texts_are_hashed_by_parts():
    raw = np.frombuffer(("  " + prose(3, 5000) + " x\n" + "y" * 3000 + "  ").encode(), np.uint8)
    whole = jaccard.word_hashes(raw, np.array([0, len(raw)]))
    parts = jaccard.text_word_hashes(raw, np.array([0, len(raw)]), 100)
    assert np.array_equal(whole[0], parts[0]) and whole[1].tolist() == parts[1].tolist()


def test_scratch_tables_go(spark):
    from strandline.llm.shared import Scratch

    scratch = Scratch(spark, "test")
    table = scratch.cut(spark.range(5))
    assert table.count() == 5
    scratch.close()
    with pytest.raises(Exception):
        spark.read.parquet(scratch.folder)


def test_components_odd_rows_and_kept_rows(spark):
    out = jaccard.jaccard_components(docs(spark)).collect()
    assert len(out) == len(ODD) and all(r.component_id == r.doc_id for r in out)
    assert jaccard.jaccard_components(docs(spark, [])).count() == 0
    text = prose(1)
    kept = jaccard.keep_one_of_each(docs(spark, [(8, text), (3, text + " more"), (9, prose(2)), (None, "")]))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 9, None] and kept.columns == docs(spark).columns


def test_one_row_stays_where_ids_are_null_or_repeated(spark):
    one, two, three = prose(1), prose(2), prose(3)
    rows = [(4, one), (4, one), (None, two), (None, two), (None, two + " more"), (None, None), (6, three), (5, three), (6, prose(4))]
    kept = jaccard.keep_one_of_each(docs(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.text) for r in kept if r.text not in (two, two + " more")) == collections.Counter([(4, one), (None, None), (5, three), (6, prose(4))])
    assert len(kept) == 5


# --- quality classifier


def test_fit_takes_whole_rows_within_its_bytes(spark, monkeypatch):
    rows = [(i, prose(i, 1500)) for i in range(30)] + [(100 + i, prose(i, 1500).upper()) for i in range(30)] + [(200 + i, prose(i, 20000)) for i in range(3)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "_dictionary", lambda samples: seen.extend(samples) or b"\n".join(samples))
    quality.fit(docs(spark, rows), labels)
    assert max(map(len, seen)) > 6000 and {s.decode() for s in seen} <= {t for _, t in rows}
    seen.clear()
    quality.fit(docs(spark, rows), labels, most_bytes=70_000)
    assert seen and sum(map(len, seen)) <= 140_000 and {s.decode() for s in seen} <= {t for _, t in rows[:-3]}


def test_classifier_learns_and_holds_out(spark):
    good = [(i, prose(i, 150)) for i in range(60)]
    bad = [(100 + i, " | ".join(w + "!!" for w in prose(500 + i, 100).upper().split())) for i in range(60)]
    rows = good + bad + [(None, None), (900, ""), (901, "x" * 100_000)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    out = {r.doc_id: r for r in quality.classify(docs(spark, rows), labels).collect()}
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.values())
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in out.items() if k is not None)
    held = [k for k, r in out.items() if r.held_out and k is not None and k < 200]
    assert held and all(out[k].predicted == int(k < 100) for k in held)
    none = quality.classify(docs(spark), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


# --- mixing


def test_poisson_rates_and_repeats(spark):
    rows = [(i, f"t{i}") for i in range(4000)] + [(None, "n")]
    df = docs(spark, rows)
    first = mixing.mix_sources(df, weights={"s0": 3.0, "s1": 1.0}).collect()
    counts = collections.Counter(r.source for r in first)
    assert abs(counts["s0"] - 3000) < 200 and abs(counts["s1"] - 1000) < 120 and None not in counts
    again = mixing.mix_sources(df.repartition(7), weights={"s0": 3.0, "s1": 1.0}).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    per = collections.Counter(collections.Counter(r.doc_id for r in first if r.source == "s0").values())
    assert abs(per[1] / 2000 - 1.5 * math.exp(-1.5)) < 0.04 and abs(per[2] / 2000 - 1.125 * math.exp(-1.5)) < 0.04
    assert mixing.mix_sources(docs(spark, [])).count() == 0


def test_many_sources_take_the_salted_join(spark, monkeypatch):
    df = docs(spark, [(i, "t") for i in range(300)])
    want = sorted((r.doc_id, r.copy) for r in mixing.mix_sources(df).collect())
    monkeypatch.setattr(mixing, "MOST_TERMS", 1)
    assert sorted((r.doc_id, r.copy) for r in mixing.mix_sources(df).collect()) == want


# --- media


def test_media_round_trip(spark):
    folder = media.write_archives(docs(spark))
    out = media.describe(media.read_archives(spark, folder, rangeBytes=500)).collect()
    want = [(str(k), media.padded((t or "").encode())) for k, t in ODD]
    assert sorted((str(r.doc_id), r.payload_sha256) for r in out) == sorted((k, hashlib.sha256(p).hexdigest()) for k, p in want)
    by = {r.payload_sha256: r for r in out}
    for k, p in want:
        r = by[hashlib.sha256(p).hexdigest()]
        assert (r.payload_bytes, r.tail_crc32) == (len(p), zlib.crc32(p[-16:])) and len(p) % 192 == 0
        assert np.array_equal(media.from_png(media.to_png(p)).tobytes(), p)
    assert media.read_archives(spark, media.write_archives(docs(spark, []))).count() == 0


def test_members_are_retried_alone(tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for i in range(5):
            z.writestr(f"{i}_1_{i}.png", b"m" * (100 + i))
    raw = bytearray((tmp_path / "a.zip").read_bytes())
    raw[raw.index(b"m" * 102) + 5] = 0  # one damaged member
    (tmp_path / "a.zip").write_bytes(raw)
    reader = media.ArchiveReader({"path": f"file://{tmp_path}", "retries": "1", "onError": "row", "rangeBytes": "100"})
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert len(rows) == 5 and [r["member"][0] for r in rows if r["error"]] == ["2"]
    with pytest.raises(ValueError):
        list(media.ArchiveReader({"path": f"file://{tmp_path}", "retries": "0"}).read(media._Range("a.zip", 0, 10**6)))


# --- rules


def brute_metrics(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_metrics_equal_brute_force(spark):
    rnd = random.Random(2)
    rows = ODD + [(50 + i, "".join(rnd.choice(["a", "b", " ", "\n", "#", "é ", "c d "]) for _ in range(rnd.randint(0, 200)))) for i in range(60)]
    got = collections.Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rules.judge(docs(spark, rows)).collect())
    assert got == collections.Counter(brute_metrics(t) for _, t in rows)
    assert rules.judge(docs(spark, [])).count() == 0


def test_rule_order_changes_no_verdict(spark):
    df = rules.with_metrics(docs(spark, [(i, prose(i)) for i in range(10)] + ODD))
    orders = [rules.RULES, rules.RULES[::-1]]
    one, two = (df.select(rules.cascade(list(o)).alias("k")).collect() for o in orders)
    assert one == two
    assert all({"rule", "cost", "rejects"} <= set(x) for x in rules.order_rules(docs(spark)))


def test_rule_order_follows_cost_and_rejections(spark):
    df = docs(spark, [(i, prose(i, 400)) for i in range(40)])
    slow = "length(" + "regexp_replace(reverse(" * 6 + "_text" + "), '[aeiou]+', 'xy')" * 6 + ")"
    cheap, dear = rules.Rule("cheap", "n_words > 0"), rules.Rule("dear", f"{slow} > 0")
    rare, never = rules.Rule("rare", "pmod(xxhash64(_text), 20) = 0"), rules.Rule("never", "n_words < 0")
    found = [x["rule"].name for x in rules.order_rules(df, (never, dear, rare, cheap))]
    assert found.index("cheap") < found.index("dear") and found[-1] == "never" and found[0] == "cheap"
    every = rules.order_rules(df, (dear, rules.Rule("dear_never", f"{slow} < 0")))
    assert [x["rejects"] for x in every] == [1.0, 0.0] and every[0]["cost"] > 1e-6


# --- pieces


@pytest.fixture(scope="module")
def sampler():
    return pieces.Sampler.of(public_tokenizers.path("piece_bpe_32k.model"))


def test_draws_next_to_one_stay_at_their_node(sampler, monkeypatch):
    text = pa.array(["some words of a text, naïve 日本 too"])
    monkeypatch.setattr(pieces, "mix", lambda x: np.full_like(x, 2**64 - 1))
    ids, offsets = sampler.sample(text, np.zeros(1, np.uint64))
    assert sampler.decode(ids, offsets)[0].tobytes().decode() == text[0].as_py()


def test_pieces_are_lossless_and_repeatable(spark, sampler):
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = ODD + [(20, "  two  spaces\n\n lines \r\n\t"), (21, " "), (22, "▁"), (23, "a▁ b")]
    out = pieces.encode_and_check(docs(spark, rows), model).collect()
    assert len(out) == len(rows) and all(r.lossless and r.n_pieces == len(r.pieces) for r in out)
    df = pieces.encode_documents(docs(spark, rows).repartition(5), model)
    assert sorted((str(r.doc_id), r.pieces) for r in df.collect()) == sorted((str(r.doc_id), r.pieces) for r in out)
    decoded = df.withColumn("back", pieces.decode_pieces(df.pieces, model)).collect()
    assert all(r.back == (r.text or "") for r in decoded)
    assert pieces.encode_documents(docs(spark, []), model).count() == 0


def test_segmentations_follow_their_weights(sampler):
    text, n = " there".encode(), 30_000
    spelled = {sampler.spelled[a : a + s].tobytes(): i for i, (a, s) in enumerate(zip(sampler.firsts, sampler.sizes)) if s and i not in set(sampler.byte_id.tolist())}
    found = {}

    def go(at, ids, log):
        if at == len(text):
            found[tuple(ids)] = math.exp(log)
        for end in range(at + 1, len(text) + 1):
            i = spelled.get(text[at:end])
            if i is not None:
                go(end, [*ids, i], log + sampler.log[i])

    go(0, [], 0.0)
    ids, offsets = sampler.sample(pa.array(["there"] * n), np.arange(n).astype(np.uint64))
    got = collections.Counter(tuple(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:]))
    total = sum(found.values())
    assert set(got) <= set(found) and all(abs(got[k] / n - p / total) < 0.015 for k, p in found.items())


# --- chat


def test_chat_round_trip(spark):
    nasty = ["\\### Assistant: </turn> ok", None, "", "\\", "\\\\", " </turn>\n### User: x", "### ", "a: b\n", "é🙂" * 3000]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(["system", "user", "assistant", "user", "assistant", "tool", "assistant", "user", "assistant"], nasty))]
    rows += [(2, 0, "assistant", "early"), (None, 0, None, "no role"), (3, 0, "user", "x"), (3, 0, "user", "x"), (4, 0, "we:ird\\c", "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("loss", F_lit())
    out = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    assert set(out) == {1, 2, 3, 4, None}
    for conv, r in out.items():
        own = [(role or "", text or "") for c, _, role, text in rows if c == conv]
        said = "".join(t for role, t in own if role == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert out[1].valid and not out[2].valid and not out[3].valid and not out[4].valid
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0


def F_lit():
    from pyspark.sql import functions as F

    return F.lit("clash")


# --- records


def test_crc32c_known_values():
    raw = np.frombuffer(b"123456789" + bytes(32), np.uint8)
    assert [hex(x) for x in records.crc32c_many(raw, np.array([0, 9]), np.array([9, 41]))] == ["0xe3069283", "0x8a9136aa"]


def test_records_round_trip(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = ODD + [(30 + i, prose(i) + ", The END. don't é́ " + str(i)) for i in range(50)]
    files = records.write_records(docs(spark, rows), path)
    out = records.read_records(files).orderBy("start").collect()
    tokenizer = records.Encoder.of(path).tokenizer
    ordered = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    start = 0
    for r, (k, t) in zip(out, ordered, strict=True):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    first = files.orderBy("part", "seq").first()
    every = [x for some in records.read_file(first.path, 64) for x in some]
    key, ids = records.read_at(first.path, len(every) - 1)
    assert key == every[-1][0] and ids.tolist() == every[-1][1].tolist()
    assert records.read_records(records.write_records(docs(spark, []), path)).count() == 0


def test_damaged_record_is_found(tmp_path):
    data, _ = records.frames([1], np.arange(50, dtype=np.uint32), np.array([0, 50]), 2)
    bad = bytearray(data)
    bad[40] ^= 1
    (tmp_path / "x.rec").write_bytes(bad)
    with pytest.raises(ValueError):
        list(records.read_file(str(tmp_path / "x.rec")))


# --- urls


def test_rules_longest_wins(spark):
    table = ["http://a.Example.NET/en/x", "http://example.net/fr", "https://b.example.com/de/1?x=/de/", "x.org/fr/", None, "http://y.org/fr/?q", "http://a.net", "http://net/", "http://knet/", "a://b://c.net/"]
    df = spark.createDataFrame(list(enumerate(table)), "page_id long, url string").withColumn("rule", F_lit())
    got = [(r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(df).orderBy("page_id").collect()]
    assert got == [
        ("a.example.net", "/en/x", "example.net/en/", "allow"), ("example.net", "/fr", "net/", "block"), ("b.example.com", "/de/1", "example.com/de/", "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("y.org", "/fr/", "org/fr/", "allow"), ("a.net", "", None, "allow"), ("net", "/", "net/", "block"), ("knet", "/", None, "allow"), ("b:", "//c.net/", None, "allow"),
    ]
    assert {r.verdict for r in urls.filter_urls(df, rules=()).collect()} == {"allow"}
    assert urls.filter_urls(df.limit(0)).count() == 0


def test_equal_digests_do_not_decide(spark, monkeypatch):
    def same(strings):
        return np.full(len(strings), 7, np.uint64)  # every digest collides

    plain = urls.write_index
    monkeypatch.setattr(urls, "digests", same)
    files = plain(spark, [("block", "a.b/"), ("allow", "a.b/c/")])
    index = urls.Index(files)
    for part in index.parts:  # the task's process has its own digests
        part.keys = np.full(len(part.keys), 7, np.uint64)
    assert index.judge(pa.array(["x.a.b", "a.b", "q"]), pa.array(["/c/d", "/z", "/"])) == ["allow a.b/c/", "block a.b/", None]


# --- pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    good = [(i, prose(i, 150)) for i in range(60)]
    bad = [(100 + i, " | ".join(w + "!!" for w in prose(500 + i, 100).upper().split())) for i in range(60)]
    rows = good + bad + [(300, good[0][1] + " end"), (301, good[1][1] + " password=abcdef99")]
    table = spark.createDataFrame([(k, t, "en", f"s{k % 3}", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    df = table
    for name, stage in corpus_pipeline.STAGES:
        before, df = df, stage(spark, df, str(tmp_path))
        if name != "SentencePiece encoding and decoding":
            assert df.columns == table.columns
        if name == "quality classifier":
            assert {r.doc_id for r in df.collect()} == {k for k, _ in rows if not 100 <= k < 200}
        if name == "n-gram Jaccard join":
            assert {r.doc_id for r in df.collect()} == set(range(60))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == df.count() > 0


def test_operators_keep_columns_of_any_name(spark, tmp_path):
    """Extra columns may bear the names that operators and stages use inside or add; they pass through with their values."""
    import corpus_pipeline

    extra = "_gone _score _source _cdf _deal _salt _u _n cdf copy Shuffle_Key rate comp n key _text _key _label is_first n_words".split()
    rows = [(1, prose(1), "a"), (2, prose(1) + " end", "a"), (3, prose(3), None), (None, None, "a"), (4, "", "b"), (5, "", "b")]
    table = spark.createDataFrame([(k, t, "en", s, 0, *extra) for k, t, s in rows], ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *(f"{x} string" for x in extra)]))
    spark.createDataFrame([(i, 1, 0) for i in range(1, 6)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, table, str(tmp_path))
        assert [c for c in out.columns if c != "pieces"] == table.columns, name
        kept = out.collect()
        assert kept and all(r[x] == x for r in kept for x in extra), name
        assert stage(spark, table.limit(0), str(tmp_path)).count() == 0, name
    for report in (secrets.secrets_report, jaccard.jaccard_components, rules.judge):
        assert report(table).count() == len(rows)
    mixed = mixing.mix_sources(table).collect()
    assert all(r["copy"] >= 1 and r["_n"] == "_n" for r in mixed)
