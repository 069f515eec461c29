"""Web-corpus operators: tables of cases, independent Python oracles, and invariants of the page records."""

import random
import re
import zipfile
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from strandline.functions import text as T
from strandline.functions import urls as U
from strandline.operators import captures as C
from strandline.operators import reclassify as R
from strandline.operators import roster as O
from strandline.operators import snapshots as S
from strandline.sources import tables
from strandline.sources.held import hold
from strandline.sources.html import page_store, parse_page
from strandline.streaming.resume import scrape, scrape_stream
from strandline.values import ARCHIVE, BIOGRAPHY_PREFIXES, FOOTER, NOISE_SEGMENTS, PAGE_TYPES, TOOLBAR_END

AT = ARCHIVE + "20200601000000/"


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i long, v {kind}")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def kind(url):
    m = re.match(r"https?://web\.archive\.org/web/\d+[^/]*/(.+)", url)
    own = m.group(1) if m else url
    try:
        path = urlparse(own if "://" in own else "http://" + own).path
    except ValueError:
        return "other"
    parts = [p for p in path.lower().split("/") if p and p not in NOISE_SEGMENTS]
    if not parts or parts[0] == "home" or re.match(r"^index\.\w+$", parts[0]):
        return "homepage"
    for name, words in PAGE_TYPES.items():
        if parts[0] in words:
            return name
    return "biography" if parts[0].startswith(tuple(BIOGRAPHY_PREFIXES)) else "other"


def test_page_type_equals_oracle(spark):
    rnd = random.Random(1)
    words = ["issues", "About", "meet-ted", "meet_x", "index.php", "index.html", "public", "home", "news", "donate", "x", "", "district", "endorsements", "a b", "%zz"]
    urls = ["http://a.com", "a.com/", "https://[bad/issues", AT + "http://a.com/", ARCHIVE + "2020id_/http://a.com/News/x"]
    for _ in range(300):
        urls.append(rnd.choice(["", AT, ARCHIVE + "2020im_/"]) + rnd.choice(["http://", "https://", ""]) + "a.com/" + "/".join(rnd.choices(words, k=rnd.randint(0, 3))) + rnd.choice(["", "/", "?issues=1", "#news", ";x=1"]))
    assert column(spark, urls, U.page_type) == [kind(u) for u in urls]


def test_url_functions(spark):
    assert column(spark, ["HTTPS://www.A.com//", "http://a.com/www."], U.dedup_url) == ["https://a.com", "http://a.com/www."]
    assert column(spark, ["", None, " A.com ", "http://https://b.com", "httpfoo.com"], U.committee_url) == ["", "", "https://a.com", "https://b.com", "httpfoo.com"]
    assert column(spark, ["https://http://x/", "http://www.x//"], U.url_pattern) == ["x", "www.x"]
    assert column(spark, [AT + "http://a.com/p", AT + "http:/a.com/p", AT + "a.com/p", "http://a/b"], U.archived_domain) == ["a.com", "a.com", "a.com", None]
    assert column(spark, ["http://a/x.PDF", "http://a/x.pdf?y=1", "http://a/x.html"], U.is_binary) == [True, False, False]


def test_links_and_frames_resolve(spark):
    base = F.lit(AT + "http://www.a.com/dir/p.html")
    links = ["#x", "", "mailto:a@b", "javascript:1", "http://twitter.com/a", "http://b.com/x", "https://a.com/y", "z.html", "/r", "//o.com/q", AT + "http://a.com/k", AT + "http://b.com/k"]
    got = column(spark, links, lambda c: U.resolve_link(c, base, ["twitter.com"]))
    assert got == [None] * 6 + [AT + "https://a.com/y", AT + "http://www.a.com/dir/z.html", AT + "http://www.a.com/r", AT + "http://o.com/q", AT + "http://a.com/k", None]
    frames = ["top.html", "/nav", "http://web.archive.org/web/2020/http://a.com/f", "/web/2020/http://a.com/g", "web/2020/http://a.com/g"]
    assert column(spark, frames, lambda c: U.resolve_frame(c, base)) == [AT + "http://www.a.com/dir/top.html", AT + "http://www.a.com/nav", "https://web.archive.org/web/2020/http://a.com/f", "https://web.archive.org/web/2020/http://a.com/g", "https://web.archive.org/web/2020/http://a.com/g"]


def dedup(segments, most=2):
    kept = [s for s in segments if len(s) < 5 or segments.count(s) <= most]
    return [s for i, s in enumerate(kept) if i == 0 or s != kept[i - 1]]


def test_segments_equal_oracle(spark):
    rnd = random.Random(4)
    arrays = [[], ["Home", "About us", "Home", "About us", "Home", "About us", "line"], *([rnd.choice(["and", "Home", "About Us", "a line", "x" * 9]) for _ in range(rnd.randint(0, 14))] for _ in range(150))]
    assert column(spark, arrays, T.dedup_segments, "array<string>") == [dedup(a) for a in arrays]


def test_names_and_words(spark):
    raw = ['CRUZ, RAFAEL EDWARD "TED"', "O'ROURKE, BETO", "MCDONALD-SMITH, d2x  y", "SMITH,", "plain  name", None, "", "ÉLAN, ÖZ 'Al' B"]
    assert column(spark, raw, T.clean_name) == ["Rafael Edward Cruz", "Beto O'Rourke", "D2X Y Mcdonald-Smith", " Smith", "Plain Name", "", "", "Öz B Élan"]
    assert column(spark, raw[:2], T.nickname) == ["Ted", None]
    assert column(spark, ["oh", "ZZ", None], T.state_name) == ["Ohio", None, None]
    texts = ["a b c\x1cd", "", "a#+#b", "  x\n"]
    assert column(spark, texts, T.n_words) == [len(t.split()) for t in texts]
    assert column(spark, [" Issues\n", "it is news, action", "?", None], T.parse_label) == ["issues", "news", "other", "other"]


def rows(spark, data):
    return spark.createDataFrame([(i, s, t, u) for i, (s, t, u) in enumerate(data)], "ordinal long, site string, timestamp string, original_url string")


@pytest.mark.parametrize("months,kept", [(3, ["03", "06", "09", "12"]), (1, [f"{m:02d}" for m in range(1, 13)]), (12, ["12"])])
def test_buckets_keep_the_latest(spark, months, kept):
    df = rows(spark, [("s", f"2022{m:02d}{d}000000", u) for m in range(1, 13) for d in ("01", "15") for u in ("http://www.a.com/", "http://a.com")])
    out = C.bucket_dedup(df, months).orderBy("timestamp").collect()
    assert [r.timestamp[4:6] for r in out] == kept and all(r.timestamp[6:8] == "15" and r.original_url == "http://www.a.com/" for r in out)


def test_stratified_sample(spark):
    df = rows(spark, [("s", f"2022{m:02d}{min(d + 1, 28):02d}000000", "u") for m in range(1, 13) for d in range(50)] + [("t", "20220101000000", "u")] * 50)
    out = C.stratified_sample(df, 200).collect()
    months = [r.timestamp[:6] for r in out if r.site == "s"]
    assert len(months) == 200 and len(set(months)) == 12 and max(map(months.count, months)) <= 20
    assert sum(r.site == "t" for r in out) == 50
    assert [tuple(r) for r in C.at_limit(df, 51).collect()] == [("u", 650)]


def test_capture_scan_and_filter(spark, tmp_path):
    (tmp_path / "index").write_text("20200101000000 http://a 200 text/html\nbad line\n20200102000000 http://a 404 text/html\n20210101000000 http://a 200 text/html\n")
    out = C.select_captures(tables.captures(spark, str(tmp_path / "index")), *C.election_year(F.lit(2020))).collect()
    assert [r.wayback_url for r in out] == [ARCHIVE + "20200101000000/http://a"]


def test_candidate_scan_and_roster(spark, tmp_path):
    line = lambda name, party, office, pcc, extra="": "|".join(["H1", name, party, "2020", "OH", office, "01", "I", "C", pcc, "s", "", "c", "OH", "1"]) + extra
    (tmp_path / "cn.txt").write_bytes("\n".join([line("DOE, JANÉ", "DEM", "H", " C1"), line("DOE, JANÉ", "REP", "H", "C2"), line("ROE, R", "IND", "H", ""), line("POE, P", "DFL", "H", ""), line("X, Y", "DEM", "H", "", "|more|fields"), "H2|SHORT, S|REP|2020|OH|H"]).encode("latin-1"))
    roster = O.build_roster(tables.candidates(spark, str(tmp_path / "cn.txt")), 2020, "house")
    assert [(r.candidate, r.party, r.district) for r in roster.orderBy("ordinal").collect()] == [("Jané Doe", "D", "01"), ("P Poe", "D", "01"), ("S Short", "R", "")]
    with pytest.raises(ValueError):
        O.build_roster(roster, 2020, "governor")
    committees = spark.createDataFrame([("C1 ", "Doe.org")], "pcc string, website string")
    websites = spark.createDataFrame([(1, "http://poe.com", 0), (2, "http://no.com", 1)], "qid long, website string, ord long")
    labels = spark.createDataFrame([(1, "Pat P Poe"), (3, "x")], "qid long, name string")
    filled = O.fill_urls(roster.withColumn("roster_id", F.col("ordinal")), [O.CommitteeSource(committees), O.NameSource(websites, labels)])
    assert [(r.candidate, r.website_url) for r in O.finish_roster(filled).orderBy("candidate").collect()] == [("Jané Doe", "https://doe.org"), ("P Poe", "http://poe.com")]
    assert O.missing(filled).first().n_missing == 1
    counts = O.source_counts(filled, [O.CommitteeSource(None), O.NameSource(None, None)])
    assert [tuple(r) for r in counts.orderBy("place").collect()] == [(0, "committees", 3, 1, 2), (1, "names", 2, 1, 1)]


def people(spark):
    rows = [(i, n, "OH", "01", 2020, f"C{i}", "") for i, n in enumerate(["Ann Lee", "Bob Roe", "Cy Poe", "Di Fox"])]
    return spark.createDataFrame(rows, "roster_id long, candidate string, state string, district string, year int, cand_pcc string, website_url string")


def test_cached_sources_are_not_asked_again(spark):
    committees = spark.createDataFrame([(f"C{i}", f"c{i}.org") for i in range(3)], "pcc string, website string")
    websites = spark.createDataFrame([(1, "http://ann.com", 0), (2, "", 1), (2, "http://fox.com", 2), (3, "http://x.com", 3)], "qid long, website string, ord long")
    labels = spark.createDataFrame([(1, "Ann Lee"), (2, "Di Fox"), (3, None)], "qid long, name string")
    cache = spark.createDataFrame([("Ann Lee", "OH", "2020", ""), ("Bob Roe", "OH", "2020", "http://known.org")], "candidate string, state string, year string, url string")
    cached, names = O.CachedSource(O.CommitteeSource(committees), cache), O.NameSource(websites, labels)

    class Broken:
        name = "broken"
        is_available = staticmethod(lambda: True)

        def urls(self, roster):
            raise RuntimeError("no service")

    class Fails(Broken):
        def urls(self, roster):
            return roster.select("roster_id", F.raise_error(F.lit("no service")).cast("string").alias("url"))

    want = [("Ann Lee", "http://ann.com", "names"), ("Bob Roe", "http://known.org", "committees"), ("Cy Poe", "https://c2.org", "committees"), ("Di Fox", "http://fox.com", "names")]
    got = lambda filled: [(r.candidate, r.website_url, r.url_source) for r in filled.orderBy("roster_id").collect()]
    assert got(O.fill_urls(people(spark), [Broken(), cached, names])) == want
    told = []
    filled = O.fill_urls(people(spark), [Fails(), cached, names], hold, lambda s, asked, found: told.append((s.name, asked.count(), s.new_entries(asked, found, 5.0).collect() if s is cached else None)))
    assert got(filled) == want
    assert [(n, k) for n, k, _ in told] == [("committees", 4), ("names", 2)]
    assert {(r.candidate, r.url, r.cached_at) for r in told[0][2]} == {("Cy Poe", "https://c2.org", "5.0"), ("Di Fox", "", "5.0")}


def test_json_answers_and_zipped_candidates(spark, tmp_path):
    bodies = ['{"results": [{"website": " a.org "}, {"website": "b.org"}]}', '{"results": []}', "{}", "not json", '{"results": [{"website": null}]}', None]
    answers = spark.createDataFrame(list(enumerate(bodies)), "pcc string, body string".replace("pcc string", "pcc long"))
    assert [r.website for r in O.committees_from_json(answers).orderBy("pcc").collect()] == ["a.org", "", "", "", "", ""]
    lines = ["|".join(["H1", f"DOE, JANÉ {i}", "DEM", "2020", "OH", "H", "01", "I", "C", "C1", "s", "", "c", "OH", "1"]) for i in range(50)]
    with zipfile.ZipFile(tmp_path / "cn20.zip", "w") as z:
        z.writestr("readme.md", "no")
        z.writestr("cn.txt", "\r\n".join(lines).encode("latin-1"))
        z.writestr("other.txt", "H2|X")
    assert tables.first_existing(spark, [f"{tmp_path}/cn2020.zip", f"{tmp_path}/cn20.zip"]).endswith("cn20.zip")
    for _ in range(2):  # the second time from the kept lines
        raw = tables.candidates(spark, f"{tmp_path}/cn20.zip", f"{tmp_path}/kept")
        assert [r.cand_name for r in raw.orderBy("ordinal").collect()] == [f"DOE, JANÉ {i}" for i in range(50)]
        (tmp_path / "cn20.zip").exists() and (tmp_path / "cn20.zip").write_bytes(b"")


def test_scan_order_is_that_of_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for f in ("b", "a"):
        (tmp_path / "in" / f).write_text("".join(f"20200101000000 http://{f}{i:05d} 200 text/html\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = [r.original_url for r in tables.captures(spark, f"{tmp_path}/in").orderBy("ordinal").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"http://{f}{i:05d}" for f in "ab" for i in range(3000)]
    assert [r.ordinal for r in C.in_order(rows(spark, [("s", "2", "u"), ("s", "1", "u")])).collect()] == [1, 0]


def test_cache_keeps_last_fresh_entry(spark):
    cache = spark.createDataFrame([("a", "OH", "2020", "u1", "100", 0), ("a", "OH", "2020", "", "90", 1), ("a", "OH", "2020", "old", "-9999999999", 2)], "candidate string, state string, year string, url string, cached_at string, ordinal long")
    assert [r.url for r in tables.url_cache(cache, 200.0).collect()] == [""]
    assert [r.url for r in tables.url_cache(cache, 200.0, 0).collect()] == ["old"]


def page(body):
    return "<html>" + TOOLBAR_END + "<body>" + body + FOOTER + " on x -->"


def test_parse_hides_scripts_and_orders_frames():
    out = parse_page('<head><title>t</title></head><body>a&amp;b<p>c<!-- no --></p><script>var t="</p>";</script><iframe src="i"></iframe><frame src="f"><frame><b>open<style>s</style>')
    assert [s for s in out["segments"] if s.strip()] == ["a&b", "c", "open"] and out["frames"] == ["f", "i"]
    assert parse_page('<a href="x" href="y">l</a>')["links"] == ["y"]
    assert parse_page("<head><basefont>t<bgsound></head><body>v")["segments"] == ["v"]


def test_page_store_keeps_the_last_whole_page(spark):
    pages = [(AT + "http://a.com/", page("one"), 1), (AT + "http://a.com/", page("two"), 2), (AT + "http://a.com/", page("Too many requests"), 3), (AT + "http://b.com/", page("too many requests"), 1), (AT + "http://c.com/", page("same"), 1), (AT + "http://c.com/", page("same"), 1)]
    df = spark.createDataFrame(pages, "url string, html string, at long")
    assert sorted((r.url[-6:], r.segments) for r in page_store(df, ordinal="at").collect()) == [("a.com/", ["two"]), ("b.com/", ["too many requests"]), ("c.com/", ["same"])]
    assert sorted(r.url[-6:] for r in page_store(df).collect()) == ["a.com/", "b.com/", "c.com/"]


def store(spark):
    u = lambda x: AT + "http://a.com/" + x
    pages = [
        (u(""), page('home text<iframe src="f1"></iframe><iframe src="f2"></iframe><a href="/news">n</a><a href="/gone">g</a><a href="/same">s</a>')),
        (u("f1"), page('frame one<iframe src="f3"></iframe><a href="/issues">i</a>')), (u("f2"), page("frame two")), (u("f3"), page('frame three<iframe src="f4"></iframe>')), (u("f4"), page("too deep")),
        (u("news"), page("news text")), (u("same"), page("news text")), (u("issues"), page("issue text")), (u("plain"), "<p>not archived</p>"), (u("x.pdf"), page("binary")),
    ]
    return page_store(spark.createDataFrame(pages, "url string, html string")), u


def capture_rows(spark, urls):
    return spark.createDataFrame([(u, "20200601000000", "http://a.com", "Jane Doe", "OH", "01", "house", 2020, "D") for u in urls], "wayback_url string, timestamp string, website_url string, candidate string, state string, district string, office string, year int, party string")


def test_snapshot_follows_frames_and_links(spark):
    pages, u = store(spark)
    out = S.snapshots(capture_rows(spark, [u(""), u("missing"), u("plain")]), pages).collect()
    got = {(r.wayback_url, r.snap_url): r.snap_content for r in out}
    assert got == {
        (u(""), u("")): "home textframe oneframe three#+#frame two", (u(""), u("news")): "news text", (u(""), u("issues")): "issue text",
        (u("missing"), u("missing")): "", (u("plain"), u("plain")): "",
    }


def test_page_records_and_resume(spark, tmp_path):
    pages, u = store(spark)
    homes = capture_rows(spark, [u(""), u("missing")])
    found, done = scrape(homes, pages, spark.createDataFrame([], "url string"))
    records = found.collect()
    assert sorted(r.page_type for r in records) == ["homepage", "issues", "news"] and all(r.n_char == len(r.text_snap_content) and r.stage == 2 and TOOLBAR_END not in r.text_snap_content for r in records)
    assert done.count() == 2 and scrape(homes, pages, done)[0].count() == 0
    homes.write.parquet(f"{tmp_path}/in")
    progress = f"{tmp_path}/progress"
    seen = lambda: spark.read.parquet(progress) if (tmp_path / "progress").exists() else spark.createDataFrame([], "url string")
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema(homes.schema).parquet(f"{tmp_path}/in")
        scrape_stream(stream, lambda: pages, seen, f"{tmp_path}/pages", progress, f"{tmp_path}/check").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/pages").count() == 3


def test_reclassify(spark):
    data = [("other", AT + "http://a.com/x/", "short", "f1"), ("other", AT + "https://a.com/x", "a longer text", "f2"), ("news", AT + "http://a.com/n", "n", "f1"), ("other", AT + "http://a.com/y", None, "f1")]
    pages = spark.createDataFrame(data, "page_type string, snap_url string, text_snap_content string, source_file string")
    other = R.other_pages(pages)
    assert sorted((r.snap_url_pattern, r.text_excerpt) for r in other.collect()) == [("a.com/x", "a longer text"), ("a.com/y", "")]
    labels = R.label_with(other, F.when(F.col("text_excerpt") != "", "It's ISSUES"))
    assert R.not_labelled(other, labels.where("snap_url_pattern = 'a.com/x'")).count() == 1
    final = R.final_page_type(pages, labels.where("page_type_llm <> 'other'"))
    assert sorted(r.final_page_type for r in final.collect()) == ["issues", "issues", "news", "other"]
    assert abs(R.cost(other).first().dollars - 2 * 4.25e-5) < 1e-12
    answers = other.select(T.prompt(F.col("original_url"), F.col("text_excerpt")).alias("prompt"), F.lit("news").alias("answer"))
    assert {r.page_type_llm for r in R.ask(other, answers).collect()} == {"news"}
    later = spark.createDataFrame([("a.com/x", "action", 2), ("a.com/x", "news", 3), ("a.com/x", "biography", 1), ("a.com/x", None, 4)], "snap_url_pattern string, page_type_llm string, labelled_at long")
    assert sorted(r.final_page_type for r in R.final_page_type(pages, later).collect()) == ["news", "news", "news", "other"]


def test_labelling_stops_after_too_many_errors(spark):
    pages = spark.createDataFrame([(f"p{i}", f"u{i}", "t") for i in range(8)], "snap_url_pattern string, original_url string, text_excerpt string")
    answers = pages.select(T.prompt(F.col("original_url"), F.col("text_excerpt")).alias("prompt"), F.lit("news").alias("answer"), F.when(F.col("snap_url_pattern").isin("p1", "p3", "p5"), "limit").alias("error"))
    labelled = lambda most: sorted(r.snap_url_pattern for r in R.ask(pages, answers, most).collect())
    assert labelled(50) == ["p0", "p2", "p4", "p6", "p7"] and labelled(2) == ["p0", "p2", "p4"] and labelled(0) == ["p0"]


def test_longest_snapshot_and_candidate_files(spark, tmp_path):
    data = [("Ann", "OH", "house", 2020, "20200102", "u2", 'long, "quoted"\ntext', 18), ("Ann", "OH", "house", 2020, "20200101", "u1", "short", 5), ("Bob", "TX", "house", 2020, "20200101", "u3", "b", 1), ("Ann", "OH", "house", 2020, "20200101", "u9", "also 18 characters", 18)]
    pages = spark.createDataFrame(data, "candidate string, state string, office string, year int, date string, snap_url string, text_snap_content string, n_char int")
    assert sorted((r.candidate, r.snap_url) for r in S.longest_snapshot(pages).collect()) == [("Ann", "u9"), ("Bob", "u3")]
    tables.write_candidate_csv(pages, f"{tmp_path}/csv")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{tmp_path}/csv")
    assert sorted((r.file, r.date, r.text_snap_content) for r in back.collect()) == sorted((f"{c} ({s})", d, t) for c, s, _, _, d, _, t, _ in data)
    assert sorted(r.snap_url for r in S.first_of_content(pages, "candidate", "text_snap_content", "snap_url").collect()) == ["u1", "u2", "u3", "u9"]


def test_entry_and_queries_import():
    import __spark_entry__ as entry

    assert {"page_type_classify", "snapshot_rows"} <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_command_line(spark, tmp_path):
    from strandline.plans import cli

    assert cli.years(2018, 2023) == [2018, 2020, 2022] and cli.years(2020, None) == [2020]
    line = "|".join(["H1", "DOE, JANE", "DEM", "2020", "OH", "H", "01", "I", "C", "C1", "s", "", "c", "OH", "1"])
    (tmp_path / "cn2020.txt").write_text(line)
    spark.createDataFrame([("C1", "a.com")], "pcc string, website string").write.parquet(f"{tmp_path}/committees")
    cli.main(["roster", "--candidates", f"{tmp_path}/cn{{year}}.txt", "--office", "house", "--years", "2020", "--committees", f"{tmp_path}/committees", "--cache", f"{tmp_path}/cache", "--out", f"{tmp_path}/roster"], spark)
    assert [(r.candidate, r.url) for r in spark.read.parquet(f"{tmp_path}/cache/committees").collect()] == [("Jane Doe", "https://a.com")]
    (tmp_path / "index").write_text("20200601000000 http://www.a.com/ 200 text/html\n20190601000000 http://a.com/ 200 text/html\n")
    html = [(AT + "http://www.a.com/", page('<p>home text</p><a href="/xyz">x</a>')), (AT + "http://www.a.com/xyz", page("<p>other text</p>"))]
    spark.createDataFrame(html, "url string, html string").write.parquet(f"{tmp_path}/store")
    for _ in range(2):  # the second run has nothing to do
        cli.main(["scrape", "--roster", f"{tmp_path}/roster", "--captures", f"{tmp_path}/index", "--store", f"{tmp_path}/store", "--office", "house", "--year", "2020", "--out", f"{tmp_path}/pages", "--progress", f"{tmp_path}/progress", "--csv", f"{tmp_path}/csv"], spark)
    pages = spark.read.parquet(f"{tmp_path}/pages")
    assert sorted((r.page_type, r.text_snap_content, r.district) for r in pages.collect()) == [("homepage", "home text", "01"), ("other", "other text", "01")]
    # records of a run that stopped before its progress was written are not read
    finished = spark.read.parquet(f"{tmp_path}/progress")
    tables.append_pages(pages.drop("batch"), f"{tmp_path}/pages", "stopped")
    assert tables.page_rows(spark, f"{tmp_path}/pages").count() == 4 and tables.page_rows(spark, f"{tmp_path}/pages", finished=finished).count() == 2
    assert S.status_counts(spark.read.parquet(f"{tmp_path}/progress")).first().asDict() == {"n": 1, "n_complete": 1, "n_failed": 0}
    todo = R.other_pages(tables.page_rows(spark, f"{tmp_path}/pages", "house", 2020))
    todo.select(T.prompt(F.col("original_url"), F.col("text_excerpt")).alias("prompt"), F.lit("Issues").alias("answer")).write.parquet(f"{tmp_path}/answers")
    for extra in (["--dry-run"], []):
        cli.main(["classify", "--pages", f"{tmp_path}/pages", "--all", "--labels", f"{tmp_path}/labels", "--progress", f"{tmp_path}/progress", "--answers", f"{tmp_path}/answers", *extra], spark)
    assert [tuple(r)[:2] for r in spark.read.parquet(f"{tmp_path}/labels").collect()] == [("www.a.com/xyz", "issues")]
    (tmp_path / "options.yaml").write_text("max_captures: 0\n")
    cli.main(["scrape", "--config", f"{tmp_path}/options.yaml", "--roster", f"{tmp_path}/roster", "--captures", f"{tmp_path}/index", "--store", f"{tmp_path}/store", "--office", "house", "--year", "2020", "--out", f"{tmp_path}/none", "--progress", f"{tmp_path}/none_progress"], spark)
    assert spark.read.parquet(f"{tmp_path}/none_progress").count() == 0


def test_options_load(tmp_path):
    from strandline.values import Options

    (tmp_path / "o.yaml").write_text("ttl_days: 5\nskip_suffixes: [pdf]\n")
    assert Options.load(str(tmp_path / "o.yaml")) == Options(ttl_days=5, skip_suffixes=("pdf",))
