"""Registered queries of the web-corpus operators over the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import text as T
from strandline.functions import urls as U
from strandline.operators import captures as C
from strandline.operators import reclassify as R
from strandline.operators import roster as O
from strandline.operators import snapshots as S
from strandline.sources.held import hold
from strandline.sources.html import page_store
from strandline.sources.tables import url_cache
from strandline.values import ARCHIVE, BIOGRAPHY_PREFIXES, FOOTER, NOISE_SEGMENTS, PAGE_TYPES, PRIORITY, SEPARATOR, STATES, TOOLBAR_END

SEGMENTS = ["issues", "about", "Press-Releases", "donate", "index.php/News", "meet-jane", "public/site", "district", "endorsements", "privacy.html", "", "home", "index.cfm", "en/825;x=1?page=2", "pages/Platform/tax#top"]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as captures: (o_orderkey as ordinal, site, timestamp, original_url, wayback_url, statuscode, mimetype)."""
    word = F.element_at(F.array(*map(F.lit, SEGMENTS)), (F.col("o_orderkey") % len(SEGMENTS) + 1).cast("int"))
    host = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "http://www.site").otherwise("https://site"), F.col("o_custkey").cast("string"), F.lit(".org"))
    df = _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ordinal"), F.col("o_custkey").alias("site"), F.date_format("o_orderdate", "yyyyMMddHHmmss").alias("timestamp"),
        F.concat(host, F.lit("/"), word).alias("original_url"), F.when(F.col("o_orderstatus") == "P", "404").otherwise("200").alias("statuscode"),
        F.when(F.col("o_orderkey") % 7 == 0, "image/png").otherwise("text/html").alias("mimetype"),
    )
    return df.withColumn("wayback_url", U.archive_url(F.col("timestamp"), F.col("original_url")))


_LIST = "[" + ", ".join(f"'{s}'" for s in SEGMENTS) + "]"
SITES = f"""sites AS (SELECT *, '{ARCHIVE}' || "timestamp" || '/' || original_url AS wayback_url FROM (
  SELECT o_orderkey AS ordinal, o_custkey AS site, strftime(o_orderdate, '%Y%m%d%H%M%S') AS "timestamp",
    CASE WHEN o_orderkey % 3 = 0 THEN 'http://www.site' ELSE 'https://site' END || o_custkey || '.org/' || ({_LIST})[(o_orderkey % {len(SEGMENTS)} + 1)::INT] AS original_url,
    CASE WHEN o_orderstatus = 'P' THEN '404' ELSE '200' END AS statuscode, CASE WHEN o_orderkey % 7 = 0 THEN 'image/png' ELSE 'text/html' END AS mimetype FROM orders))"""
_quoted = lambda words: ", ".join(f"'{w}'" for w in words)


def _kind_sql(url: str) -> str:
    """DuckDB's form of the page category of an expression."""
    own = f"CASE WHEN regexp_matches({url}, '^https?://web\\.archive\\.org/web/\\d+[^/]*/(.+)') THEN regexp_extract({url}, '^https?://web\\.archive\\.org/web/\\d+[^/]*/(.+)', 1) ELSE {url} END"
    path = f"regexp_replace(regexp_extract(CASE WHEN contains({own}, '://') THEN {own} ELSE 'http://' || {own} END, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"
    first = f"list_filter(string_split(lower({path}), '/'), lambda s: s <> '' AND s NOT IN ({_quoted(NOISE_SEGMENTS)}))[1]"
    cases = " ".join(f"WHEN f IN ({_quoted(w)}) THEN '{k}'" for k, w in PAGE_TYPES.items())
    prefixes = " ".join(f"WHEN starts_with(f, '{p}') THEN 'biography'" for p in BIOGRAPHY_PREFIXES)
    return f"(SELECT CASE WHEN f IS NULL OR f = 'home' OR regexp_matches(f, '^index\\.\\w+$') THEN 'homepage' {cases} {prefixes} ELSE 'other' END FROM (SELECT {first} AS f))"


QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


@query(f"WITH {SITES} SELECT ordinal, {_kind_sql('wayback_url')} AS page_type FROM sites")
def page_type_classify(spark, sf_dir):
    return _sites(spark, sf_dir).select("ordinal", U.page_type(F.col("wayback_url")).alias("page_type"))


@query(f"WITH {SITES}, k AS (SELECT {_kind_sql('wayback_url')} AS page_type FROM sites) SELECT page_type, count(*) AS n, count(*) / (SELECT count(*) FROM k) AS share FROM k GROUP BY page_type")
def page_type_distribution(spark, sf_dir):
    return S.page_type_shares(page_type_classify(spark, sf_dir))


@query(f"WITH {SITES}, k AS (SELECT site, ordinal, {_kind_sql('wayback_url')} AS page_type FROM sites) SELECT site, ordinal, page_type, row_number() OVER (PARTITION BY site ORDER BY list_position([{_quoted(PRIORITY)}], page_type), ordinal)::INT AS place FROM k")
def subpage_priority(spark, sf_dir):
    kinds = _sites(spark, sf_dir).select("site", "ordinal", U.page_type(F.col("wayback_url")).alias("page_type"))
    return S.by_priority(kinds, "site", "ordinal")


@query("""SELECT page_id, regexp_replace(rtrim(lower(url), '/'), '^(https?://)www\\.', '\\1') AS dedup_url, regexp_replace(regexp_replace(url, '^https://', ''), '^http://', '').rtrim('/') AS pattern,
  CASE WHEN starts_with(regexp_replace(lower(trim(s)), '^https?://https?://', 'https://'), 'http') THEN regexp_replace(lower(trim(s)), '^https?://https?://', 'https://') ELSE 'https://' || lower(trim(s)) END AS site
  FROM (SELECT *, CASE page_id % 3 WHEN 0 THEN 'http://' || url WHEN 1 THEN ' ' || regexp_replace(url, '^https?://', '') || ' ' ELSE upper(url) END AS s FROM pages)""")
def url_normalize(spark, sf_dir):
    raw = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("http://"), "url")).when(F.col("page_id") % 3 == 1, F.concat(F.lit(" "), F.regexp_replace("url", "^https?://", ""), F.lit(" "))).otherwise(F.upper("url"))
    url = F.col("url")
    return _read(spark, sf_dir, "pages").select("page_id", U.dedup_url(url).alias("dedup_url"), U.url_pattern(url).alias("pattern"), U.committee_url(raw).alias("site"))


@query(f"WITH {SITES} SELECT ordinal, wayback_url, original_url, string_split(string_split(original_url, '://')[2], '/')[1] AS domain FROM sites")
def original_url(spark, sf_dir):
    wrapped = F.col("wayback_url")
    return _sites(spark, sf_dir).select("ordinal", "wayback_url", U.original_url(wrapped).alias("original_url"), U.archived_domain(wrapped).alias("domain"))


_WRAPPED = f"'<html>' || '{TOOLBAR_END}' || html || '{FOOTER}' || ' ON 2020 -->'"


@query(f"SELECT page_id, regexp_replace(string_split(string_split(w, '{TOOLBAR_END}')[-1], '{FOOTER}')[1], '^\\s+|\\s+$', '', 'g') AS html, contains(w, 'FILE ARCHIVED ON') OR contains(w, '{TOOLBAR_END}') AS archived FROM (SELECT page_id, {_WRAPPED} AS w FROM pages)")
def archive_toolbar_strip(spark, sf_dir):
    wrapped = F.concat(F.lit("<html>" + TOOLBAR_END), "html", F.lit(FOOTER + " ON 2020 -->"))
    return _read(spark, sf_dir, "pages").select("page_id", T.strip_toolbar(wrapped).alias("html"), T.is_archived(wrapped).alias("archived"))


@query(f"""WITH {SITES} SELECT ordinal, "timestamp", original_url, wayback_url FROM sites WHERE "timestamp"[1:8] BETWEEN '19970101' AND '19971231' AND statuscode = '200' AND mimetype = 'text/html'
  QUALIFY row_number() OVER (PARTITION BY original_url ORDER BY "timestamp", ordinal) <= 2""")
def capture_filter(spark, sf_dir):
    start, end = C.election_year(F.lit(1997))
    return C.select_captures(_sites(spark, sf_dir).drop("wayback_url"), start, end, 2).select("ordinal", "timestamp", "original_url", "wayback_url")


def _bucket_sql(k: int) -> str:
    return f"""WITH {SITES} SELECT ordinal, "timestamp", original_url FROM sites QUALIFY row_number() OVER (PARTITION BY regexp_replace(rtrim(lower(original_url), '/'), '^(https?://)www\\.', '\\1'),
      "timestamp"[1:4], ("timestamp"[5:6]::INT - 1) // {k} ORDER BY "timestamp" DESC, ordinal) = 1"""


for _k in (1, 3, 12):
    def _dedup(spark, sf_dir, k=_k):
        return C.bucket_dedup(_sites(spark, sf_dir), k).select("ordinal", "timestamp", "original_url")

    _dedup.__name__ = f"bucket_dedup_{_k}"
    query(_bucket_sql(_k))(_dedup)


@query(f"""WITH {SITES}, k AS (SELECT site, ordinal, "timestamp", row_number() OVER (PARTITION BY site, "timestamp"[1:6] ORDER BY "timestamp", ordinal) AS r FROM sites)
  SELECT site, ordinal, "timestamp" FROM k QUALIFY row_number() OVER (PARTITION BY site ORDER BY r, "timestamp"[1:6]) <= 5""")
def stratified_sample(spark, sf_dir):
    return C.stratified_sample(_sites(spark, sf_dir).select("site", "ordinal", "timestamp"), 5)


@query("""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: length(x) > 2) AS a FROM documents),
  e AS (SELECT doc_id, unnest(a) AS x, unnest(range(1, len(a) + 1)) AS i FROM s),
  k AS (SELECT doc_id, x, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS c FROM e) WHERE c <= 2 OR length(x) < 5),
  w AS (SELECT *, lag(x) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM k),
  j AS (SELECT doc_id, string_agg(x, '#+#' ORDER BY i) AS t FROM w WHERE before IS NULL OR before <> x GROUP BY doc_id)
  SELECT documents.doc_id, coalesce(t, '') AS visible FROM documents LEFT JOIN j USING (doc_id)""")
def segment_dedup(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", T.page_text(F.split(F.coalesce("text", F.lit("")), "\n")).alias("visible"))


@query("""SELECT doc_id, length(text)::INT AS n_char, len(regexp_extract_all(text, '\\S+'))::INT AS n_words, array_to_string(regexp_extract_all(text, '\\S+')[1:20], ' ') AS excerpt,
  contains(lower(text), 'too many requests') AS limited FROM documents""")
def text_metrics(spark, sf_dir):
    text = F.col("text")
    return _read(spark, sf_dir, "documents").select("doc_id", T.n_char(text).alias("n_char"), T.n_words(text).alias("n_words"), T.first_words(text, 20).alias("excerpt"), T.rate_limited(text).alias("limited"))


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source, text ORDER BY doc_id) = 1")
def content_dedup(spark, sf_dir):
    return S.first_of_content(_read(spark, sf_dir, "documents"), "source", "text", "doc_id").select("doc_id", "source")


def _other_rows(spark, sf_dir):
    url = F.concat(F.when(F.col("doc_id") % 2 == 0, "http://").otherwise("https://"), F.lit("a.org/p"), (F.col("doc_id") % 97).cast("string"), F.when(F.col("doc_id") % 5 == 0, "/").otherwise(""))
    return _read(spark, sf_dir, "documents").select(F.lit("other").alias("page_type"), U.archive_url(F.lit("20200101000000"), url).alias("snap_url"), F.col("text").alias("text_snap_content"), F.col("source").alias("source_file"))


_OTHER = "others AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'http://' ELSE 'https://' END || 'a.org/p' || doc_id % 97 || CASE WHEN doc_id % 5 = 0 THEN '/' ELSE '' END AS original_url, 'a.org/p' || doc_id % 97 AS snap_url_pattern, text, source AS source_file FROM documents)"
_LONGEST = f"WITH {_OTHER}, longest AS (SELECT snap_url_pattern, original_url, array_to_string(regexp_extract_all(text, '\\S+')[1:200], ' ') AS text_excerpt, source_file FROM others QUALIFY row_number() OVER (PARTITION BY snap_url_pattern ORDER BY length(text) DESC, source_file, original_url, text) = 1)"


@query(f"{_LONGEST} SELECT * FROM longest")
def longest_per_pattern(spark, sf_dir):
    return R.other_pages(_other_rows(spark, sf_dir))


@query(f"{_LONGEST} SELECT count(*) AS n_pages, count(*) * 0.0000425::DOUBLE AS dollars FROM longest")
def llm_cost(spark, sf_dir):
    return R.cost(R.other_pages(_other_rows(spark, sf_dir)))


_W1, _W2 = "string_split(p_name, ' ')[1]", "string_split(p_name, ' ')[2]"


def _names(spark, sf_dir):
    w = F.split("p_name", " ")
    return _read(spark, sf_dir, "part").select("p_partkey", F.concat(F.upper(w[1]), F.lit(", "), F.upper(w[0]), F.when(F.col("p_partkey") % 4 == 0, " \"ACE\"").otherwise(" O'X-y")).alias("raw"))


@query(f"""SELECT p_partkey, upper({_W1}[1]) || lower({_W1}[2:]) || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE ' O''X-Y' END || ' ' || upper({_W2}[1]) || lower({_W2}[2:]) AS candidate,
  CASE WHEN p_partkey % 4 = 0 THEN 'Ace' END AS nickname, CASE p_partkey % 3 WHEN 0 THEN 'Ohio' WHEN 1 THEN 'Puerto Rico' END AS state FROM part""")
def clean_name(spark, sf_dir):
    code = F.when(F.col("p_partkey") % 3 == 0, "oh").when(F.col("p_partkey") % 3 == 1, "PR").otherwise("ZZ")
    return _names(spark, sf_dir).select("p_partkey", T.clean_name(F.col("raw")).alias("candidate"), T.nickname(F.col("raw")).alias("nickname"), T.state_name(code).alias("state"))


def _raw_candidates(spark, sf_dir):
    states = F.array(*map(F.lit, sorted(STATES)))
    k = F.col("p_partkey")
    w = F.split("p_name", " ")
    return _read(spark, sf_dir, "part").select(
        F.concat(F.upper(w[1]), F.lit(", "), F.upper(w[0])).alias("cand_name"), F.element_at(states, (k % 7 + 1).cast("int")).alias("cand_office_st"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.lpad((k % 3).cast("string"), 2, "0")).alias("cand_office_district"), F.when(k % 2 == 0, "H").otherwise("S").alias("cand_office"),
        F.element_at(F.array(*map(F.lit, ["DEM", "REP", "DFL", "IND"])), (k % 4 + 1).cast("int")).alias("cand_pty_affiliation"), F.concat(F.lit(" C"), (k % 120).cast("string")).alias("cand_pcc"), F.concat(F.lit("P"), k.cast("string")).alias("cand_id"), k.alias("ordinal"),
    )


_STATES = "[" + _quoted(sorted(STATES)) + "]"
_ROSTER = f"""roster AS (SELECT * EXCLUDE (f) FROM (SELECT upper({_W1}[1]) || lower({_W1}[2:]) || ' ' || upper({_W2}[1]) || lower({_W2}[2:]) AS candidate, ({_STATES})[(p_partkey % 7 + 1)::INT] AS state,
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE lpad((p_partkey % 3)::VARCHAR, 2, '0') END AS district, 'house' AS office, 2020::INT AS "year", (['D', 'R', 'D'])[(p_partkey % 4 + 1)::INT] AS party, 'C' || p_partkey % 120 AS pcc, p_partkey AS ordinal, p_partkey % 4 AS f
  FROM part WHERE p_partkey % 2 = 0) WHERE f <> 3 QUALIFY row_number() OVER (PARTITION BY candidate, state, district ORDER BY ordinal) = 1)"""


@query(f'WITH {_ROSTER} SELECT candidate, state, district, office, "year", party, ordinal FROM roster')
def roster_build(spark, sf_dir):
    return O.build_roster(_raw_candidates(spark, sf_dir), 2020, "house").select("candidate", "state", "district", "office", "year", "party", "ordinal")


def _sources(spark, sf_dir):
    """All suppliers as committees and all parts as knowledge-base entries; some have no website, or no name."""
    k = F.col("s_suppkey")
    committees = _read(spark, sf_dir, "supplier").select(F.concat(F.lit("C"), k.cast("string")).alias("pcc"), F.when((k % 2 == 1) | (k % 6 == 0), "").otherwise(F.concat(F.lit("WWW.S"), k.cast("string"), F.lit(".org"))).alias("website"))
    part, k = _read(spark, sf_dir, "part"), F.col("p_partkey")
    websites = part.select(k.alias("qid"), F.when(k % 3 == 0, F.concat(F.lit("http://kb"), k.cast("string"))).otherwise("").alias("website"), k.alias("ord"))
    labels = part.select(k.alias("qid"), F.when(k % 2 == 1, F.initcap("p_name")).alias("name"))
    return O.CommitteeSource(committees), O.NameSource(websites, labels)


_COMMITTEES = "committees AS (SELECT 'C' || s_suppkey AS pcc, CASE WHEN s_suppkey % 2 = 1 OR s_suppkey % 6 = 0 THEN '' ELSE 'https://www.s' || s_suppkey || '.org' END AS u0 FROM supplier)"
_KB = f"""entries AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'http://kb' || p_partkey ELSE '' END AS website, CASE WHEN p_partkey % 2 = 1 THEN lower(p_name) END AS known, lower({_W2}) AS last FROM part),
  kb AS (SELECT ordinal AS o, 'http://kb' || min(p_partkey) AS u1 FROM roster JOIN entries ON website <> '' AND known IS NOT NULL AND last = lower(string_split(candidate, ' ')[-1])
  AND contains(known, lower(candidate)[1:3]) GROUP BY ordinal)"""


@query(f"WITH {_ROSTER}, {_COMMITTEES}, {_KB} SELECT ordinal, candidate, coalesce(nullif(u0, ''), u1, '') AS website_url FROM roster LEFT JOIN committees USING (pcc) LEFT JOIN kb ON o = ordinal")
def url_waterfall(spark, sf_dir):
    roster = O.build_roster(_raw_candidates(spark, sf_dir), 2020, "house").withColumn("roster_id", F.col("ordinal"))
    return O.fill_urls(roster, _sources(spark, sf_dir)).select("ordinal", "candidate", "website_url")


@query(f"WITH {_ROSTER}, {_KB} SELECT o AS ordinal, u1 AS website FROM kb")
def kb_name_match(spark, sf_dir):
    roster = O.build_roster(_raw_candidates(spark, sf_dir), 2020, "house").withColumn("roster_id", F.col("ordinal"))
    return _sources(spark, sf_dir)[1].urls(roster).select(F.col("roster_id").alias("ordinal"), F.col("url").alias("website"))


@query(f"WITH {SITES} SELECT ordinal FROM sites WHERE ordinal NOT IN (SELECT event_id FROM events)")
def resume_anti_join(spark, sf_dir):
    done = _read(spark, sf_dir, "events").select(F.col("event_id").alias("url"))
    return C.not_done(_sites(spark, sf_dir), done, "ordinal").select("ordinal")


@query("SELECT candidate, state, url FROM (SELECT event_type AS candidate, (user_id % 50)::VARCHAR AS state, props AS url, event_id FROM events WHERE 1706745600 - epoch(date_trunc('second', ts)) <= 10 * 86400) QUALIFY row_number() OVER (PARTITION BY candidate, state ORDER BY event_id DESC) = 1")
def url_cache_ttl(spark, sf_dir):
    rows = _read(spark, sf_dir, "events").select(F.col("event_type").alias("candidate"), (F.col("user_id") % 50).cast("string").alias("state"), F.lit("2024").alias("year"), F.col("props").alias("url"), F.unix_timestamp("ts").cast("string").alias("cached_at"), F.col("event_id").alias("ordinal"))
    return url_cache(rows, 1706745600.0, 10).select("candidate", "state", "url")


_ANSWER = "CASE event_id % 5 WHEN 0 THEN ' Issues ' WHEN 1 THEN 'it is News, not action' WHEN 2 THEN 'none' WHEN 3 THEN NULL ELSE 'constituent_services.' END"
_PARSED = "CASE event_id % 5 WHEN 0 THEN 'issues' WHEN 1 THEN 'news' WHEN 4 THEN 'constituent_services' ELSE 'other' END"


@query(f"SELECT event_id, {_PARSED} AS label FROM events")
def llm_answer_parse(spark, sf_dir):
    return _read(spark, sf_dir, "events").select("event_id", T.parse_label(F.expr(_ANSWER)).alias("label"))


@query(f"WITH {SITES}, l AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN {_PARSED} END AS label FROM events) SELECT ordinal, coalesce(label, {_kind_sql('wayback_url')}) AS final_page_type FROM sites LEFT JOIN l ON event_id = ordinal")
def final_page_type(spark, sf_dir):
    """Labels for all urls, null for odd numbers; each even one has an older label that must lose."""
    pages = _sites(spark, sf_dir).select("ordinal", F.concat("wayback_url", F.lit("?id="), F.col("ordinal").cast("string")).alias("snap_url"), U.page_type(F.col("wayback_url")).alias("page_type"))
    keys = pages.select(F.col("ordinal").alias("event_id"), U.url_pattern(U.original_url(F.col("snap_url"))).alias("snap_url_pattern"))
    answered = llm_answer_parse(spark, sf_dir).join(keys, "event_id").select("snap_url_pattern", F.when(F.col("event_id") % 2 == 0, F.col("label")).alias("page_type_llm"), F.lit(2).alias("labelled_at"))
    older = answered.where("page_type_llm IS NOT NULL").select("snap_url_pattern", F.lit("action").alias("page_type_llm"), F.lit(1).alias("labelled_at"))
    return R.final_page_type(pages, answered.unionByName(older)).select("ordinal", "final_page_type")


def _store(spark, sf_dir) -> DataFrame:
    """The pages as archived ones; each links to the next page of its host's list by a full url, and every fifth frames the next."""
    pages = _read(spark, sf_dir, "pages")
    tail = F.concat(F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("<iframe src=\"https://web.archive.org/web/20200101000000/"), F.lit("http://p"), (F.col("page_id") + 1).cast("string"), F.lit(".example.org/\"></iframe>"))).otherwise(""), F.lit("<a href=\"/about\">About</a>"))
    url = F.concat(F.lit("http://p"), F.col("page_id").cast("string"), F.lit(".example.org/"))
    main = pages.select(U.archive_url(F.lit("20200101000000"), url).alias("url"), F.concat(F.lit(TOOLBAR_END), "html", tail, F.lit(FOOTER)).alias("html"))
    about = pages.select(U.archive_url(F.lit("20200101000000"), F.concat(url, F.lit("about"))).alias("url"), F.concat(F.lit(TOOLBAR_END + "<p>About page "), F.col("page_id").cast("string"), F.lit("</p>" + FOOTER)).alias("html"))
    # Frames, links and pages all join the parsed pages: parsed once, to a table.
    return hold(page_store(main.unionByName(about)))


def _homes(spark, sf_dir) -> DataFrame:
    url = F.concat(F.lit("http://p"), F.col("page_id").cast("string"), F.lit(".example.org/"))
    return _read(spark, sf_dir, "pages").select(U.archive_url(F.lit("20200101000000"), url).alias("wayback_url"), F.lit("20200101000000").alias("timestamp"), url.alias("website_url"), F.concat(F.lit("C"), F.col("page_id").cast("string")).alias("candidate"), F.lit("OH").alias("state"), F.lit("01").alias("district"), F.lit("house").alias("office"), F.lit(2020).alias("year"), F.lit("D").alias("party"))


def _unescaped(x: str) -> str:
    """DuckDB's form of the character references that the pages have; a title cut short may lack the semicolon."""
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name};?', '{char}', 'g')"
    return x


_AT = ARCHIVE + "20200101000000/"
#: The pages' markup as SQL sees it: nothing in the head is visible, comments part texts, and the tags of the bodies hide none.
_STORE = f"""raw AS (SELECT page_id, regexp_replace(regexp_replace(html, '^.*?</head>', '', 's') || '<x><a href="/about">About</a>', '<!--.*?-->', '<x>', 'gs') AS body FROM pages),
  cells AS (SELECT page_id, regexp_split_to_array(body, '<[^>]*>') AS a FROM raw),
  texts AS (SELECT page_id, list_filter(list_transform(a, lambda x: regexp_replace({_unescaped('x')}, '^\\s+|\\s+$', '', 'g')), lambda x: length(x) > 2) AS a FROM cells),
  e AS (SELECT page_id, unnest(a) AS x, unnest(range(1, len(a) + 1)) AS i FROM texts),
  k AS (SELECT page_id, x, i FROM (SELECT *, count(*) OVER (PARTITION BY page_id, x) AS c FROM e) WHERE c <= 2 OR length(x) < 5),
  w AS (SELECT *, lag(x) OVER (PARTITION BY page_id ORDER BY i) AS before FROM k),
  j AS (SELECT page_id, string_agg(x, '{SEPARATOR}' ORDER BY i) AS t FROM w WHERE before IS NULL OR before <> x GROUP BY page_id),
  main AS (SELECT page_id, '{_AT}http://p' || page_id || '.example.org/' AS url, coalesce(t, '') AS visible FROM pages LEFT JOIN j USING (page_id)),
  about AS (SELECT page_id, '{_AT}http://p' || page_id || '.example.org/about' AS url, 'About page ' || page_id AS visible FROM pages)"""
#: Every fifth page frames the next, so a page's content is its own text and that of its frame, and its links are those of both.
_FRAMED = f"""framed AS (SELECT m.page_id, m.url AS root, m.visible || coalesce(f.visible, '') AS content FROM main m LEFT JOIN main f ON m.page_id % 5 = 0 AND f.page_id = m.page_id + 1),
  hrefs AS (SELECT page_id, replace(unnest(regexp_extract_all(body, '<a href="([^"]*)"', 1)), '&amp;', '&') AS href FROM raw),
  links AS (SELECT DISTINCT '{_AT}http://p' || r.page_id || '.example.org/' AS root, '{_AT}http://p' || h.page_id || '.example.org' || href AS link
            FROM pages r JOIN hrefs h ON h.page_id = r.page_id OR (r.page_id % 5 = 0 AND h.page_id = r.page_id + 1))"""


@query(f"WITH {_STORE} SELECT url, visible FROM main UNION ALL SELECT url, visible FROM about")
def visible_text(spark, sf_dir):
    return _store(spark, sf_dir).select("url", T.page_text(F.col("segments")).alias("visible"))


@query(f"WITH {_STORE}, {_FRAMED} SELECT root, link FROM links")
def page_links(spark, sf_dir):
    return S.page_content(_homes(spark, sf_dir).select(F.col("wayback_url").alias("root")), _store(spark, sf_dir))[1]


@query(f"""WITH {_STORE}, {_FRAMED},
  store AS (SELECT url, visible FROM main UNION ALL SELECT url, visible FROM about),
  snaps AS (SELECT root, root AS url, content, 0 AS o FROM framed UNION ALL SELECT root, url, visible, 1 FROM links JOIN store ON url = link WHERE link <> root),
  once AS (SELECT * FROM snaps WHERE content <> '' QUALIFY row_number() OVER (PARTITION BY root, content ORDER BY o, url) = 1)
  SELECT 'C' || page_id AS candidate, 'OH' AS state, '01' AS district, 'house' AS office, 2020::INT AS "year", 'D' AS party, 2::INT AS stage, '20200101000000' AS date, 'http://p' || page_id || '.example.org/' AS urlkey,
    once.url AS snap_url, {_kind_sql('once.url')} AS page_type, 'wayback_cdx' AS data_source, 0::INT AS n_tags, 0::INT AS n_clean_tags, content AS text_snap_content, length(content)::INT AS n_char, len(regexp_extract_all(content, '\\S+'))::INT AS n_words
  FROM once JOIN main ON main.url = root""")
def snapshot_rows(spark, sf_dir):
    homes = _homes(spark, sf_dir)
    return S.page_rows(homes, S.snapshots(homes, _store(spark, sf_dir)))


@query("SELECT event_id, 'C' || event_id AS pcc, CASE WHEN event_id % 3 = 0 THEN '' ELSE trim(' site' || user_id || '.org ') END AS website FROM events")
def committee_answers(spark, sf_dir):
    """Events as a lookup service's JSON answers: some without results, some with more than one."""
    body = F.when(F.col("event_id") % 3 == 0, F.lit('{"results": []}')).otherwise(F.concat(F.lit('{"pages": 1, "results": [{"website": " site'), F.col("user_id").cast("string"), F.lit('.org "}, {"website": "no"}]}')))
    answers = _read(spark, sf_dir, "events").select("event_id", F.concat(F.lit("C"), F.col("event_id").cast("string")).alias("pcc"), body.alias("body"))
    return answers.select("event_id", "pcc").join(O.committees_from_json(answers), "pcc")


@query(f"""WITH {_ROSTER}, c AS (SELECT ordinal, pcc, candidate, CASE WHEN ordinal % 5 = 0 THEN '' WHEN ordinal % 7 = 0 THEN 'http://cached' || ordinal END AS hit FROM roster), {_COMMITTEES}, {_KB},
  f AS (SELECT ordinal, coalesce(hit, u0, '') AS a, coalesce(u1, '') AS b FROM c LEFT JOIN committees USING (pcc) LEFT JOIN kb ON o = ordinal)
  SELECT ordinal, CASE WHEN a <> '' THEN a ELSE b END AS website_url, CASE WHEN a <> '' THEN 'committees' WHEN b <> '' THEN 'names' END AS url_source FROM f""")
def cached_waterfall(spark, sf_dir):
    """The waterfall with a cache before the first source: known misses (every fifth) are not asked again, known urls (every seventh) are taken."""
    roster = O.build_roster(_raw_candidates(spark, sf_dir), 2020, "house").withColumn("roster_id", F.col("ordinal"))
    k = F.col("ordinal")
    # district and state are part of the roster's key but not of the cache's: the id makes names unique here
    named = roster.withColumn("candidate", F.concat("candidate", F.lit(" #"), k.cast("string")))
    cache = named.where((k % 5 == 0) | (k % 7 == 0)).select("candidate", "state", F.col("year").cast("string").alias("year"), F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("http://cached"), k.cast("string"))).alias("url"))
    committees, names = _sources(spark, sf_dir)
    plain = _Renamed(names)
    return O.fill_urls(named, [O.CachedSource(committees, cache), plain]).select("ordinal", "website_url", "url_source")


class _Renamed:
    """The name source, for names with a number behind them."""

    name = "names"

    def __init__(self, source):
        self.source = source

    def is_available(self):
        return True

    def urls(self, roster):
        return self.source.urls(roster.withColumn("candidate", F.regexp_replace("candidate", r" #\d+$", "")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to page records to the distribution of categories."""
    return S.page_type_shares(snapshot_rows(spark, sf_dir)).orderBy("page_type")
