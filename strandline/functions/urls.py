"""URL functions as Catalyst expressions; only relative links need Python."""

from __future__ import annotations

from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.values import ARCHIVE, ARCHIVED, BIOGRAPHY_PREFIXES, BINARY_SUFFIXES, NOISE_SEGMENTS, PAGE_TYPES, PRIORITY


def original_url(url: Column) -> Column:
    """The url inside an archive url, else the url itself."""
    return F.when(url.rlike(ARCHIVED), F.regexp_extract(url, ARCHIVED, 1)).otherwise(url)


def archive_url(timestamp: Column, url: Column) -> Column:
    return F.concat(F.lit(ARCHIVE), timestamp, F.lit("/"), url)


def url_path(url: Column) -> Column:
    """The path; a url without a scheme counts as http."""
    full = F.when(url.contains("://"), url).otherwise(F.concat(F.lit("http://"), url))
    return F.regexp_replace(F.regexp_extract(full, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1), r";[^/]*$", "")


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def page_type(url: Column) -> Column:
    """Category of a page by the first telling segment of its path."""
    known = F.create_map(*(F.lit(x) for kind, names in PAGE_TYPES.items() for name in names for x in (name, kind)))

    def by_segment(first: Column) -> Column:
        prefixed = F.lit(False)
        for prefix in BIOGRAPHY_PREFIXES:
            prefixed = prefixed | first.startswith(prefix)
        home = first.isNull() | (first == "home") | first.rlike(r"^index\.\w+$")
        return F.when(home, "homepage").otherwise(F.coalesce(F.try_element_at(known, first), F.when(prefixed, "biography"), F.lit("other")))

    def by_url(own: Column) -> Column:
        segments = F.filter(F.split(F.lower(url_path(own)), "/"), lambda s: (s != "") & ~s.isin(NOISE_SEGMENTS))
        host = F.regexp_extract(own, r"^(?:[^:/?#]+://)?([^/?#]*)", 1)
        broken = host.contains("[") != host.contains("]")
        return F.when(own.isNull() | broken, "other").otherwise(_once(F.try_element_at(segments, F.lit(1)), by_segment))

    return _once(original_url(url), by_url)


def priority(kind: Column) -> Column:
    """Place of a category in the order of importance; unknown ones last."""
    at = F.array_position(F.array(*map(F.lit, PRIORITY)), kind)
    return F.when(at > 0, at.cast("int")).otherwise(len(PRIORITY) + 1)


def dedup_url(url: Column) -> Column:
    """Lower case, no slashes at the end, no www. after the scheme."""
    return F.regexp_replace(F.regexp_replace(F.lower(url), "/+$", ""), r"^(https?://)www\.", "$1")


def committee_url(url: Column) -> Column:
    """A listed website as a url: trimmed, lower case, one scheme."""
    flat = F.regexp_replace(F.lower(F.trim(url)), r"^https?://https?://", "https://")
    return F.when(F.coalesce(url, F.lit("")) == "", "").when(flat.startswith("http"), flat).otherwise(F.concat(F.lit("https://"), flat))


def url_pattern(url: Column) -> Column:
    """The url without scheme and without slashes at the end: equal over captures."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "^https://", ""), "^http://", ""), "/+$", "")


def archived_domain(url: Column) -> Column:
    """Host of the original inside an archive url; null where there are too few parts."""
    parts = F.split(url, "/")
    rest = F.array_join(F.slice(parts, 6, F.greatest(F.size(parts) - 5, F.lit(0))), "/")
    after = F.when(rest.contains("://"), F.split(rest, "://")[1]).when(rest.contains(":/"), F.split(rest, ":/")[1]).otherwise(rest)
    return F.when(F.size(parts) >= 6, F.split(after, "/")[0])


def is_binary(url: Column, suffixes=BINARY_SUFFIXES) -> Column:
    return F.lower(url).rlike(r"\.(" + "|".join(suffixes) + ")$")


def _join(bases: pa.Array, links: pa.Array) -> pa.Array:
    out = []
    for base, link in zip(bases.to_pylist(), links.to_pylist()):
        try:
            out.append(None if base is None or link is None else urljoin(base, link))
        except ValueError:
            out.append(None)
    return pa.array(out, pa.string())


def join_url(base: Column, link: Column) -> Column:
    """A relative link against its page's url; null where it can't be resolved."""
    return F.arrow_udf(_join, "string")(base, link)


def _parts(base: Column) -> tuple[Column, Column, Column]:
    parts = F.split(base, "/")
    prefix = F.array_join(F.slice(parts, 1, 5), "/")
    inner = F.array_join(F.slice(parts, 6, F.greatest(F.size(parts) - 5, F.lit(0))), "/")
    return prefix, inner, (F.size(parts) >= 6) & base.contains("web.archive.org")


def resolve_link(href: Column, base: Column, excluded) -> Column:
    """The archive url of a same-site link of an archived page; null for links that aren't followed."""
    prefix, inner, archived = _parts(base)
    link = F.trim(href)
    bare = F.replace(archived_domain(base), F.lit("www."), F.lit(""))
    skipped = (link == "") | link.startswith("#") | link.startswith("mailto:") | link.startswith("javascript:")
    for domain in excluded:
        skipped = skipped | link.contains(domain)
    absolute = link.startswith("http://") | link.startswith("https://")
    domain = F.replace(F.split(F.split(link, "://")[1], "/")[0], F.lit("www."), F.lit(""))
    relative = ~skipped & ~link.contains("web.archive.org") & archived & ~absolute
    joined = join_url(F.when(relative, inner), F.when(relative, link))
    return (
        F.when(skipped | bare.isNull() | (bare == ""), None)
        .when(link.contains("web.archive.org"), F.when(link.contains(bare), link))
        .when(~archived, None)
        .when(absolute, F.when(domain.contains(bare), F.concat(prefix, F.lit("/"), link)))
        .otherwise(F.concat(prefix, F.lit("/"), joined))
    )


def resolve_frame(src: Column, base: Column) -> Column:
    """The archive url of a frame of an archived page."""
    prefix, inner, archived = _parts(base)
    halves = F.split(src, "//")
    rest = F.array_join(F.slice(halves, 2, F.greatest(F.size(halves) - 1, F.lit(0))), "//")
    full, half = src.contains("web.archive.org"), src.contains("web/20")
    relative = ~full & ~half & archived
    joined = join_url(F.when(relative, inner), F.when(relative, src))
    return (
        F.when(full, F.concat(F.lit("https://"), rest))
        .when(half, F.concat(F.lit("https://web.archive.org"), F.when(src.startswith("/"), "").otherwise("/"), src))
        .when(archived, F.concat(prefix, F.lit("/"), joined))
        .otherwise(src)
    )
