"""Text and name functions as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.values import FOOTER, FOOTER_TEXT, PRIORITY, SEPARATOR, STATES, TOOLBAR_END, Options

#: White space as in Python's str.split and str.strip.
_WORD = r"(?U)[^\s\x1c-\x1f]+"
_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _ENDS, "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("int")


def n_char(text: Column) -> Column:
    return F.length(text).cast("int")


def first_words(text: Column, n: int = 200) -> Column:
    return F.array_join(F.slice(words(F.coalesce(text, F.lit(""))), 1, min(n, 200)), " ")


def title(text: Column) -> Column:
    """Upper case after each non-letter, lower case elsewhere (unlike initcap, also after apostrophes and hyphens)."""
    pieces = F.split(F.lower(text), r"(?<=[^\p{L}])(?=\p{L})|(?<=\p{L})(?=[^\p{L}])")
    return F.array_join(F.transform(pieces, F.initcap), "")


def clean_name(raw: Column) -> Column:
    """``LAST, FIRST "NICK" MIDDLE`` as ``First Middle Last``."""
    plain = F.regexp_replace(F.coalesce(raw, F.lit("")), r"[\"'][A-Za-z]+[\"']", "")
    parts = F.split(plain, ",", 2)
    given = title(F.array_join(words(parts[1]), " "))
    last = title(strip(parts[0]))
    return F.when(F.size(parts) == 2, F.concat(given, F.lit(" "), last)).otherwise(title(F.array_join(words(plain), " ")))


def nickname(raw: Column) -> Column:
    found = F.regexp_extract(raw, r"(?<=\s)[\"']([A-Za-z]+)[\"']", 1)
    return F.when(found != "", title(found))


def state_name(code: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in STATES.items() for x in kv)), F.upper(code))


def strip_toolbar(html: Column) -> Column:
    """What is after the last toolbar marker and before the footer."""
    return strip(F.substring_index(F.substring_index(html, TOOLBAR_END, -1), FOOTER, 1))


def is_archived(html: Column) -> Column:
    return html.contains(TOOLBAR_END) | html.contains(FOOTER_TEXT)


def dedup_segments(segments: Column, max_repeats: int = Options.max_repeats) -> Column:
    """Without segments of five characters or more that occur over ``max_repeats`` times, then without runs of equals.

    Counts come from one sort of the array, so long pages cost n log n.
    """

    def often(ordered: Column) -> Column:
        repeats = F.transform(ordered, lambda x, i: F.when((i >= max_repeats) & (F.length(x) >= 5) & (F.get(ordered, i - max_repeats) == x), x))
        return F.array_distinct(F.filter(repeats, lambda x: x.isNotNull()))

    kept = _bind(_bind(F.array_sort(segments), often), lambda out: F.filter(segments, lambda x: ~F.array_contains(out, x)))
    return _bind(kept, lambda k: F.filter(k, lambda x, i: (i == 0) | (x != F.get(k, i - 1))))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, not once for each element of an inner lambda."""
    return F.transform(F.array(value), use)[0]


def page_text(segments: Column, max_repeats: int = Options.max_repeats) -> Column:
    """Visible text of raw segments: stripped, over two characters, without repeats, joined."""
    long = F.filter(F.transform(segments, strip), lambda x: F.length(x) > 2)
    return F.array_join(dedup_segments(long, max_repeats), SEPARATOR)


def rate_limited(text: Column) -> Column:
    return F.lower(text).contains("too many requests")


def parse_label(answer: Column) -> Column:
    """A labeller's answer as a category: equal to one, else the first (by priority) inside it, else other."""
    low = F.lower(strip(F.coalesce(answer, F.lit(""))))
    out = F.when(low.isin(PRIORITY), low)
    for name in PRIORITY:
        out = out.when(low.contains(name), name)
    return out.otherwise("other")


#: A default for the labeller; {url} and {text} are filled in.
PROMPT = "Name the category of this web page. Categories: " + ", ".join(PRIORITY) + ".\nURL: {url}\nText: {text}\nAnswer with one category."


def prompt(url: Column, excerpt: Column, template: str = PROMPT) -> Column:
    text = F.when(F.coalesce(excerpt, F.lit("")) == "", "(no text available)").otherwise(excerpt)
    return F.replace(F.replace(F.lit(template), F.lit("{url}"), url), F.lit("{text}"), text)
