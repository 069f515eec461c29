"""Secret scans: known key formats, and sliding-window Shannon entropy over candidate strings.

Base kinds (leftmost, non-overlapping for each kind, too short matches dropped):
``assign``, ``access``, ``hex``. The entropy scan adds the other ``KINDS``: for each
candidate string of at least ``WINDOW`` characters, a window moves over it while the counts of its
characters are kept up to date, so a step costs two count changes whatever the window's length. Each window has the
class of its own characters and is measured by that class's threshold; windows that read as words are passed over. The
others at or above the threshold are merged to spans, named by the widest class in them. The allow-list takes its own parts
out of a candidate (a digest, or the run of letters and digits around a word), and the rest is measured. Spans inside
a base span are suppressed; base spans always stay.

Defined cases: null and empty texts have no spans; whole texts are read, in time in proportion to their length; equal
texts get equal spans; other columns pass through untouched, but one of the name of ``into`` (a parameter) gives way.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.shared import no_nulls, release, slices, texts

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_letters", "entropy_base32", "entropy_base36", "entropy_mixed", "entropy_base64")

#: Characters in the window, and bits per character at which a window counts as random, for each class (narrowest first):
#: some 2.3 to 3 standard deviations below the expected entropy of 20 characters drawn from 16, 26, 32, 36, 52 and 64.
WINDOW = 20
THRESHOLDS = {"entropy_hex": 3.0, "entropy_letters": 3.25, "entropy_base32": 3.4, "entropy_base36": 3.45, "entropy_mixed": 3.65, "entropy_base64": 3.7}
HEX_ONLY = re.compile(r"[0-9a-fA-F]+\Z")
#: Pairs of letters that are common in words of languages in Latin script: most pairs in prose, a fifth of random ones.
PAIRS = frozenset(
    "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra "
    "ce li ch ll be ma si om ur ca el ta la ns di fo ho pe ec pr no ct us ac ot il tr ly nc et ut ss so rs un lo wa ge ie wh ee "
    "wi em ad ol rt po we na ul ni ts mo ow pa im mi ai sh ir su id os iv ia am fi ci vi pl ig tu ev ld ry mp fe bl ab gh ty op "
    "wo sa ay ex ke ui fr oo ag ei sc au ck qu ue do da iz za "
    "if ff fa ft ls ud ah hr pf up sp ov zu ru gr br kt eu".split()
)

#: Parts of a candidate that look random but are public by their form.
ALLOW = (
    re.compile(r"(?<![^/=])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![^/=])"),  # UUIDs
    *(  # integrity digests, of their own length in hexadecimal or base64
        re.compile(rf"(?<![A-Za-z0-9])(?i:{name})[-=](?:[0-9a-fA-F]{{{size * 2}}}(?![A-Za-z0-9])|[A-Za-z0-9+/_-]{{{-(-size * 4 // 3)}}}(?:={{1,2}}|(?![A-Za-z0-9+/_-])))")
        for name, size in (("md5", 16), ("sha1", 20), ("sha256", 32), ("sha384", 48), ("sha512", 64))
    ),
)
#: Words and alphabets that make the run of letters and digits around them public.
ALLOW_WORDS = re.compile(r"(?i)example|sample|dummy|placeholder|changeme|your[_-]?(?:api)?[_-]?key|abcdefghij|0123456789|zyxwvutsrq")
RUN = re.compile(r"[A-Za-z0-9]*")
#: A cheap superset of all that can match, for a linear-time regex engine.
MAY_MATCH = r"(?i:passw(or)?d|secret|token|api_?key)|AKIA[A-Z0-9]{16}|[0-9a-f]{24}|[A-Za-z0-9+/_=\-]{20}"
#: Bytes of text that a worker looks through at a time, in Python's strings.
SLICE_BYTES = 1_000_000
SECRETS = "array<struct<kind:string,start:int,end:int>>"
SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

_BITS = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def _ends(text: str, threshold: float, width: int = WINDOW) -> Iterator[tuple[int, float]]:
    """(end, entropy) of each window of ``width`` characters whose entropy is at least ``threshold``."""
    bits = _BITS if width == WINDOW else [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    counts: dict[str, int] = {}
    total = 0.0  # sum of c * log2(c); entropy = log2(width) - total / width
    most = (math.log2(width) - threshold) * width + 1e-9
    for i, new in enumerate(text):
        if i >= width:
            old = text[i - width]
            c = counts[old]
            total += bits[c - 1] - bits[c]
            counts[old] = c - 1
        c = counts.get(new, 0)
        total += bits[c + 1] - bits[c]
        counts[new] = c + 1
        if i >= width - 1 and total <= most:
            yield i + 1, math.log2(width) - total / width


def windows(text: str, threshold: float, width: int = WINDOW) -> list[tuple[int, int]]:
    """Merged [start, end) of the windows of ``width`` characters whose entropy is at least ``threshold``."""
    found: list[tuple[int, int]] = []
    for end, _ in _ends(text, threshold, width):
        start = end - width
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], end)
        else:
            found.append((start, end))
    return found


def kind_of(window: str) -> str | None:
    """The character class under which a window is measured; None without a letter."""
    if window.upper() == window.lower():
        return None
    if HEX_ONLY.match(window):
        return "entropy_hex"
    if not window.isalnum():
        return "entropy_base64"
    one_case = window.isupper() or window.islower()
    if window.isalpha():
        return "entropy_letters" if one_case else "entropy_mixed"
    if one_case:
        return "entropy_base36" if any(c in "0189" for c in window) else "entropy_base32"
    return "entropy_base64"


def reads_as_words(window: str, kind: str) -> bool:
    """True where more than half of the pairs of neighbouring letters, at least four of them, are common in words.

    Never of ``entropy_hex``, whose six letters make few words, nor of mixed case with a digit, which words seldom have.
    """
    lower = window.lower()
    if kind == "entropy_hex" or (kind == "entropy_base64" and window not in (lower, window.upper()) and any("0" <= c <= "9" for c in window)):
        return False
    pairs = [a + b for a, b in zip(lower, lower[1:]) if a.isalpha() and b.isalpha()]
    return len(pairs) >= 4 and sum(p in PAIRS for p in pairs) * 2 > len(pairs)


def random_spans(candidate: str) -> list[tuple[str, int, int]]:
    """Merged (kind, start, end) of the windows that are random for their own class and do not read as words."""
    found: list[tuple[str, int, int]] = []
    for end, entropy in _ends(candidate, min(THRESHOLDS.values())):
        start = end - WINDOW
        window = candidate[start:end]
        kind = kind_of(window)
        if kind is None or entropy < THRESHOLDS[kind] - 1e-9 or reads_as_words(window, kind):
            continue
        if found and start <= found[-1][2]:
            found[-1] = (max(found[-1][0], kind, key=KINDS.index), found[-1][1], end)
        else:
            found.append((kind, start, end))
    return found


def not_public(candidate: str) -> list[tuple[int, int]]:
    """[start, end) of the parts of a candidate that the allow-list leaves."""
    public = [m.span() for a in ALLOW for m in a.finditer(candidate)]
    last = 0
    for m in ALLOW_WORDS.finditer(candidate):
        if m.end() > last:
            start = m.start()
            while start > last and candidate[start - 1].isalnum():
                start -= 1
            last = RUN.match(candidate, m.end()).end()
            public.append((start, last))
    left, at = [], 0
    for start, end in sorted(public):
        left.append((at, start))
        at = max(at, end)
    return [(a, b) for a, b in [*left, (at, len(candidate))] if a < b]


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans of one text as (kind, start, end) in code points, by start, then kind as listed."""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    # Entropy spans come by ascending start: one lies in a base span if the furthest end of those begun by then is not before its own.
    base, begun, furthest = sorted((s, e) for _, s, e in spans), 0, 0
    for m in CANDIDATE.finditer(text):
        if m.end() - m.start() < WINDOW:
            continue
        candidate = m.group()
        for a, b in not_public(candidate):
            for kind, start, end in random_spans(candidate[a:b]):
                start, end = start + a + m.start(), end + a + m.start()
                while begun < len(base) and base[begun][0] <= start:
                    furthest, begun = max(furthest, base[begun][1]), begun + 1
                if furthest < end:
                    spans.append((kind, start, end))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _secrets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        batch = no_nulls(batch)
        for a, b in slices(batch, SLICE_BYTES):
            values = batch.slice(a, b - a)
            hits = set(pc.indices_nonzero(pc.match_substring_regex(values, MAY_MATCH)).to_pylist())
            out += [[{"kind": k, "start": s, "end": e} for k, s, e in scan(values[i].as_py())] if i in hits else [] for i in range(len(values))]
        yield pa.array(out, SPAN)
        del out, batch
        release()


def redact(text: str) -> str:
    """The text with each run of overlapping spans replaced by its first kind in angle brackets."""
    parts, at = [], 0
    for kind, start, end in scan(text):
        if end <= at:
            continue
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = end
    return "".join([*parts, text[at:]]) if parts else text


def _redacted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        for a, b in slices(batch, SLICE_BYTES):
            values = batch.slice(a, b - a)
            hits = pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(values, MAY_MATCH), False)).to_pylist()
            if hits:
                mask = np.zeros(len(values), bool)
                mask[hits] = True
                values = pc.replace_with_mask(values, pa.array(mask), pa.array([redact(values[i].as_py()) for i in hits], values.type))
            out.append(values)
        yield pa.concat_arrays(out) if out else batch
        del out, batch
        release()


for _udf in (_secrets, _redacted):
    _udf.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}


def secret_spans(text: Column | str = "text") -> Column:
    """The spans of a text column, ``array<struct<kind, start, end>>``, code points, end exclusive."""
    return F.arrow_udf(_secrets, SECRETS)(F.col(text) if isinstance(text, str) else text)


def find_secrets(df: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """``df`` with its spans in the column ``into``. One pass, no shuffle."""
    return df.withColumn(into, secret_spans(texts(text)))


def redact_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with each secret in ``text`` replaced by its kind in angle brackets; null stays null, no row goes."""
    return df.withColumn(text, F.arrow_udf(_redacted, "string")(F.col(text)))


def digest(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def secrets_report(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row for each row of ``df``: counts of the base kinds, the base spans' SHA-256, and all spans."""
    found = find_secrets(df.select(key, texts(text).alias(text)), text, "secrets").select(key, "secrets")
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda x: x["kind"].isin(*KINDS[:3]))
    return found.select(
        key,
        *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(digest(base), 256).alias("base_sha256"),
        digest(F.col("secrets")).alias("spans"),
        F.size(F.filter("secrets", lambda x: x["kind"].isin(*THRESHOLDS))).cast("long").alias("n_entropy"),
    )
