"""Chat formatting: a finite-state machine over roles, a declarative template, loss flags per segment.

Rows of a conversation meet in one partition in the order of their turns and stream through the formatter,
which holds one turn at a time; no conversation is gathered. A conversation's digests are sequential, so its rows pass
one task: README.md says how fast. Each turn gives three segments: the marker that
opens it, its text, and the marker that closes it. Only text of the roles with ``loss`` is under the loss
mask. Texts are escaped, so that no text can open or close a turn, and ``read_back`` gives the texts again.

Defined cases: null text counts as empty; null role as the empty role, which no state accepts; a role out
of order (or unknown) keeps its turn in the output but marks it, and the conversation, as invalid;
rows with equal turns are ordered by role, then text, and both stay; a null conversation id is a conversation; a turn is
held whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.shared import texts


ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Markers, loss flags and allowed orders of turns. ``open`` has the role's name where ``{role}`` stands.

    What a text may not hold bare follows from the markers: without the spaces at their ends, they and what could begin one at
    the text's end are preceded by ``ESCAPE``, as is ``ESCAPE`` itself. Any markers will do that have something besides spaces and no
    ``ESCAPE``; others are a ValueError.
    """

    open: str = "### {role}: "
    close: str = " </turn>\n"
    names: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"})
    loss: tuple = ("assistant",)
    #: state -> role -> next state; a conversation may end in any of ``final``.
    moves: dict = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user", "tool": "tool"},
        "tool": {"assistant": "assistant", "tool": "tool"},
    })
    final: tuple = ("user", "assistant")

    def __post_init__(self):
        if self.open.count("{role}") != 1 or not self.name_end.strip() or not self.close.strip() or ESCAPE in self.open + self.close:
            raise ValueError("a template needs {role} once, a marker after it and one at the end, and no escape in them")
        if len(set(self.names.values())) < len(self.names) or any(n.startswith("(") for n in self.names.values()):
            raise ValueError("names of roles must differ and not begin with a parenthesis")

    @property
    def name_begin(self) -> str:
        return self.open.partition("{role}")[0]

    @property
    def name_end(self) -> str:
        return self.open.partition("{role}")[2]

    @cached_property
    def _bare(self) -> tuple[re.Pattern, re.Pattern]:
        """Places that get an escape: in texts, and in names."""

        def places(*markers: str) -> re.Pattern:
            cores = [m.strip() for m in markers if m.strip()]
            ends = {c[:k] for c in cores for k in range(1, len(c))}
            return re.compile("(?=" + "|".join([re.escape(ESCAPE), *map(re.escape, cores), *(re.escape(e) + r"\Z" for e in sorted(ends))]) + ")")

        return places(self.name_begin, self.close), places(self.name_begin, self.name_end, self.close)

    def escape(self, text: str) -> str:
        return self._bare[0].sub(lambda m: ESCAPE, text)

    def unescape(self, text: str) -> str:
        return re.sub(re.escape(ESCAPE) + r"([\s\S])", r"\1", text)

    def opener(self, role: str) -> str:
        return self.name_begin + self._bare[1].sub(lambda m: ESCAPE, self.names.get(role, f"({role})")) + self.name_end

    def role(self, name: str) -> str:
        """The role of a name as it stands in an opener."""
        name = self.unescape(name)
        return {v: k for k, v in self.names.items()}.get(name, name[1:-1])


SEGMENTS = "conv_id bigint, turn bigint, ordinal bigint, part int, text string, loss boolean, valid boolean"


def _keys(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def format_chats(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments in output order: (conv_id, turn, ordinal, part, text, loss, valid), three for each turn.

    Sorted within partitions by (conv_id, ordinal, part); each conversation lies in one partition. Concatenated,
    a conversation's segments are its formatted text.
    """
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), texts("text").alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("ordinal", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("loss", pa.bool_()), ("valid", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, ordinal, out = object(), "start", 0, []
        size = 0
        for c, turn, role, text in _keys(batches, "conv_id", "turn", "role", "text"):
            if c != conv:
                conv, state, ordinal = c, "start", 0
            after = template.moves.get(state, {}).get(role)
            valid = after is not None
            state = after if valid else "broken"
            out.append((c, turn, ordinal, 0, template.opener(role), False, valid))
            out.append((c, turn, ordinal, 1, template.escape(text), role in template.loss, valid))
            out.append((c, turn, ordinal, 2, template.close, False, valid))
            ordinal += 1
            size += len(text)
            if len(out) >= 6000 or size > 8_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    return dealt.mapInArrow(run, SEGMENTS)


class Reader:
    """Parses a conversation's formatted text, chunk by chunk, back to (role, text) turns; holds one turn at a time."""

    def __init__(self, template: Template):
        self.template, self.left, self.at, self.name = template, "", 0, None
        #: an escape with what it escapes, or the marker that ends the name; the same for the text
        self.stops = [re.compile(re.escape(ESCAPE) + r"[\s\S]|(" + re.escape(m.strip()) + ")") for m in (template.name_end, template.close)]

    def _until(self, marker: str) -> str | None:
        """What stands before the next bare ``marker``, which is taken off; None if it isn't there yet."""
        pattern = self.stops[0 if self.name is None else 1]
        for m in pattern.finditer(self.left, self.at):
            if m[1] is None:
                self.at = m.end()
                continue
            start = m.start() - (len(marker) - len(marker.lstrip()))
            if start + len(marker) > len(self.left):
                return None
            found, self.left, self.at = self.left[:start], self.left[start + len(marker) :], 0
            return found
        return None

    def feed(self, chunk: str) -> Iterator[tuple[str, str]]:
        self.left += chunk
        while True:
            if self.name is None:
                name = self._until(self.template.name_end)
                if name is None:
                    return
                self.name = self.template.role(name[len(self.template.name_begin) :])
            text = self._until(self.template.close)
            if text is None:
                return
            name, self.name = self.name, None
            yield name, self.template.unescape(text)


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """A row for each conversation, from the formatted segments alone.

    n_turns and turns_sha256 (role, newline, text, newline for each turn) come from parsing the formatted
    text; loss_chars and loss_sha256 from the segments under the mask; formatted_chars counts all.
    """
    dealt = segments.repartition("conv_id").sortWithinPartitions("conv_id", "ordinal", "part")
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, begun = [], None, False

        def ended():
            if reader.left or reader.name is not None:
                raise ValueError(f"conversation {conv} does not end with a whole turn")
            out.append((conv, turns, every.hexdigest(), loss_n, lost.hexdigest(), chars, valid and role in template.final))

        for c, text, loss, ok in _keys(batches, "conv_id", "text", "loss", "valid"):
            if not begun or c != conv:
                if begun:
                    ended()
                    if len(out) >= 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
                        out.clear()
                conv, begun, role = c, True, None
                reader, every, lost = Reader(template), hashlib.sha256(), hashlib.sha256()
                turns = loss_n = chars = 0
                valid = True
            chars += len(text)
            valid = valid and ok
            if loss:
                plain = template.unescape(text)
                loss_n += len(plain)
                lost.update(plain.encode())
            for role, said in reader.feed(text):
                turns += 1
                every.update(f"{role}\n{said}\n".encode())
        if begun:
            ended()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    return dealt.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean")
