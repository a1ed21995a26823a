"""Chat formatting with a grammar that is checked by parsing back.

A conversation is written as the string of its turns, one segment each:

    user        [INST] text [/INST]
    assistant   [OUT] text </s>
    system      [SYS] text [/SYS]
    other       [ROLE] role [AS] text </s>

The grammar is deterministic: the opening marker names the form, and the text ends at
the first closing marker of that form. Each rendered turn is parsed back; if the turns
found are not exactly the source turn, its conflicting content is escaped and the turn
is rendered again, until they are identical. Escaping puts a backslash behind the first
character of every control string (also of one that already has backslashes there), and
the parser takes one backslash away, so it is reversible for any text. A segment that
parses back alone also parses back between others, because parsing a segment ends
exactly at its last character.

Segments are the unit of the output (a conversation may have any number of turns), and
the loss mask is the span of the assistant's text in the segment.

Defined results: null text or role is the empty string; turns are ordered by ``turn``
(null first), and rows that share a turn number by their segment; repeated rows are
turns of their own; rows with a null conversation id form one conversation; an empty
table gives no rows; only the four named columns are read, so others never clash.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# opening marker, closing marker by role; other roles name themselves
FORMS = {
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("[OUT] ", " </s>"),
    "system": ("[SYS] ", " [/SYS]"),
}
NAMED, NAME_END, NAMED_END = "[ROLE] ", " [AS] ", " </s>"
OPENING = {form[0]: (role, form[1]) for role, form in FORMS.items()}

_CONTROL = r"(?:/?INST|OUT|/?SYS|ROLE|AS)\]|/?s>"
_ESCAPE = re.compile(r"([\[<])(\\*)(?=" + _CONTROL + ")")
_UNESCAPE = re.compile(r"([\[<])\\(\\*)(?=" + _CONTROL + ")")
_OPEN = re.compile("|".join(map(re.escape, [*OPENING, NAMED])))


class Unparsable(ValueError):
    """The text is no sequence of turns."""


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def render(role: str, text: str, escaped: bool) -> tuple[str, int, int]:
    """A turn's segment and the span of its text in it."""
    if escaped:
        role_text, text = escape(role), escape(text)
    else:
        role_text = role
    if role in FORMS:
        begin, end = FORMS[role]
    else:
        begin, end = NAMED + role_text + NAME_END, NAMED_END
    return begin + text + end, len(begin), len(begin) + len(text)


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """The turns of a rendered string: role, text, and the span of the text in it."""
    turns, at = [], 0
    while at < len(rendered):
        opening = _OPEN.match(rendered, at)
        if not opening:
            raise Unparsable(f"no turn begins at {at}")
        begin = opening.end()
        if opening[0] == NAMED:
            stop = rendered.find(NAME_END, begin)
            if stop < 0:
                raise Unparsable(f"a role without end at {begin}")
            role, closing, begin = unescape(rendered[begin:stop]), NAMED_END, stop + len(NAME_END)
        else:
            role, closing = OPENING[opening[0]]
        end = rendered.find(closing, begin)
        if end < 0:
            raise Unparsable(f"a turn without end at {begin}")
        turns.append((role, unescape(rendered[begin:end]), begin, end))
        at = end + len(closing)
    return turns


def format_turn(role: str, text: str) -> tuple[str, int, int, bool]:
    """The segment, the span of the text in it, and whether escaping was needed."""
    for escaped in (False, True):
        segment, begin, end = render(role, text, escaped)
        try:
            if parse(segment) == [(role, text, begin, end)]:
                return segment, begin, end, escaped
        except Unparsable:
            pass
    raise AssertionError("an escaped turn always parses back")


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, turn, segment, the loss mask (``loss_start``, ``loss_end`` in code
    points of the segment; equal where nothing is learned) and ``escaped``."""
    def run(batches):
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            made = [format_turn(r, t) for r, t in zip(roles, texts, strict=True)]
            learned = np.array([r == "assistant" for r in roles], bool)
            begin = np.array([m[1] for m in made], np.int64)
            end = np.array([m[2] for m in made], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([m[0] for m in made], pa.string()),
                 pa.array(begin), pa.array(np.where(learned, end, begin)),
                 pa.array([m[3] for m in made], pa.bool_())],
                names=["conv_id", "turn", "segment", "loss_start", "loss_end", "escaped"])

    slim = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"),
                        F.col("turn").cast("bigint").alias("turn"),
                        F.coalesce(F.col("role"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return slim.mapInArrow(run, "conv_id bigint, turn bigint, segment string, loss_start bigint, "
                                "loss_end bigint, escaped boolean")


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse the formatted segments and digest each conversation.

    The segments are sorted by conversation and turn and streamed: a task keeps the
    running digests of one conversation, whatever its length. (SHA-256 runs over the
    turns in order, so a conversation's digest can't be split between tasks.)
    """
    def run(batches):
        now, n, turns, loss, loss_chars, chars, out = None, 0, None, None, 0, 0, []

        def close():
            out.append((now[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def flush():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                                              names=RESULT_NAMES)

        for batch in batches:
            out = []
            for conv, segment, begin, end in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        close()
                    now, n, loss_chars, chars = (conv,), 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, text, _, _ in parse(segment):
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode())
                learned = unescape(segment[begin:end])
                loss.update(learned.encode())
                loss_chars += len(learned)
                chars += len(segment)
            yield flush()
        if now is not None:
            out = []
            close()
            yield flush()

    return (formatted.select("conv_id", "segment", "loss_start", "loss_end", "turn")
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
            .drop("turn").mapInArrow(run, RESULT))


RESULT = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
          "loss_sha256 string, formatted_chars bigint")
RESULT_NAMES = [x.split(" ")[0] for x in RESULT.split(", ")]
