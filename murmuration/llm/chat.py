"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation:

    conversation = { turn }
    turn         = opening body closing
    user         "[INST] " .. " [/INST]"            assistant  "<s> " .. " </s>"
    other roles  "<<role:NAME>> " .. " <</role>>"

A body is the text itself, ended by the first closing mark of its role. If the reparsed turn
differs from its source, because the text holds that mark, the turn is written again with
control strings escaped, which its opening shows by a backslash before the blank:
"[INST]\\ ". In an escaped body a backslash stands before every control string and every
backslash of the text. If a turn still differed, formatting would fail. The grammar
is deterministic: the next characters decide which rule applies.

Turns end on their own, so a conversation parses as its turns do, one after the other. Turns are streamed in
order and never held together: one conversation may hold a large part of all rows.

Edge cases: a null text counts as empty, a null role as the empty role; turns with equal numbers are
ordered by role and text; turns without number come first; conversations without id are one conversation; repeated
rows are turns of their own; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.sources.scratch import Scratch

# The marks of the template.
USER, ASSISTANT = ("[INST]", " [/INST]"), ("<s>", " </s>")
NAMED = ("<<role:", ">>", " <</role>>")
CONTROL = ("[INST]", "[/INST]", "<s>", "</s>", "<<role:", "<</role>>", "\\")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(" + "|".join(map(re.escape, CONTROL)) + ")")
_NAME = re.compile(r"[\\>\s]")


class Malformed(ValueError):
    """A text that the grammar does not produce."""


def _marks(role: str) -> tuple[str, str]:
    if role == "user":
        return USER
    if role == "assistant":
        return ASSISTANT
    name = _NAME.sub(lambda m: f"\\{ord(m.group()):x};", role)
    return NAMED[0] + name + NAMED[1], NAMED[2]


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _written(role: str, text: str, escaped: bool) -> str:
    opening, closing = _marks(role)
    return opening + ("\\ " + escape(text) if escaped else " " + text) + closing


def parse_turn(text: str, at: int = 0) -> tuple[str, str, int, int, int]:
    """(role, text, body start, body end, end) of the turn that starts at ``at``."""
    if text.startswith(USER[0], at):
        role, (opening, closing) = "user", USER
        start = at + len(opening)
    elif text.startswith(ASSISTANT[0], at):
        role, (opening, closing) = "assistant", ASSISTANT
        start = at + len(opening)
    elif text.startswith(NAMED[0], at):
        end = text.find(NAMED[1], at)
        if end < 0:
            raise Malformed(f"no end of a role at {at}")
        role = re.sub(r"\\([0-9a-f]+);", lambda m: chr(int(m.group(1), 16)), text[at + len(NAMED[0]) : end])
        start, closing = end + len(NAMED[1]), NAMED[2]
    else:
        raise Malformed(f"no turn at {at}")
    escaped = text.startswith("\\ ", start)
    if not escaped and not text.startswith(" ", start):
        raise Malformed(f"no body at {start}")
    start += 2 if escaped else 1
    end = text.find(closing, start)
    if end < 0:
        raise Malformed(f"no end of the turn at {at}")
    body = text[start:end]
    return role, unescape(body) if escaped else body, start, end, end + len(closing)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of all turns of a formatted conversation."""
    at, turns = 0, []
    while at < len(text):
        role, body, _, _, at = parse_turn(text, at)
        turns.append((role, body))
    return turns


def _returns(written: str, role: str, text: str) -> bool:
    try:
        found = parse_turn(written)
    except Malformed:
        return False
    return found[:2] == (role, text) and found[4] == len(written)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, start and end of its body)."""
    for escaped in (False, True):
        written = _written(role, text, escaped)
        if _returns(written, role, text):
            _, _, start, end, _ = parse_turn(written)
            return written, start, end
    raise Malformed(f"a turn of role {role!r} does not survive the round trip")


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn, in order of ``seq`` within conv_id: formatted, loss_start, loss_end.

    Laid end to end, the turns of a conversation are its formatted text. The loss span
    covers the body of an assistant turn (null for others), in code points of the turn.
    """
    schema = "conv_id long, seq long, formatted string, loss_start int, loss_end int"

    def write(batches):
        last, seq = object(), 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                seq = seq + 1 if conv == last else 0
                last = conv
                written, start, end = format_turn(role, text)
                rows.append((conv, seq, written, *((start, end) if role == "assistant" else (None, None))))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32())
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "seq", "formatted", "loss_start", "loss_end"])

    plain = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(write, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from its formatted turns alone: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def read(batches):
        state = None

        def closed():
            conv, n, turns, chars, loss, length = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), length

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            done = []
            for conv, text, a, b in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")), strict=True):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(closed())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body, start, _, end = parse_turn(text)
                if end != len(text):
                    raise Malformed("more than one turn in a row")
                state[1] += 1
                state[2].update(f"{role}\n{body}\n".encode())
                if a is not None:
                    masked = text[a:b]
                    masked = unescape(masked) if text[start - 2 : start] == "\\ " else masked
                    state[3] += len(masked)
                    state[4].update(masked.encode())
                state[5] += len(text)
            if done:
                yield table(done)
        if state is not None:
            yield table([closed()])

    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(read, schema)


def format_and_check(conversations: DataFrame) -> DataFrame:
    """Write the formatted turns to the shared folder and read them back."""
    scratch = Scratch(conversations.sparkSession, "chat")
    return read_back(scratch.put(format_turns(conversations), "formatted"))


def with_trial(conversations: DataFrame) -> DataFrame:
    """The conversations plus number -7, whose turns consist of control strings."""
    trial = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string"
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(trial)


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, CASE role WHEN 'user' THEN ' [/INST]' WHEN 'assistant' THEN ' </s>' ELSE ' <</role>>' END AS closing,
         CASE role WHEN 'user' THEN 6 WHEN 'assistant' THEN 3 ELSE 9 + length(role) END + 1 AS opening
  FROM turns
), sized AS (
  SELECT *, opening + length(closing) + length(text)
         + CASE WHEN strpos(text || closing, closing) = length(text) + 1 THEN 0
                ELSE 1 + len(regexp_extract_all(text, '\[INST\]|\[/INST\]|<s>|</s>|<<role:|<</role>>|\\')) END AS chars
  FROM marked
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
