"""Chat formatting with a grammar round trip.

A conversation is the concatenation of its rendered turns:

    user       [INST]text[/INST]
    assistant  <s>text</s>
    system     <<SYS>>text<</SYS>>
    any other  [ROLE]role[/ROLE]text[/TURN]

A deterministic parser (one state, no look-ahead past a control string)
reads it back.  A turn is first rendered raw, then parsed; if the parser
does not give back exactly its role and text, a backslash is put before
what conflicts, and if that were not enough before every special
character, until the round trip is identical.  A turn that parses alone from
and to the start state parses alike inside a conversation, so turns are
rendered in parallel; when a conversation is read back, each rendered turn
is parsed alone once more, so turn borders come from the rows.

Scale: rows are hash-partitioned by conversation, sorted within the
partition and streamed; no conversation is held in memory as a whole.

Defined results: null text and null role count as empty; turns are
ordered by (turn, role, text), null turn first, so repeated rows stay as
repeated turns; rows with a null conv_id form one conversation; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template's control strings, by role.
OPEN = {"user": "[INST]", "assistant": "<s>", "system": "<<SYS>>"}
CLOSE = {"user": "[/INST]", "assistant": "</s>", "system": "<</SYS>>"}
ROLE_OPEN, ROLE_CLOSE, TURN_CLOSE = "[ROLE]", "[/ROLE]", "[/TURN]"
CONTROL = (*OPEN.values(), *CLOSE.values(), ROLE_OPEN, ROLE_CLOSE, TURN_CLOSE)
ESCAPE = "\\"
SPECIAL = "\\<["

_CONTROL = "|".join(re.escape(c) for c in CONTROL)
_TOKEN = re.compile(r"\\([\\<\[])|(" + _CONTROL + ")", re.S)
#: What would be read as markup: a control string, an escape pair, an escape at the end.
_CONFLICT = re.compile(r"\\(?=[\\<\[]|\Z)|(?=" + _CONTROL + ")")


def escape(text: str, level: int) -> str:
    """Level 0: as it is; 1: a backslash before what conflicts; 2: before
    every special character."""
    if level == 0:
        return text
    if level == 1:
        return _CONFLICT.sub(lambda m: ESCAPE + m.group(), text)
    return re.sub(r"[\\<\[]", lambda m: ESCAPE + m.group(), text)


class Parser:
    """Reads a rendered conversation turn by turn; raises ValueError on text
    that the grammar does not have."""

    def turns(self, rendered: str) -> Iterator[tuple[str, str, int, int]]:
        """(role, text, start, end) of each turn; start and end are the code
        points of the escaped text within ``rendered``."""
        at, role, parts, start, stop = 0, None, [], 0, None
        closing = {v: k for k, v in OPEN.items()}
        for m in _TOKEN.finditer(rendered):
            lead, at0 = rendered[at:m.start()], at
            at = m.end()
            if stop is None:  # between turns only an opening may stand
                if lead or m.group(2) is None or m.group(2) not in (*closing, ROLE_OPEN):
                    raise ValueError(f"no turn starts at {at0}")
                role = closing.get(m.group(2))
                stop = CLOSE[role] if role else ROLE_CLOSE
                parts, start = [], at
                continue
            parts.append(lead)
            if m.group(1) is not None:
                parts.append(m.group(1))
            elif m.group(2) != stop:
                raise ValueError(f"{m.group(2)} inside a turn at {m.start()}")
            elif stop == ROLE_CLOSE:
                role, stop, parts, start = "".join(parts), TURN_CLOSE, [], at
            else:
                yield role, "".join(parts), start, m.start()
                stop = None
        if stop is not None or at != len(rendered):
            raise ValueError("text ends inside a turn")


def render_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """(rendered turn, start and end of the escaped text in it, escape level)."""
    for level in (0, 1, 2):
        body = escape(text, level)
        if role in OPEN:
            head, tail = OPEN[role], CLOSE[role]
        else:
            head, tail = ROLE_OPEN + escape(role, level) + ROLE_CLOSE, TURN_CLOSE
        rendered = head + body + tail
        try:
            if list(Parser().turns(rendered)) == [(role, text, len(head), len(head) + len(body))]:
                return rendered, len(head), len(head) + len(body), level
        except ValueError:
            pass
    raise AssertionError("the fully escaped turn does not parse back")


def _turns(conversations: DataFrame) -> DataFrame:
    """The rows, a conversation's rows together and in order."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    return rows.repartition(n, "conv_id").sortWithinPartitions(*order)


FORMATTED = ("conv_id bigint, turn bigint, role string, rendered string, loss_start bigint, "
             "loss_end bigint, level int, place bigint")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per turn, in order within a conversation (rows of one
    conversation lie together in one partition): ``rendered`` (the formatted
    conversation is their concatenation), the span under the loss mask
    (``loss_start``, ``loss_end``: code points within ``rendered`` of the
    escaped text of assistant turns; null for others), the escape ``level`` that
    the round trip needed, and the turn's ``place`` in its conversation (from 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place = object(), 0
        for b in batches:
            cols = b.to_pydict()
            places = []
            for conv in cols["conv_id"]:
                last, place = conv, place + 1 if conv == last else 0
                places.append(place)
            out = [render_turn(r, t) for r, t in zip(cols["role"], cols["text"], strict=True)]
            loss = [r == "assistant" for r in cols["role"]]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(cols["turn"], pa.int64()), b.column(2),
                pa.array([x[0] for x in out], pa.string()),
                pa.array([x[1] if m else None for x, m in zip(out, loss, strict=True)], pa.int64()),
                pa.array([x[2] if m else None for x, m in zip(out, loss, strict=True)], pa.int64()),
                pa.array([x[3] for x in out], pa.int32()), pa.array(places, pa.int64())],
                names=["conv_id", "turn", "role", "rendered", "loss_start", "loss_end", "level", "place"])

    return _turns(conversations).mapInArrow(run, FORMATTED)


DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint, escaped_turns bigint")


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read from its rendered turns alone: number and
    digest of the parsed turns, length and digest of the unescaped text under
    the loss mask, formatted length, turns that needed escapes.  ``formatted``
    is the output of :func:`format_conversations` in its own row order; rows
    that have been moved since are an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in DIGESTS.split(", ")]
        state = None

        def flush(s: dict) -> list:
            return [s["id"], s["n"], s["turns"].hexdigest(), s["chars"], s["loss"].hexdigest(),
                    s["len"], s["escaped"]]

        def batch(rows: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

        for b in batches:
            done = []
            c = b.to_pydict()
            for conv, text, lo, hi, place in zip(c["conv_id"], c["rendered"], c["loss_start"], c["loss_end"], c["place"], strict=True):
                expected = 0 if state is None or state["id"] != conv else state["rows"]
                if place != expected:
                    raise ValueError(f"conversation {conv}: turn {place} stands where turn {expected} belongs")
                if state is None or state["id"] != conv:
                    if state is not None:
                        done.append(flush(state))
                    state = {"id": conv, "n": 0, "turns": hashlib.sha256(), "chars": 0,
                             "loss": hashlib.sha256(), "len": 0, "escaped": 0, "rows": 0}
                state["rows"] += 1
                state["len"] += len(text)
                for role, body, start, end in Parser().turns(text):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{body}\n".encode())
                    state["escaped"] += len(body) != end - start
                if lo is not None:
                    masked = _TOKEN.sub(lambda m: m.group(1) or m.group(2), text[lo:hi])
                    state["chars"] += len(masked)
                    state["loss"].update(masked.encode())
            if done:
                yield batch(done)
        if state is not None:
            yield batch([flush(state)])

    return formatted.mapInArrow(run, DIGESTS)
