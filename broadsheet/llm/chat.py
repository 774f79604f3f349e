"""Chat formatting: conversations rebuilt from an event log, then rendered.

Events of a conversation are partitioned by it, sorted by turn and sequence, and
folded in one streaming pass:

* ``message``: the whole text of a turn,
* ``turn``: the same, as a turn of its own even if the number was there before,
* ``delta``: text to append to the turn,
* ``edit``: a new text of the turn; turns after it that came before are void,
* ``regenerate``: the turn starts again empty; later turns that came before are void.

Rendering marks turns as ``<|im_start|>role\\ntext<|im_end|>\\n`` and escapes the
marks inside texts and roles, so that ``parse`` gives back what was folded.  The
output has one row per turn, in order, with its loss mask as offsets in the
conversation; a conversation is the concatenation of its rows, so no task ever
holds more than one message, however long a conversation is.  Null roles and
texts are empty; rows without conversation id form one conversation; events
with equal turn and sequence are taken in the order of kind, role and text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
EVENTS = ["conv_id", "turn", "seq", "kind", "role", "text"]


def escape(text: str) -> str:
    """``text`` without the characters ``<|`` in a row; ``unescape`` reverses it."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A rendered turn and where its text starts and ends in it."""
    head = f"{START}{escape_role(role)}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


class _Fold:
    """Folds the events of one conversation, which come by turn and sequence."""

    def __init__(self, conv: object) -> None:
        self.conv, self.turn, self.parts, self.role = conv, None, None, ""
        self.cut = None  # sequence of the last edit or regeneration of an earlier turn
        self.next_cut = None

    def push(self, turn: object, seq: object, kind: str, role: str | None, text: str | None) -> tuple[str, str] | None:
        done = None
        if turn != self.turn or kind == "turn":
            done = self.flush()
            self.turn, self.cut = turn, self.next_cut
        if self.cut is not None and (seq is None or seq < self.cut):
            return done
        if kind in ("edit", "regenerate"):
            self.next_cut = seq if self.next_cut is None or (seq is not None and seq > self.next_cut) else self.next_cut
        if kind == "delta" and self.parts is not None:
            self.parts.append(text or "")
        else:
            self.parts = [] if kind == "regenerate" else [text or ""]
        if role is not None:
            self.role = role
        return done

    def flush(self) -> tuple[str, str] | None:
        done = None if self.parts is None else (self.role, "".join(self.parts))
        self.parts, self.role = None, ""
        return done


def format_events(events: DataFrame) -> DataFrame:
    """``(conv_id, n, role, formatted, at, loss_start, loss_end)``, one row per turn.

    ``n`` counts the turns of a conversation from 0, ``at`` is where the turn
    begins in it; the loss offsets are null but for assistant turns.  Rows of a
    conversation are in one partition and in order.
    """
    kind = events.schema["conv_id"].dataType
    order = [F.col(c).asc_nulls_first() for c in EVENTS]
    rows = events.select(*EVENTS).repartition("conv_id").sortWithinPartitions(*order)
    schema = f"conv_id {kind.simpleString()}, n long, role string, formatted string, at long, loss_start long, loss_end long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, n, at = None, 0, 0
        out: list[list] = [[] for _ in range(7)]

        def emit(message: tuple[str, str] | None) -> None:
            nonlocal n, at
            if message is None:
                return
            formatted, a, b = render(*message)
            mask = (at + a, at + b) if message[0] == TRAINED else (None, None)
            for column, v in zip(out, (fold.conv, n, message[0], formatted, at, *mask), strict=True):
                column.append(v)
            n, at = n + 1, at + len(formatted)

        def batch_of(kinds: pa.Schema) -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds.types, strict=True)], kinds.names)
            for c in out:
                c.clear()
            return made

        kinds = None
        for batch in batches:
            if kinds is None:
                long, text = pa.int64(), pa.string()
                kinds = pa.schema(list(zip(["conv_id", "n", "role", "formatted", "at", "loss_start", "loss_end"], [batch.schema.types[0], long, text, text, long, long, long], strict=True)))
            for conv, turn, seq, kind_of, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if fold is None or conv != fold.conv:
                    if fold is not None:
                        emit(fold.flush())
                    fold, n, at = _Fold(conv), 0, 0
                emit(fold.push(turn, seq, kind_of, role, text))
            yield batch_of(kinds)
        if fold is not None:
            emit(fold.flush())
            yield batch_of(kinds)

    return rows.mapInArrow(run, schema)


def messages_as_events(conversations: DataFrame) -> DataFrame:
    """A table of whole messages, one per row, as an event log.

    Repeated turns stay turns of their own.
    """
    return conversations.select(
        "conv_id",
        F.col("turn"),
        F.lit(0).cast("long").alias("seq"),
        F.lit("turn").alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of formatted turns."""
    return [(unescape_role(r), unescape(t)) for r, t in TURN.findall(formatted)]


def digests(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: turns, masked texts and lengths of each.

    Streams over the rows in the order ``format_events`` left them in.
    """
    kind = formatted.schema["conv_id"].dataType
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[list] = [[] for _ in names]
        conv, state, any_row, kinds = None, None, False, None

        def close() -> None:
            turns, turns_sha, chars, loss_sha, size = state
            for column, v in zip(done, (conv, turns, turns_sha.hexdigest(), chars, loss_sha.hexdigest(), size), strict=True):
                column.append(v)

        def take() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(done, kinds, strict=True)], names)
            for c in done:
                c.clear()
            return made

        for batch in batches:
            long, text = pa.int64(), pa.string()
            kinds = [batch.schema.types[0], long, text, long, text, long]
            for c, formatted_turn, at, a, b in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if not any_row or c != conv:
                    if any_row:
                        close()
                    conv, any_row = c, True
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parse(formatted_turn):
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                if a is not None:
                    masked = unescape(formatted_turn[a - at : b - at])
                    state[2] += len(masked)
                    state[3].update(masked.encode("utf-8", "surrogatepass"))
                state[4] += len(formatted_turn)
            yield take()
        if any_row:
            close()
            yield take()

    return formatted.select("conv_id", "formatted", "at", "loss_start", "loss_end").mapInArrow(run, schema)
