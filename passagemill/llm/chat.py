"""Chat formatting: a finite-state machine over roles and a declarative template of segments with loss flags.

The conversations are partitioned by id and sorted by turn once; a task then streams through them turn by turn, so memory
does not grow with the length of a conversation or the number of turns. What is written is one row per segment; joining
the segments of a conversation in order gives its training text, their flags its loss mask.

Inside texts and roles, ``<`` + any number of ``\\`` + ``|`` gets one more ``\\``, and none is left without: a text holds no
control string, and taking one ``\\`` out of each gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill.llm.shared import store_from_python

_PLAIN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


@dataclass(frozen=True)
class Template:
    """Control strings around a turn, the roles under the loss, and the machine: which roles may follow which state."""

    before: str = "<|im_start|>"
    after_role: str = "\n"
    after: str = "<|im_end|>\n"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    start: str = "start"
    follows: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "start": frozenset({"system", "user"}), "system": frozenset({"user"}),
            "user": frozenset({"assistant"}), "assistant": frozenset({"user"}),
        }
    )
    final: frozenset[str] = frozenset({"assistant"})

    def segments(self, role: str, text: str) -> Iterator[tuple[str, str, bool]]:
        """(kind, text, loss) of one turn."""
        named = escape(role).replace("%", "%%").replace("\n", "%n")  # the role ends at the first newline
        yield "open", self.before + named + self.after_role, False
        yield "text", escape(text), role in self.loss_roles
        yield "close", self.after, False

    def role_of(self, opening: str) -> str:
        named = opening.removeprefix(self.before).removesuffix(self.after_role)
        return unescape(re.sub("%(%|n)", lambda m: "%" if m[1] == "%" else "\n", named))


CHATML = Template()
_SEGMENTS = pa.schema(
    [("conv_id", pa.int64()), ("seq", pa.int64()), ("kind", pa.string()), ("text", pa.string()), ("loss", pa.bool_()), ("turn_ok", pa.bool_()), ("can_end", pa.bool_())]
)
_BUFFER = 4 << 20  # characters of segments handed on at once


def _format(template: Template):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SEGMENTS)], schema=_SEGMENTS)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seq, state, rows, held = object(), 0, template.start, [], 0
        for batch in batches:
            for conv_id, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text"))):
                if conv_id != conv:
                    conv, seq, state = conv_id, 0, template.start
                role = role or ""
                turn_ok = role in template.follows.get(state, ())
                state = role
                for kind, segment, loss in template.segments(role, text or ""):
                    rows.append((conv_id, seq, kind, segment, loss, turn_ok, role in template.final))
                    seq, held = seq + 1, held + len(segment)
                if held >= _BUFFER:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return write


def format_segments(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, seq, kind, text, loss, turn_ok, can_end: the segments of each conversation, stored.

    Needs conv_id (long), turn, role and text, whatever else there is. Rows are taken by turn, then role and text; repeated rows
    are turns of their own. A null text is empty, a null role is the empty role, a null turn comes first; rows without conv_id are
    one conversation. ``turn_ok`` says whether the machine allows the turn after the one before, ``can_end`` whether a
    conversation may end there; conversations with wrong turns are formatted all the same. Empty input: no rows.
    """
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    sorted_turns = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    types = "conv_id long, seq long, kind string, text string, loss boolean, turn_ok boolean, can_end boolean"
    return store_from_python(sorted_turns.mapInArrow(_format(template), types), "segments")


class _Digest:
    """What is read back of one conversation, hashed as it streams by."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.formatted_chars = conv_id, 0, 0, 0
        self.turns, self.loss, self.ok, self.can_end = hashlib.sha256(), hashlib.sha256(), True, False

    def add(self, template: Template, kind: str, text: str, loss: bool, turn_ok: bool, can_end: bool) -> None:
        self.formatted_chars += len(text)
        if kind == "open":
            if not (text.startswith(template.before) and text.endswith(template.after_role)):
                raise ValueError(f"conversation {self.conv_id}: a turn opens with {text[:80]!r}")
            self.n_turns += 1
            self.turns.update((template.role_of(text) + "\n").encode())
        elif kind == "text":
            plain = unescape(text)
            self.turns.update((plain + "\n").encode())
            if loss:
                self.loss.update(plain.encode())
                self.loss_chars += len(plain)
        elif text != template.after:
            raise ValueError(f"conversation {self.conv_id}: a turn closes with {text[:80]!r}")
        self.ok, self.can_end = self.ok and turn_ok, can_end

    def row(self) -> tuple:
        valid = self.ok and self.can_end
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars, valid)


_DIGESTS = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())]
)


def _read(template: Template):
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        for batch in batches:
            done = []
            columns = (batch[c].to_pylist() for c in ("conv_id", "kind", "text", "loss", "turn_ok", "can_end"))
            for conv_id, *segment in zip(*columns):
                if now is None or conv_id != now.conv_id:
                    done += [now.row()] if now else []
                    now = _Digest(conv_id)
                now.add(template, *segment)
            if done:
                yield _digest_batch(done)
        if now:
            yield _digest_batch([now.row()])

    return digests


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _DIGESTS)], schema=_DIGESTS)


def read_segments(segments: DataFrame, template: Template = CHATML) -> DataFrame:
    """Per conversation, from its segments alone: n_turns, digests of its turns and of the text under the loss, sizes, validity.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn), loss_chars, loss_sha256, formatted_chars, valid. A
    turn that does not open or close as the template says is an error.
    """
    in_order = segments.repartition("conv_id").sortWithinPartitions("conv_id", "seq").drop("seq")
    types = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    )
    return store_from_python(in_order.mapInArrow(_read(template), types), "digests")
