"""Chat formatting with a grammar whose round trip is checked turn by turn."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

BEGIN, END = "<|im_start|>", "<|im_end|>"
#: The grammar: turn = BEGIN role "\n" text END "\n". Inside role and text a
#: control string is broken by a mark after its first character.
MARK = "\u200b"
_CONTROL = re.compile(r"<(" + MARK + r"*)(?=\|im_(?:start|end)\|>)")
_ESCAPED = re.compile(r"<" + MARK + r"(" + MARK + r"*)(?=\|im_(?:start|end)\|>)")


def escape(text: str) -> str:
    """Add one mark to every control string, marked ones included, so that
    removing one mark restores any text."""
    return _CONTROL.sub(r"<" + MARK + r"\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1", text)


def _role_out(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def _role_in(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.DOTALL))


def parse(rendered: str) -> list[tuple[str, str]]:
    """The only turns that ``rendered`` can mean; ValueError if it is none. A
    control string always counts: a text cannot hold one."""
    turns, at = [], 0
    while at < len(rendered):
        line, end = rendered.find("\n", at), rendered.find(END + "\n", at)
        if not rendered.startswith(BEGIN, at) or not at < line < end:
            raise ValueError(f"no turn at character {at}")
        role, text = rendered[at + len(BEGIN):line], rendered[line + 1:end]
        if any(x in y for x in (BEGIN, END) for y in (role, text)):
            raise ValueError(f"control string inside the turn at character {at}")
        turns.append((role, text))
        at = end + len(END) + 1
    return turns


def render_turn(role: str, text: str) -> str:
    """One turn. It is written plainly first and read back; only when the
    recovered turn differs is conflicting content escaped. Reading must know
    which it was, so a plain turn whose text or role unescaping would change
    counts as different too."""
    plain = f"{BEGIN}{role}\n{text}{END}\n"
    if _recovered(plain) == [(role, text)]:
        return plain
    safe = f"{BEGIN}{_role_out(role)}\n{escape(text)}{END}\n"
    if _recovered(safe) != [(role, text)]:
        raise ValueError(f"turn does not survive the round trip: {role!r}")
    return safe


def _recovered(rendered: str) -> list[tuple[str, str]] | None:
    try:
        return [(_role_in(r), unescape(t)) for r, t in parse(rendered)]
    except ValueError:
        return None


def read_back(rendered: str) -> list[tuple[str, str]]:
    """Recovered (role, text) turns of a rendered conversation."""
    return [(_role_in(r), unescape(t)) for r, t in parse(rendered)]


def format_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """Rendered turns in order: ``conv_id``, ``place``, ``rendered``, ``loss`` (assistant turn).

    Rows of a conversation are ordered by turn, role, text (nulls first), so
    ties have one order; a null role or text is empty; a null ``conv_id`` is a
    conversation of its own; repeated rows are kept. Conversations are streamed
    from sorted partitions: a task holds a batch of turns, never a whole
    conversation.
    """
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = (rows.repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches):
        last, place = object(), 0
        for batch in batches:
            conv, at, out, loss = batch.column(0).to_pylist(), [], [], []
            for c, r, t in zip(conv, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                place = place + 1 if c == last else 0
                last = c
                at.append(place)
                out.append(render_turn(r, t))
                loss.append(r == "assistant")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.int64()), pa.array(out, pa.string()),
                                              pa.array(loss, pa.bool_())], ["conv_id", "place", "rendered", "loss"])

    return rows.mapInArrow(run, "conv_id long, place long, rendered string, loss boolean")


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.loss_chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str) -> None:
        self.chars += len(rendered)
        for role, text in read_back(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self):
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, what a reader recovers from the rendered text.
    ``formatted`` comes from :func:`format_turns`, whose order it keeps."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        now = None
        for batch in batches:
            done = []
            for conv, rendered in zip(batch.column("conv_id").to_pylist(), batch.column("rendered").to_pylist()):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(rendered)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(now.row(), kinds)], names)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long")
