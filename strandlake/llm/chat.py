"""Chat formatting by event sourcing.

A log holds events of conversations: whole messages, streamed deltas, edits, regenerations, deletions.
Each conversation's events come sorted to one fold, which keeps one conversation in memory; the final messages
are rendered in a template whose control strings can't be forged by a text.

Events (EVENTS): ``message`` begins a message (its id may be null: it can't be changed later); ``delta`` appends to the message of
its id, beginning it where needed; ``edit`` replaces its text; ``regenerate`` replaces its text and drops every later
message; ``delete`` drops it. Unknown ids in edit, regenerate and delete are ignored, as are unknown kinds.

Cases: null text or role = empty; null conversation ids make one conversation of their own; null sequence numbers come first; ties in the
sequence are ordered by kind, id, role and text, so a rerun gives the same; repeated rows count as often as they stand; long texts and long conversations
are held whole, one conversation at a time; an empty log gives no row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

EVENTS = ("conv_id", "seq", "kind", "message_id", "role", "text")
BEGIN, END = "<|im_start|>", "<|im_end|>"
# Control strings of common templates (fixed values): none of them survives inside a text.
CONTROL = (BEGIN, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_PROTECT = re.compile(r"\\|\n|" + "|".join(map(re.escape, CONTROL)))
_OPEN = re.compile(r"\\(.)", re.S)
_TURN = re.compile(re.escape(BEGIN) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
FORMATTED = "conv_id long, n_turns long, formatted string, loss array<struct<start: long, stop: long>>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str, one_line: bool = False) -> str:
    """Backslashes doubled, control strings broken behind their first character by ``\\.``; newlines kept unless ``one_line``."""

    def put(m: re.Match) -> str:
        x = m[0]
        if x == "\\":
            return "\\\\"
        if x == "\n":
            return "\\n" if one_line else x
        return f"{x[0]}\\.{x[1:]}"

    return _PROTECT.sub(put, text)


def unescape(text: str) -> str:
    return _OPEN.sub(lambda m: {"\\": "\\", ".": "", "n": "\n"}[m[1]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the code point ranges of its assistant texts."""
    parts, loss, at = [], [], 0
    for role, text in turns:
        head, body = f"{BEGIN}{escape(role, True)}\n", escape(text)
        if role == "assistant":
            loss.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), loss


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns that ``render`` was given."""
    return [(unescape(role), unescape(body)) for role, body in _TURN.findall(formatted)]


def fold(events) -> list[tuple[str, str]]:
    """Final (role, text) of a conversation from its sorted events (kind, message id, role, text)."""
    messages: list[list] = []  # [id, role, text parts]
    place: dict = {}
    for kind, key, role, text in events:
        text = text or ""
        at = place.get(key) if key is not None else None
        if kind == "message" or (kind == "delta" and at is None):
            if key is not None:
                place[key] = len(messages)
            messages.append([key, role or "", [text]])
        elif kind == "delta":
            messages[at][2].append(text)
        elif at is not None and kind == "edit":
            messages[at][2] = [text]
        elif at is not None and kind == "regenerate":
            messages[at][2] = [text]
            for later in messages[at + 1 :]:
                if later is not None and place.get(later[0], -1) > at:
                    del place[later[0]]
            del messages[at + 1 :]
        elif at is not None and kind == "delete":
            messages[at] = None
            del place[key]
    return [(m[1], "".join(m[2])) for m in messages if m is not None]


def format_conversations(events: DataFrame) -> DataFrame:
    """FORMATTED: one row for each conversation of an event log with the columns EVENTS."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now: object = ...
        held: list[tuple] = []

        def close() -> None:
            turns = fold(held)
            text, loss = render(turns)
            out.append((now, len(turns), text, [{"start": a, "stop": b} for a, b in loss]))

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["conv_id", "n_turns", "formatted", "loss"])
            out.clear()
            return got

        for rows in common.slices(batches, 4):
            for conv, kind, key, role, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if now is ... or conv != now:
                    if now is not ...:
                        close()
                    now, held = conv, []
                held.append((kind, key, role, text))
            if len(out) >= 256:
                yield batch()
        if now is not ...:
            close()
        if out:
            yield batch()

    log = events.select(*(F.col(c) for c in EVENTS)).withColumn("conv_id", F.col("conv_id").cast("long"))
    log = log.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "kind", "message_id", "role", "text")
    return log.select("conv_id", "kind", "message_id", "role", "text").mapInArrow(stream, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """DIGESTS of formatted conversations, from their text and loss ranges alone."""

    def one(text: str, loss: list[dict]) -> tuple:
        turns = parse(text)
        whole, learnt, chars = hashlib.sha256(), hashlib.sha256(), 0
        for role, body in turns:
            whole.update(f"{role}\n{body}\n".encode())
        for span in loss:
            plain = unescape(text[span["start"] : span["stop"]])
            chars += len(plain)
            learnt.update(plain.encode())
        return len(turns), whole.hexdigest(), chars, learnt.hexdigest(), len(text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for b in common.slices(batches, 1):
            rows = [one(t, s) for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            found = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(found, kinds, strict=True))], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(read, DIGESTS)


def turn_events(conversations: DataFrame) -> DataFrame:
    """Rows of whole turns (conv_id, turn, role, text) as a log: each turn is one ``message`` event."""
    return conversations.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), F.lit(None).cast("long").alias("message_id"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))


def streamed_events(conversations: DataFrame) -> DataFrame:
    """Rows of whole turns (conv_id, turn, role, text) as the log that streaming them would have left; its fold gives the turns again.

    An assistant's turn is begun, streamed as a draft, answered by a message that comes too early, regenerated, and streamed again in two deltas; any other
    turn is sent with a slip and edited. Turns count by turn, role and text; each repeated row is a message of its own.
    """
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    said = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("n", rank)
    half = F.floor(F.length("text") / 2).cast("int")

    def event(k: int, kind: str, text: Column, late: int = 0, role: Column | None = None) -> Column:
        key = F.col("n") * 2 + late
        return F.struct((F.col("n") * 8 + k).alias("seq"), F.lit(kind).alias("kind"), key.alias("message_id"), (F.col("role") if role is None else role).alias("role"), text.alias("text"))

    streamed = F.array(
        event(0, "message", F.lit("")), event(1, "delta", F.lit("draft of ")), event(2, "message", F.lit("too early"), 1, F.lit("user")),
        event(3, "regenerate", F.lit("")), event(4, "delta", F.col("text").substr(F.lit(1), half)), event(5, "delta", F.col("text").substr(half + 1, F.length("text"))),
    )
    sent = F.array(event(0, "message", F.concat(F.lit("slip "), F.col("text"))), event(1, "edit", F.col("text")))
    return said.select("conv_id", F.inline(F.when(F.col("role") == "assistant", streamed).otherwise(sent)))
