"""Chat formatting from event logs.

A log has rows (conversation, turn, sequence, event, role, text). Events:

    message     a new message with its whole text (a log may repeat a turn: each is a message)
    start       a new, empty message of `role` at `turn`
    delta       `text` is appended to the message at `turn`
    edit        the message's text becomes `text`; later turns logged before this are void
    regenerate  the message's text becomes empty; later turns logged before this are void

Logs are partitioned by conversation and sorted, within each conversation, by turn and by
sequence within a turn. Folding then needs the current message and one number, the highest
sequence of an edit or regeneration at an earlier turn: a conversation of any length is
streamed, never gathered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meterstar.llm.common import in_tasks

# The template (fixed values): <|turn|>role<|text|>text<|end|>, a newline after each turn.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
LEARNT = "assistant"

# Control strings of this and of other common templates never appear raw in a text: a
# backslash goes in after their first character, and a backslash itself is doubled.
CONTROL = re.compile(r"\\|<\||\[/?INST\]|</?s>|<</?SYS>>|\[/?[A-Z_]+\]")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and the span of its text under the loss mask (empty if none)."""
    head = f"{TURN}{escape(role)}{TEXT}"
    body = escape(text)
    start = len(head)
    return f"{head}{body}{END}", start, start + len(body) if role == LEARNT else start


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns in formatted text."""
    for turn in formatted.split(END)[:-1]:
        role, text = turn.removeprefix(TURN).split(TEXT, 1)
        yield unescape(role), unescape(text)


def fold(events: Iterable[tuple]) -> Iterator[tuple]:
    """Final messages (conversation, turn, role, text) of (conversation, turn, sequence,
    event, role, text), sorted by the first three."""
    conversation = turn = message = None
    void_before = pending = None

    def ended():
        if message is not None:
            yield conversation, turn, message[0], "".join(message[1])

    first = True
    for conv, at, sequence, event, role, text in events:
        if first or conv != conversation or at != turn:
            yield from ended()
            message = None
            if first or conv != conversation:
                void_before = pending = None
            elif pending is not None:
                void_before = pending if void_before is None else max(void_before, pending)
            pending = None
            conversation, turn, first = conv, at, False
        if event in ("edit", "regenerate") and sequence is not None:
            pending = sequence if pending is None else max(pending, sequence)
        if void_before is not None and sequence is not None and sequence < void_before:
            continue
        role, text = role or "", text or ""
        if event == "message":
            yield from ended()
            message = (role, [text])
        elif event == "start":
            yield from ended()
            message = (role, [])
        elif event in ("edit", "regenerate"):
            message = (role or (message[0] if message else ""), [text] if event == "edit" else [])
        elif event == "delta":
            message = message or (role, [])
            message[1].append(text)
    yield from ended()


SEGMENT = "conv_id: {kind}, turn: long, position: long, segment: string, loss_start: long, loss_end: long"


def format_log(log: DataFrame) -> DataFrame:
    """The final, formatted turns of `log` (conv_id, turn, sequence, event, role, text).

    One row per turn: its `position` in the conversation, the formatted `segment`, and the
    span of the segment under the loss mask. A conversation's text is its segments in order,
    nothing between. Rows of unknown events are ignored. Null conversations are one
    conversation, null turns come first, null roles and texts are empty, a null sequence
    sorts first and is never void. Events equal in conversation, turn and sequence go by
    event, role and text. Other columns are not looked at.
    """
    kind = log.schema["conv_id"].dataType.simpleString()
    columns = ["conv_id", "turn", "sequence", "event", "role", "text"]
    # Encoding of the final texts is per turn; only this fold follows a conversation.
    ordered = log.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.col("sequence").cast("long").alias("sequence"), "event", "role", "text",
    ).repartition("conv_id").sortWithinPartitions(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out, size, position, last = [], 0, 0, object()
        for conv, turn, role, text in fold(rows()):
            position = position + 1 if conv == last else 0
            last = conv
            out.append((conv, turn, position, *render(role, text)))
            size += len(out[-1][3])
            if size > 1 << 20 or len(out) >= 2000:
                yield _batch(out, conv_type)
                out, size = [], 0
        if out:
            yield _batch(out, conv_type)

    conv_type = to_arrow_type(log.schema["conv_id"].dataType)
    return in_tasks(ordered, run, SEGMENT.format(kind=kind))


def _batch(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    types = [conv_type, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["conv_id", "turn", "position", "segment", "loss_start", "loss_end"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names
    )


def digest(segments: DataFrame) -> DataFrame:
    """Counts and hashes of each conversation, read back from its formatted segments.

    Streams each conversation's segments in order; only running hashes are held.
    """
    kind = segments.schema["conv_id"].dataType.simpleString()
    ordered = segments.select("conv_id", "position", "segment", "loss_start", "loss_end")
    # format_log leaves a conversation in one partition, in order: no second shuffle.

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
        ])
        done, current, state = [], None, None

        def close():
            if state is not None:
                n, turns, chars, loss, length = state
                done.append((current, n, turns.hexdigest(), chars, loss.hexdigest(), length))

        def flush(type_):
            columns = list(zip(*done)) or [[]] * 6
            arrays = [pa.array(columns[0], type_)]
            arrays += [pa.array(c, f.type) for c, f in zip(columns[1:], schema)]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *schema.names])

        type_ = pa.int64()
        for batch in batches:
            type_ = batch.column(0).type
            for conv, position, segment, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or position == 0:
                    close()
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_back(segment):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                masked = unescape(segment[a:b])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(segment)
            if len(done) >= 2000:
                yield flush(type_)
                done.clear()
        close()
        if done:
            yield flush(type_)

    return in_tasks(
        ordered, run,
        f"conv_id: {kind}, n_turns: long, turns_sha256: string, loss_chars: long, "
        "loss_sha256: string, formatted_chars: long",
    )


def log_of_turns(conversations: DataFrame) -> DataFrame:
    """A log for finished conversations (conv_id, turn, role, text): one message per row."""
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.col("turn").cast("long").alias("sequence"), F.lit("message").alias("event"),
        "role", "text",
    )


def format_documents(segments: DataFrame) -> DataFrame:
    """Whole formatted conversations, one row each; only for conversations that fit a row."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "segment")))
    return segments.groupBy("conv_id").agg(
        F.array_join(F.transform(ordered, lambda s: s["segment"]), "").alias("formatted")
    )
