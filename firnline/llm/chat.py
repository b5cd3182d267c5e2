"""Chat formatting by columnar byte assembly.

A turn is written as ``### role: text</turn>`` and a newline. In roles and texts ``\\``, ``###``, ``</turn>`` and, in roles,
``:`` get a backslash in front, so no text can open or close a turn, and dropping one backslash per pair gives
the text back. A batch of turns is a column of bytes: the lengths of headers, texts and ends give cumulative offsets,
and numpy index arrays scatter all of them into one preallocated buffer, which becomes an Arrow string column.

Conversations are dealt by a hash of their id, sorted by turn inside a task and streamed; only the conversation that
is being written is held. The loss mask holds the spans of the assistant's texts (code points of the output).

Cases: null texts and roles are empty; null turns come first; equal turns are ordered by role, then text, so repeated
rows appear once each; rows with a null id form one conversation; a conversation whose output passes 2 GB, the most an
Arrow string can hold, is an error; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import bounded_batches, text_of

OPEN, MIDDLE, CLOSE = b"### ", b": ", b"</turn>\n"
ASSISTANT = "assistant"
FORMATTED = "conv_id long, formatted string, loss array<struct<start:int,end:int>>"
#: Turns assembled at once.
SLICE = 2_000
TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(texts: pa.Array, role: bool = False) -> pa.Array:
    for mark in ("\\", "###", "</turn>", *([":"] if role else [])):
        texts = pc.replace_substring(texts, mark, "\\" + mark)
    return texts


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def scatter(target: np.ndarray, at: np.ndarray, source: np.ndarray, lengths: np.ndarray) -> None:
    """Copy consecutive segments of ``source`` with these lengths to the places ``at`` of ``target``."""
    ends = np.cumsum(lengths)
    shift = np.repeat(at - (ends - lengths), lengths)
    target[shift + np.arange(len(shift))] = source


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the length of each value."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0]: offsets[-1]], np.diff(offsets)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The buffer of all turns; per turn its bytes, and in code points where its text begins and how long it is,
    and how long the turn is."""
    roles, texts = escaped(roles, role=True), escaped(texts)
    (role_bytes, role_n), (text_bytes, text_n) = column_bytes(roles), column_bytes(texts)
    turn_n = len(OPEN) + role_n + len(MIDDLE) + text_n + len(CLOSE)
    starts = np.cumsum(turn_n) - turn_n
    buffer = np.empty(int(turn_n.sum()), dtype=np.uint8)
    n = len(turn_n)
    fixed = lambda b: (np.tile(np.frombuffer(b, dtype=np.uint8), n), np.full(n, len(b)))
    at = starts
    for data, lengths in (fixed(OPEN), (role_bytes, role_n), fixed(MIDDLE), (text_bytes, text_n), fixed(CLOSE)):
        scatter(buffer, at, data, lengths)
        at = at + lengths
    role_chars = pc.utf8_length(roles).to_numpy(zero_copy_only=False).astype(np.int64)
    text_chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    before = len(OPEN) + role_chars + len(MIDDLE)
    return buffer, turn_n, np.column_stack([before, text_chars]), before + text_chars + len(CLOSE)


def formatted(turns: DataFrame, assistant: str = ASSISTANT) -> DataFrame:
    """(conv_id, formatted, loss): one row per conversation."""
    kind = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()),
                      ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])

    bounded_batches(turns.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id, open_bytes, open_chars, open_loss, started = None, [], 0, [], False

        def closed():
            if sum(map(len, open_bytes)) >= 1 << 31:
                raise ValueError(f"conversation {open_id} is longer than 2 GB when formatted")
            return pa.RecordBatch.from_arrays([
                pa.array([open_id], pa.int64()),
                pa.StringArray.from_buffers(1, pa.py_buffer(np.array([0, sum(map(len, open_bytes))], np.int32).tobytes()),
                                            pa.py_buffer(b"".join(open_bytes))),
                pa.array([open_loss], kind.field("loss").type)], schema=kind)

        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                part = whole.slice(at, SLICE)
                ids, roles, texts = part.column(0), part.column(2), part.column(3)
                buffer, turn_n, spots, turn_chars = assemble(roles, texts)
                known = ids.fill_null(0).to_numpy(zero_copy_only=False)
                missing = ids.is_null().to_numpy(zero_copy_only=False)
                new = np.concatenate([[True], (known[1:] != known[:-1]) | (missing[1:] != missing[:-1])])
                first = np.flatnonzero(new)
                ends = np.append(first[1:], len(turn_n))
                offsets = np.concatenate([[0], np.cumsum(turn_n)])
                chars = np.concatenate([[0], np.cumsum(turn_chars)])
                loss_turn = pc.equal(roles, assistant).to_numpy(zero_copy_only=False)
                for a, b in zip(first.tolist(), ends.tolist()):
                    conv = None if missing[a] else int(known[a])
                    if started and conv != open_id:
                        yield closed()
                        open_bytes, open_chars, open_loss = [], 0, []
                    open_id, started = conv, True
                    for k in (a + np.flatnonzero(loss_turn[a:b])).tolist():
                        start = open_chars + int(chars[k] - chars[a] + spots[k, 0])
                        open_loss.append({"start": start, "end": start + int(spots[k, 1])})
                    open_bytes.append(buffer[offsets[a]: offsets[b]].tobytes())
                    open_chars += int(chars[b] - chars[a])
        if started:
            yield closed()

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        text_of("role").alias("role"), text_of("text").alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(write, FORMATTED)


def parsed(text: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    out, at = [], 0
    while at < len(text):
        m = TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        out.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    return out
