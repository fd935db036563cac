"""Conversations as one marked text each, with the characters that count for the loss.

A turn is written as `<|turn|>` role `<|text|>` text `<|end|>`. Control strings inside roles and
texts are broken by a backslash after their first character, and backslashes are doubled, so a
text can never end a turn and is restored exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.session import ship

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Strings that chat models read as control, besides the three above.
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
           "<|endoftext|>", "<|startoftext|>")
CONTROL = (TURN, TEXT, END, *FOREIGN)
PART_ROWS, PART_BYTES, LONG = 4096, 16 << 20, 1 << 16

_TURN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.S)
_ESCAPED = re.compile(r"\\(\\?)")


def escape(column: pa.Array) -> pa.Array:
    """The whole column at once; nulls become empty."""
    column = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), "\\", "\\\\")
    for control in CONTROL:
        column = pc.replace_substring(column, control, control[0] + "\\" + control[1:])
    return column


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a string column, and where each value starts and how long it is."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held, at[:-1], np.diff(at)


def assemble(roles: pa.Array, texts: pa.Array, firsts: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Marked texts of the parts that begin at the rows `firsts`, and each row's text span.

    All segments lie in one source buffer; their lengths give the place of each in the output, and
    one gather fills the preallocated output. Segments longer than LONG are copied as slices, so the
    index stays small. Spans are (start, end) in code points from the start of the part.
    """
    n = len(roles)
    role_bytes, role_at, role_n = _parts(roles)
    text_bytes, text_at, text_n = _parts(texts)
    marks = [np.frombuffer(m.encode(), np.uint8) for m in (TURN, TEXT, END)]
    source = np.concatenate([*marks, role_bytes, text_bytes])
    mark_at = np.cumsum([0, *map(len, marks)])
    start = np.empty((n, 5), np.int64)
    length = np.empty((n, 5), np.int64)
    for column, mark in ((0, 0), (2, 1), (4, 2)):
        start[:, column], length[:, column] = mark_at[mark], len(marks[mark])
    start[:, 1], length[:, 1] = mark_at[3] + role_at, role_n
    start[:, 3], length[:, 3] = mark_at[3] + len(role_bytes) + text_at, text_n
    start, length = start.ravel(), length.ravel()
    ends = np.cumsum(length)
    begins = ends - length
    total = int(ends[-1]) if n else 0
    out = np.empty(total, np.uint8)
    short = length <= LONG
    lengths = length[short]
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(begins[short], lengths) + inside] = source[np.repeat(start[short], lengths) + inside]
    for i in np.flatnonzero(~short):
        out[begins[i]:ends[i]] = source[start[i]:start[i] + length[i]]
    rows = begins.reshape(n, 5)[:, 0]
    offsets = np.append(rows[firsts], total).astype(np.int64)
    marked = pa.Array.from_buffers(
        pa.large_string(), len(firsts), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
    # A code point begins at every byte that is not a continuation byte.
    points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
    part = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, n)))
    base = points[offsets[part]]
    text_begins = begins.reshape(n, 5)[:, 3]
    return marked, points[text_begins] - base, points[text_begins + length.reshape(n, 5)[:, 3]] - base


def format_conversations(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", loss_role: str = "assistant",
) -> DataFrame:
    """(conversation, part, n_turns, formatted, loss): marked texts and loss spans in code points.

    Turns are ordered by turn, then role and text, nulls first. Null texts and roles are empty;
    rows whose conversation is null form one conversation; repeated rows are repeated turns; other
    columns are left behind. Turns stream through sorted partitions: a conversation of more than
    PART_ROWS turns or PART_BYTES gives several parts, numbered from 0, whose texts follow each
    other, so no conversation has to fit in memory.
    """
    ship(turns.sparkSession)
    kind = turns.schema[conversation].dataType.simpleString()
    ordered = (
        turns.select(F.col(conversation).alias("conversation"), F.col(turn).alias("turn"),
                     F.col(role).cast("string").alias("role"), F.col(text).alias("text"))
        .repartition("conversation").sortWithinPartitions("conversation", "turn", "role", "text")
        .select("conversation", "role", "text")
    )
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def emit(table: pa.Table, firsts: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
        roles = table.column("role").combine_chunks()
        marked, begins, ends = assemble(escape(roles), escape(table.column("text").combine_chunks()), firsts)
        counts = np.diff(np.append(firsts, len(table)))
        lossy = np.asarray(pc.fill_null(pc.equal(roles, loss_role), False).to_numpy(zero_copy_only=False))
        spans = pa.StructArray.from_arrays(
            [pa.array(begins[lossy]), pa.array(ends[lossy])], fields=list(span))
        kept = np.add.reduceat(lossy.astype(np.int64), firsts)
        offsets = pa.array(np.concatenate([[0], np.cumsum(kept)]).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [table.column("conversation").combine_chunks().take(pa.array(firsts)), pa.array(parts),
             pa.array(counts), marked.cast(pa.string()), pa.ListArray.from_arrays(offsets, spans)],
            names=["conversation", "part", "n_turns", "formatted", "loss"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = None, 0

        def cut(table: pa.Table, last: bool):
            """Batches of whole conversations or full parts, and the rows that wait for more."""
            nonlocal part
            ids = table.column("conversation").to_pylist()
            sizes = pc.fill_null(pc.binary_length(table.column("text")), 0).to_numpy()
            firsts, parts, rows, size = [], [], 0, 0
            for i, (one, n_bytes) in enumerate(zip(ids, sizes, strict=True)):
                new = i == 0 or one != ids[i - 1]
                if new or rows >= PART_ROWS or size >= PART_BYTES:
                    part = (part if i == 0 else 0) if new else part + 1
                    firsts.append(i)
                    parts.append(part)
                    rows = size = 0
                rows, size = rows + 1, size + int(n_bytes)
            end = len(ids) if last else firsts[-1]
            keep = len(firsts) if last else len(firsts) - 1
            done = emit(table.slice(0, end), np.array(firsts[:keep]), np.array(parts[:keep], np.int32)) \
                if end else None
            part = parts[-1]
            return done, table.slice(end)

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            done, held = cut(held, last=False)
            if done is not None:
                yield done
        if held is not None and len(held):
            yield cut(held, last=True)[0]

    return ordered.mapInArrow(run, (
        f"conversation {kind}, part int, n_turns long, formatted string,"
        " loss array<struct<start:long,stop:long>>")).withColumnRenamed("conversation", conversation)


def read_back(formatted: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """What the marked texts say: turns, text under the loss mask, and their hashes.

    Expects the parts of a conversation next to each other and in order, as the operator gives them.
    """
    ship(formatted.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: list | None = None

        def row(c: list) -> tuple:
            return c[0], c[1], c[2].hexdigest(), c[3], c[4].hexdigest(), c[5]

        for batch in batches:
            out = []
            for conv, part, marked, loss in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part == 0:
                    if current is not None:
                        out.append(row(current))
                    current = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for match in _TURN.finditer(marked):
                    current[1] += 1
                    current[2].update(f"{unescape(match[1])}\n{unescape(match[2])}\n".encode())
                for at in loss:
                    masked = unescape(marked[at["start"]:at["stop"]])
                    current[3] += len(masked)
                    current[4].update(masked.encode())
                current[5] += len(marked)
            yield _digests(out, batch.schema.field(0).type)
        if current is not None:
            yield _digests([row(current)], None)

    def _digests(rows: list[tuple], kind) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        types = [kind or id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["conversation", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                   "formatted_chars"])

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(formatted.schema[conversation].dataType)
    kind = formatted.schema[conversation].dataType.simpleString()
    return formatted.select(conversation, "part", "formatted", "loss").mapInArrow(run, (
        f"conversation {kind}, n_turns long, turns_sha256 string, loss_chars long,"
        " loss_sha256 string, formatted_chars long")).withColumnRenamed("conversation", conversation)
