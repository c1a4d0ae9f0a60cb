"""Chat formatting by columnar byte assembly.

Turns are range-partitioned and sorted by conversation and turn, so even a conversation that holds much
of the table is spread over tasks. Within a task, each Arrow batch becomes one output buffer: the
lengths of all segments (header, escaped content, footer of every turn) give cumulative offsets, and
numpy scatter indices copy all headers, contents and footers into one preallocated buffer, which
becomes the data buffer of an Arrow string array without another copy. An output row is a part of a
conversation: its turns of one batch, in order. Parts are numbered in order.

A template has markers around each turn and marks assistant contents as loss. Where a text (or role)
holds a control string of the template, a backslash is put after its first character; backslashes are
doubled. So no control string is left inside a text, and `unescape` restores it exactly.

Null texts and null roles are empty. Turns that are equal in number are ordered by role and text; null
turns come first. A null conv_id is a conversation like others. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.llm.texts import slices


@dataclass(frozen=True)
class Template:
    """`head` + role + `middle` + content + `tail` for each turn; `control` are further reserved strings."""

    head: str = "<s>[TURN] "
    middle: str = "\n"
    tail: str = " [/TURN]</s>\n"
    # Control strings of public chat templates.
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "[TURN]", "[/TURN]")
    trained: tuple[str, ...] = ("assistant",)
    escapes: re.Pattern = field(init=False, compare=False)

    def __post_init__(self):
        strings = "|".join(re.escape(c) for c in self.control)
        # A lookahead finds control strings that overlap, too. Roles end at the first line break, so theirs are escaped.
        object.__setattr__(self, "escapes", re.compile(rf"\\|(?:(?={strings}).)", re.S))

    def escape(self, text: str) -> str:
        return self.escapes.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text

    def escape_role(self, role: str) -> str:
        return self.escape(role).replace("\n", "\\\n")

    @property
    def turn(self) -> re.Pattern:
        """Finds the turns of a formatted text."""
        return re.compile(rf"{re.escape(self.head)}((?:[^\n\\]|\\.)*){re.escape(self.middle)}(.*?){re.escape(self.tail)}", re.S)


def _escaped(column: pa.Array, escape, control: re.Pattern) -> pa.Array:
    """The column with escaped texts; only those that need it leave Arrow."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    touched = pc.match_substring_regex(filled, control.pattern)
    if not pc.any(touched).as_py():
        return filled
    at = np.flatnonzero(touched.to_numpy(zero_copy_only=False))
    changed = pa.array([escape(filled[int(i)].as_py()) for i in at], pa.large_string())
    return pc.replace_with_mask(filled, touched, changed)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, data) of a large string array."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return offsets, data


def assemble(pieces: list[tuple[np.ndarray, np.ndarray]], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave `pieces` (offsets and data, one segment per row): (offset of every segment, output).

    Segment k of row i goes to place i * len(pieces) + k. All lengths are known before anything is
    copied; each piece is then copied by one gather and one scatter.
    """
    k = len(pieces)
    lengths = np.zeros(rows * k, np.int64)
    for j, (offsets, _) in enumerate(pieces):
        lengths[j::k] = np.diff(offsets)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    out = np.empty(int(ends[-1]) if rows else 0, np.uint8)
    for j, (offsets, data) in enumerate(pieces):
        own = lengths[j::k]
        total = int(own.sum())
        inside = np.arange(total) - np.repeat(np.cumsum(own) - own, own)
        out[np.repeat(starts[j::k], own) + inside] = data[np.repeat(offsets[:-1], own) + inside]
    return np.append(starts, ends[-1] if rows else 0), out


def _constant(text: str, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The same segment for each row: all rows share one copy of its bytes."""
    raw = text.encode()
    return np.arange(rows + 1) * len(raw), np.tile(np.frombuffer(raw, np.uint8), rows)


def format_batch(roles: pa.Array, texts: pa.Array, template: Template) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the five segments of every turn, formatted bytes of all turns)."""
    rows = len(texts)
    special = re.compile("|".join(["\\\\", *map(re.escape, template.control)]))
    role_special = re.compile(special.pattern + "|\n")
    return assemble([
        _constant(template.head, rows), _bytes(_escaped(roles, template.escape_role, role_special)), _constant(template.middle, rows),
        _bytes(_escaped(texts, template.escape, special)), _constant(template.tail, rows),
    ], rows)


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, part, n_turns, formatted, loss_starts, loss_ends (code points of `formatted`) by part."""
    chosen = turns.select("conv_id", "turn", "role", "text")
    ordered = chosen.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("task", F.spark_partition_id())
    trained = list(template.trained)
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for part in slices(batches, 3, 4 << 20):
            rows = part.num_rows
            conv, role = part.column(0), part.column(2)
            offsets, out = format_batch(role, part.column(3), template)
            # A part begins wherever the conversation changes.
            ids = conv.to_pylist()
            first = [i for i in range(rows) if i == 0 or ids[i] != ids[i - 1]]
            edges = np.array([*first, rows])
            formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets[edges * 5].astype(np.int64)), pa.py_buffer(out)).cast(pa.string())
            # Code points before a byte: bytes that do not continue a character.
            points = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))
            mask = pc.fill_null(pc.is_in(role, pa.array(trained, role.type)), False).to_numpy(zero_copy_only=False)
            base = np.repeat(points[offsets[edges[:-1] * 5]], np.diff(edges))
            begin, end = points[offsets[3 : 5 * rows : 5]] - base, points[offsets[4 : 5 * rows : 5]] - base
            kept = np.concatenate(([0], np.cumsum(mask)))[edges].astype(np.int32)
            task = part.column(4)[0].as_py()
            yield pa.RecordBatch.from_arrays([
                conv.take(pa.array(first)), pa.array([(task << 32) + number + k for k in range(len(first))], pa.int64()),
                pa.array(np.diff(edges), pa.int64()), formatted,
                pa.ListArray.from_arrays(pa.array(kept), pa.array(begin[mask], pa.int64())), pa.ListArray.from_arrays(pa.array(kept), pa.array(end[mask], pa.int64())),
            ], names=["conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_ends"])
            number += len(first)

    return ordered.mapInArrow(run, f"conv_id {kind}, part bigint, n_turns bigint, formatted string, loss_starts array<bigint>, loss_ends array<bigint>")


def read_back(parts: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of every conversation, parsed from its formatted parts.

    Parts of a conversation are read in order as a stream: a digest of running state is kept, never
    the conversation.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "formatted", "loss_starts", "loss_ends")
    turn = template.turn
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def finished() -> dict:
            return dict(zip(names, [state["id"], state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["length"]]))

        for part in slices(batches, 1):
            done = []
            for row in part.to_pylist():
                if state is None or state["id"] != row["conv_id"]:
                    if state is not None:
                        done.append(finished())
                    state = {"id": row["conv_id"], "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "length": 0}
                text, at = row["formatted"], 0
                for m in turn.finditer(text):
                    if m.start() != at:
                        raise ValueError("a formatted conversation holds something beside its turns")
                    at = m.end()
                    role, content = template.unescape(m[1]), template.unescape(m[2])
                    state["turns"].update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
                    state["n"] += 1
                if at != len(text):
                    raise ValueError("a formatted conversation ends in the middle of a turn")
                for a, b in zip(row["loss_starts"], row["loss_ends"]):
                    content = template.unescape(text[a:b])
                    state["chars"] += len(content)
                    state["loss"].update(content.encode("utf-8", "surrogatepass"))
                state["length"] += len(text)
            yield pa.RecordBatch.from_pylist(done, schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([finished()], schema=schema)

    digests = T._parse_datatype_string(f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    schema = to_arrow_schema(digests)
    return ordered.mapInArrow(run, digests)
