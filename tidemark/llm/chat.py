"""Chat formatting by columnar byte assembly.

A conversation becomes one text: for each turn a header, the escaped content and a footer. For a whole
batch of turns the lengths of all segments are computed in numpy, their cumulative sums give every
segment's place, and headers, contents and footers are scattered into one preallocated Arrow buffer.
The loss mask is a list of character spans: the content of every assistant turn.

Escaping: a backslash becomes two, and a control string gets a backslash after its first character, so
that no control string is left inside a content or role; both undo by dropping each backslash before
the character it precedes. No control string holds a space and all segments meet at a space or line
end, so none can form across a seam.

Defined results: null text or role is empty; turns are ordered by turn (null first), then role, then
text; rows repeated in a conversation are turns of it; rows with a null conversation id form one
conversation; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bound_batches, flat, packed, shuffle_parts, tidy

# The template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
FRAMES = {
    "user": ("<s>[INST] ", " [/INST]\n"),
    "assistant": ("<s> ", " </s>\n"),
    "system": ("<s><<SYS>> ", " <</SYS>>\n"),
}
OTHER = ("<s>[ROLE] ", " [/ROLE] ", " </s>\n")
LOSS_ROLE = "assistant"

TURN = re.compile(
    r"<s>\[INST\] (?P<user>.*?) \[/INST\]\n|<s><<SYS>> (?P<system>.*?) <</SYS>>\n"
    r"|<s>\[ROLE\] (?P<role>.*?) \[/ROLE\] (?P<other>.*?) </s>\n|<s> (?P<assistant>.*?) </s>\n",
    re.DOTALL,
)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def breaks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places before which a backslash goes, sorted."""
    found = [np.flatnonzero(data == 0x5C)]
    end = np.repeat(offsets[1:], np.diff(offsets))
    for control in CONTROLS:
        code = control.encode()
        at = np.flatnonzero(data[: max(0, len(data) - len(code) + 1)] == code[0])
        for k in range(1, len(code)):
            at = at[data[at + k] == code[k]]
        found.append(at[at + len(code) <= end[at]] + 1)
    return np.sort(np.concatenate(found), kind="stable")


def escaped(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = breaks(data, offsets)
    out = np.insert(data, at, 0x5C)
    return out, offsets + np.searchsorted(at, offsets)


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + sizes[i] of all i, one after the other."""
    end = np.cumsum(sizes)
    return np.repeat(starts - (end - sizes), sizes) + np.arange(end[-1] if len(end) else 0)


def assemble(first: np.ndarray, roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, list[list[dict]]]:
    """Formatted conversations and loss spans; ``first`` holds the first turn of each, and the number of turns."""
    content, limits = escaped(*flat(texts))
    kinds = roles.fill_null("").dictionary_encode()
    names = kinds.dictionary.to_pylist()
    heads, tails = [], []
    for name in names:
        head, tail = FRAMES.get(name, (None, None))
        if head is None:
            raw = np.frombuffer(name.encode(), np.uint8)
            own = escaped(raw, np.array([0, len(raw)]))[0].tobytes().decode()
            head, tail = OTHER[0] + own + OTHER[1], OTHER[2]
        heads.append(head.encode())
        tails.append(tail.encode())
    role = kinds.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    frames = np.frombuffer(b"".join(heads) + b"".join(tails), np.uint8)
    head_sizes = np.array([len(x) for x in heads], dtype=np.int64)
    tail_sizes = np.array([len(x) for x in tails], dtype=np.int64)
    head_at = np.cumsum(head_sizes) - head_sizes
    tail_at = head_sizes.sum() + np.cumsum(tail_sizes) - tail_sizes

    turns = len(role)
    sizes = np.empty((turns, 3), dtype=np.int64)
    sizes[:, 0], sizes[:, 1], sizes[:, 2] = head_sizes[role], np.diff(limits), tail_sizes[role]
    place = np.zeros(3 * turns + 1, dtype=np.int64)
    np.cumsum(sizes.ravel(), out=place[1:])
    out = np.empty(place[-1], dtype=np.uint8)
    starts = place[:-1].reshape(turns, 3)
    out[runs(starts[:, 0], sizes[:, 0])] = frames[runs(head_at[role], sizes[:, 0])]
    out[runs(starts[:, 1], sizes[:, 1])] = content
    out[runs(starts[:, 2], sizes[:, 2])] = frames[runs(tail_at[role], sizes[:, 2])]

    begin = place[3 * first]
    chars = np.zeros(len(out) + 1, dtype=np.int64)
    np.cumsum((out & 0xC0) != 0x80, out=chars[1:])
    lossy = np.flatnonzero(np.array([n == LOSS_ROLE for n in names], dtype=bool)[role]) if turns else np.zeros(0, np.int64)
    owner = np.searchsorted(first, lossy, "right") - 1
    a = chars[starts[lossy, 1]] - chars[begin[owner]]
    b = a + chars[starts[lossy, 1] + sizes[lossy, 1]] - chars[starts[lossy, 1]]
    spans: list[list[dict]] = [[] for _ in range(len(first) - 1)]
    for k, x, y in zip(owner.tolist(), a.tolist(), b.tolist()):
        spans[k].append({"start": x, "end": y})
    return packed(out, np.diff(begin), pa.large_string()), spans


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_conversations(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Per conversation: id, ``formatted`` text and ``loss_spans`` (character ranges in it).

    Turns are dealt by conversation and sorted inside partitions; a task holds a batch and the turns of
    the conversation that the batch breaks off, which is no more than one output row.
    """
    bound_batches(df.sparkSession)
    rows = df.select(
        F.col(conv_col).alias("c"), F.col(turn_col).alias("n"), F.coalesce(role_col, F.lit("")).alias("r"),
        F.coalesce(text_col, F.lit("")).alias("t"),
    )
    rows = rows.repartition(shuffle_parts(df.sparkSession), "c").sortWithinPartitions("c", "n", "r", "t")

    def emit(turns: pa.Table) -> pa.RecordBatch:
        turns = turns.combine_chunks()
        ids = turns.column("c").to_pylist()
        first = np.array([k for k, c in enumerate(ids) if not k or c != ids[k - 1]] + [len(ids)], dtype=np.int64)
        one = lambda name: pa.concat_arrays(turns.column(name).chunks)
        texts, spans = assemble(first, one("r"), one("t"))
        own = pa.array([ids[k] for k in first[:-1]], turns.schema.field("c").type)
        return pa.RecordBatch.from_arrays(
            [own, texts.cast(pa.string()), pa.array(spans, ARROW_SPANS)], names=[conv_col, "formatted", "loss_spans"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in tidy(batches):
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_pylist()
            cut = len(ids)
            while cut and ids[cut - 1] == ids[-1]:
                cut -= 1
            if held and held[-1].column(0)[-1].as_py() != ids[0]:
                yield emit(pa.Table.from_batches(held))
                held = []
            if cut:
                yield emit(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield emit(pa.Table.from_batches(held))

    fields = [T.StructField(conv_col, df.schema[conv_col].dataType)]
    fields += [T.StructField("formatted", T.StringType()), T.StructField("loss_spans", SPANS)]
    return rows.mapInArrow(run, T.StructType(fields))


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        at = m.end()
        if m["role"] is not None:
            out.append((unescape(m["role"]), unescape(m["other"])))
        else:
            out.append((m.lastgroup, unescape(m[m.lastgroup])))
    return out


def read_loss(formatted: str, spans: list) -> str:
    """The text under the loss mask, unescaped."""
    return "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans or ())
