"""Chat formatting at token level.

A turn becomes [open] role [body] text [close]: role and text are encoded each by itself with a
public vocabulary, and reserved ids above the vocabulary are spliced between them, so no merge
crosses a border and no text can spell a reserved id. In rendered text the reserved ids stand
for control strings. Where a control string occurs in a role or text, after any number of
backslashes, one more backslash is put before it; taking one away restores the text exactly.

Turns are encoded row by row before anything is shuffled. Each row's pieces lie in one flat
array: prefix sums of the piece lengths give the places of the reserved ids, and the running
sum of +1 where an assistant's text starts and -1 where it ends is the loss mask.

A conversation's turns then meet in one sorted partition and are joined in streaming order
into parts of bounded length, so a conversation that holds a third of all rows needs no more
memory than another. Its digest is a chain by nature; only that reads its rows one by one.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelake.llm.shared import filled, tune

#: A public byte-level vocabulary, shipped to the tasks by Spark; another path can be given.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Texts that are encoded at a time, and a part's tokens unless one turn has more.
TEXTS = 256
PART = 1 << 16


@dataclass(frozen=True)
class Template:
    """Control strings and whose texts are learnt. No control string may overlap another or hold a backslash."""

    opened: str = "<turn>"
    body: str = "<text>"
    closed: str = "</turn>"
    learnt: str = "assistant"

    def __post_init__(self):
        def meet(a: str, b: str) -> bool:
            return a in b or any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b))))

        marks = self.marks
        unsound = any(not m or "\\" in m or any(m.endswith(m[:n]) for n in range(1, len(m))) for m in marks)
        if unsound or any(meet(marks[i], marks[j]) for i in range(3) for j in range(3) if i != j):
            raise ValueError("control strings must be non-empty, without backslashes, and may not overlap")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.opened, self.body, self.closed

    @property
    def _marks_pattern(self) -> str:
        return "|".join(map(re.escape, self.marks))

    def escape(self, text: str) -> str:
        """One more backslash before every control string; a text without one is as it was."""
        return re.sub(f"(?={self._marks_pattern})", r"\\", text)

    def unescape(self, text: str) -> str:
        return re.sub(rf"\\(?={self._marks_pattern})", "", text)


def _token_bytes(tokenizer) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary, which writes printable bytes as themselves and the others, in order, from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(0x100 + n): b for n, b in enumerate(hidden)}
    table = [b""] * tokenizer.get_vocab_size()
    for token, number in tokenizer.get_vocab().items():
        table[number] = bytes(byte_of[c] for c in token)
    return table


class Encoder:
    """A public tokenizer and the reserved ids above it, loaded once per worker process."""

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.first = self.tokenizer.get_vocab_size()
        self.bytes = _token_bytes(self.tokenizer) if type(self.tokenizer.decoder).__name__ == "ByteLevel" else None

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        if self.bytes is None:
            return self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return [b"".join(map(self.bytes.__getitem__, piece)).decode("utf-8", "replace") for piece in ids]


def _shipped(spark, path: str) -> Callable[[], str]:
    """Where a task finds the file: Spark sends it to every executor."""
    from pyspark import SparkFiles

    if not os.path.exists(path):
        raise FileNotFoundError(path)
    name = os.path.basename(path)
    spark.sparkContext.addFile(path)
    return lambda: SparkFiles.get(name)


def assemble(roles: list[str], texts: list[str], encoder: Encoder, template: Template) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and mask of all turns in one flat array each, and the border of each turn."""
    turns = len(roles)
    pieces = encoder.encode([template.escape(s) for pair in zip(roles, texts, strict=True) for s in pair])
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)).reshape(turns, 2)
    # Per turn: open, role, body, text, close.
    spans = np.stack([np.ones(turns, np.int64), lengths[:, 0], np.ones(turns, np.int64), lengths[:, 1], np.ones(turns, np.int64)], axis=1)
    ends = np.cumsum(spans).reshape(turns, 5)
    starts = ends - spans
    total = int(ends[-1, -1]) if turns else 0
    ids = np.empty(total, dtype=np.int32)
    reserved = np.zeros(total, dtype=bool)
    for place, mark in ((0, 0), (2, 1), (4, 2)):
        ids[starts[:, place]] = encoder.first + mark
        reserved[starts[:, place]] = True
    ids[~reserved] = np.fromiter(chain.from_iterable(pieces), np.int32, total - 3 * turns)
    change = np.zeros(total + 1, dtype=np.int8)
    mine = np.array([r == template.learnt for r in roles], dtype=bool)
    np.add.at(change, starts[mine, 3], 1)
    np.add.at(change, ends[mine, 3], -1)
    return ids, np.cumsum(change[:-1], dtype=np.int8), np.concatenate([[0], ends[:, 4]]) if turns else np.zeros(1, np.int64)


def _lists(values: np.ndarray, borders: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(values, kind))


def format_conversations(turns: DataFrame, template: Template = Template(), vocabulary: str = VOCABULARY, part_tokens: int = PART) -> DataFrame:
    """conv_id, part (from 0), n_turns, input_ids, loss_mask: the conversations as token sequences.

    A conversation is the rows of one conv_id (null is one too), by turn, nulls first, ties by
    role and text; repeated rows are turns of their own. Null roles and texts count as empty.
    It is cut into parts between turns once a part has `part_tokens` tokens; nearly all have one
    part. The rows of a conversation lie together in a partition, its parts in order, as
    `read_back` needs them. The mask is 1 on the texts of the template's learnt role, 0 on
    roles, reserved ids and other texts. An empty table gives no rows; a text of any length is
    encoded whole. Other columns don't matter.
    """
    spark = tune(turns.sparkSession)
    place = _shipped(spark, vocabulary)
    kind = turns.schema["conv_id"].dataType
    rows = turns.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(place())
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                ids, mask, borders = assemble(some.column("role").to_pylist(), some.column("text").to_pylist(), encoder, template)
                yield pa.RecordBatch.from_arrays([*some.columns[:2], _lists(ids, borders, pa.int32()), _lists(mask, borders, pa.int8())], names=["conv_id", "turn", "input_ids", "loss_mask"])

    turn_kind = turns.schema["turn"].dataType
    arrays = [T.StructField("input_ids", T.ArrayType(T.IntegerType())), T.StructField("loss_mask", T.ArrayType(T.ByteType()))]
    encoded = rows.mapInArrow(encode, T.StructType([T.StructField("conv_id", kind), T.StructField("turn", turn_kind), *arrays]))
    # Of equal turns the ids decide, which are those of role and text.
    ordered = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "input_ids")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, part, open_turns, tokens, ids, mask = None, 0, 0, 0, [], []
        out: list[tuple] = []

        def close() -> None:
            out.append((conv, part, open_turns, np.concatenate(ids), np.concatenate(mask)))

        def send() -> Iterator[pa.RecordBatch]:
            if out:
                borders = np.concatenate([[0], np.cumsum([len(r[3]) for r in out])])
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in out], id_arrow), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.int32()),
                    _lists(np.concatenate([r[3] for r in out]), borders, pa.int32()), _lists(np.concatenate([r[4] for r in out]), borders, pa.int8()),
                ], names=["conv_id", "part", "n_turns", "input_ids", "loss_mask"])
                out.clear()

        id_arrow = None
        for batch in batches:
            id_arrow = batch.schema.field("conv_id").type
            borders = np.concatenate([[0], np.cumsum(batch.column("input_ids").value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat_ids, flat_mask = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("input_ids", "loss_mask"))
            for i, name in enumerate(batch.column("conv_id").to_pylist()):
                if open_turns and name != conv:
                    close()
                    part, open_turns, tokens, ids, mask = 0, 0, 0, [], []
                elif tokens >= part_tokens:
                    close()
                    part, open_turns, tokens, ids, mask = part + 1, 0, 0, [], []
                conv = name
                ids.append(flat_ids[borders[i] : borders[i + 1]])
                mask.append(flat_mask[borders[i] : borders[i + 1]])
                tokens += len(ids[-1])
                open_turns += 1
                if sum(len(r[3]) for r in out[-1:]) >= part_tokens:
                    yield from send()
            yield from send()
        if open_turns:
            close()
        yield from send()

    return ordered.mapInArrow(join, T.StructType([T.StructField("conv_id", kind), T.StructField("part", T.IntegerType()), T.StructField("n_turns", T.IntegerType()), *arrays]))


def read_back(formatted: DataFrame, template: Template = Template(), vocabulary: str = VOCABULARY, sort: bool = False) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read from the tokens.

    Ids are split at the reserved ones, decoded piece by piece and unescaped. The first digest
    is of role, newline, text, newline per turn; the second of all text under the mask, one run
    after the other. `formatted_chars` is the length of the rendered sequence, control strings
    and escapes included. With `sort` the rows are put in order first, as those of a stored
    table need it; those of `format_conversations` lie in order.
    """
    spark = tune(formatted.sparkSession)
    place = _shipped(spark, vocabulary)
    rows = formatted.select("conv_id", "part", "input_ids", "loss_mask")
    if sort:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(place())
        added = np.array([len(m) for m in template.marks])
        state, conv, done, kind = None, None, [], None

        def fresh() -> list:
            return [0, hashlib.sha256(), 0, hashlib.sha256(), 0]

        def result() -> tuple:
            return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        def send() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * 6
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            done.clear()
            return batch

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            names, parts = batch.column("conv_id").to_pylist(), batch.column("part").to_pylist()
            for i in range(batch.num_rows):
                ids, mask = (np.asarray(batch.column(c)[i].values.to_numpy(zero_copy_only=False)) for c in ("input_ids", "loss_mask"))
                if parts[i] == 0:
                    if state is not None:
                        done.append(result())
                    state, conv = fresh(), names[i]
                # A piece is a run between reserved ids or changes of the mask.
                marked = ids >= encoder.first
                starts = np.flatnonzero(np.concatenate([[True], marked[1:] | marked[:-1] | (mask[1:] != mask[:-1])])) if len(ids) else np.empty(0, np.int64)
                pieces = np.split(ids, starts[1:])
                texts = encoder.decode([[] if marked[s] else p.tolist() for s, p in zip(starts, pieces, strict=True)])
                state[4] += int(added[ids[marked] - encoder.first].sum()) + sum(map(len, texts))
                where = 0  # open, body, close
                held = {0: "", 1: "", 2: ""}
                for s, text in zip(starts.tolist(), texts, strict=True):
                    if marked[s]:
                        where = int(ids[s]) - encoder.first
                        if where == 0:
                            held = {0: "", 1: "", 2: ""}
                        elif where == 2:
                            state[0] += 1
                            for name in (0, 1):
                                state[1].update((template.unescape(held[name]) + "\n").encode("utf-8", "surrogatepass"))
                        continue
                    held[where] += text
                    if mask[s]:
                        plain = template.unescape(text)
                        state[2] += len(plain)
                        state[3].update(plain.encode("utf-8", "surrogatepass"))
            if done:
                yield send()
        if state is not None:
            done.append(result())
            yield send()

    out = T.StructType([formatted.schema["conv_id"], *T._parse_datatype_string("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").fields])
    return rows.mapInArrow(read, out)


def render(ids: list[int], template: Template = Template(), vocabulary: str = VOCABULARY) -> str:
    """One token sequence as text, for a look at it."""
    encoder = Encoder.of(vocabulary)
    runs: list = [[]]
    for i in ids:
        if i >= encoder.first:
            runs += [template.marks[i - encoder.first], []]
        else:
            runs[-1].append(i)
    decoded = iter(encoder.decode([r for r in runs if isinstance(r, list)]))
    return "".join(r if isinstance(r, str) else next(decoded) for r in runs)


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns and one more conversation whose texts look like control strings of several templates."""
    said = "\\### Assistant: </turn> ok"
    probe = turns.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe.select(*[F.col(c).cast(turns.schema[c].dataType).alias(c) for c in probe.columns]))


_T = Template()
_ESCAPED = f"regexp_replace({{}}, '({_T._marks_pattern})', '\\\\\\1', 'g')"

#: The same in DuckDB.
SQL = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok')
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = '{_T.learnt}'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = '{_T.learnt}'), '')) as loss_sha256,
  sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + {sum(map(len, _T.marks))})::bigint as formatted_chars
from turns group by conv_id
"""
