"""Duplicate substrings by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where the top bits of the hash are
zero. The hash depends on the last WINDOW bytes alone, so an insertion moves no boundary
further on than that, and equal passages are cut alike wherever they stand: there is no
least or greatest size that would carry the place of one cut into the next. Chunks are
deduplicated by digest: the first by (doc_id, position) stays.

A chunk that an earlier text has too marks a place in both texts. From there the passage is
followed byte by byte in both directions, so that its ends, which lie inside chunks, are
found exactly, and whole words are counted. The comparison also confirms the digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.shared import cut_lineage, filled, tune
from forgelake.llm.text import mix, raw_texts

#: A boundary every 2 ** MASK_BITS bytes on average.
MASK_BITS = 5
WINDOW = 16
#: Shorter chunks are no marks: chance repeats them.
LEAST_CHUNK = 16
#: Bytes of chunks at one distance that two texts must share before they are compared.
LEAST_MARKS = 32
#: A passage counts from one word more on.
LEAST_WORDS = 50
_GEAR = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_PIECE = 1 << 20


def gear(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of the gear values of the last WINDOW bytes, each shifted by its age; doubling steps instead of a loop."""
    h = _GEAR[data]
    span = 1
    while span < WINDOW:
        older = np.zeros_like(h)
        older[span:] = h[:-span] << np.uint64(span)
        h = h + older
        span *= 2
    return h


def boundaries(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text, its length included."""
    found = []
    for at in range(0, len(data), _PIECE):
        low = max(0, at - WINDOW + 1)
        h = gear(data[low : at + _PIECE])[at - low :]
        found.append(np.flatnonzero((mix(h) >> np.uint64(64 - MASK_BITS)) == 0) + at + 1)
    ends = np.concatenate(found) if found else np.empty(0, np.int64)
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data)).astype(np.int64) if len(data) else ends


def _chunked(docs: DataFrame) -> DataFrame:
    """doc_id, digest, start and length in bytes of each chunk that can be a mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw_texts(batch.column(1))
            rows, digests, starts, sizes = [], [], [], []
            for i in range(batch.num_rows):
                text = data[offsets[i] : offsets[i + 1]]
                ends = boundaries(text)
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
                marks = np.flatnonzero(ends - begins >= LEAST_CHUNK)
                raw = text.tobytes()
                digests += [hashlib.blake2b(raw[s:e], digest_size=8).digest() for s, e in zip(begins[marks].tolist(), ends[marks].tolist(), strict=True)]
                starts.append(begins[marks])
                sizes.append(ends[marks] - begins[marks])
                rows.append(np.full(len(marks), i))
            if digests:
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.concatenate(rows))), pa.array(np.frombuffer(b"".join(digests), np.int64)),
                    pa.array(np.concatenate(starts)), pa.array(np.concatenate(sizes)),
                ], names=["doc_id", "digest", "start", "size"])

    return docs.mapInArrow(run, "doc_id long, digest long, start long, size long")


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _run(equal_from: np.ndarray, other: np.ndarray) -> int:
    """Length of the common beginning of two byte arrays, in growing blocks."""
    n, at, step = min(len(equal_from), len(other)), 0, 64
    while at < n:
        to = min(at + step, n)
        differ = np.flatnonzero(equal_from[at:to] != other[at:to])
        if len(differ):
            return at + int(differ[0])
        at, step = to, step * 2
    return n


def whole_words(text: np.ndarray, start: int, end: int) -> int:
    """Words of the text that lie wholly in text[start:end]."""
    solid = ~_SPACE[text[max(0, start - 1) : end + 1]]
    first = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]])) + max(0, start - 1)
    last = np.flatnonzero(solid & ~np.concatenate([solid[1:], [False]])) + max(0, start - 1) + 1
    return int(((first >= start) & (last <= end)).sum())


def passages(text: np.ndarray, first: np.ndarray, marks: list[tuple[int, int, int]], least_words: int, same: bool) -> list[tuple[int, int, int, int]]:
    """(start, end, start in the first text, words) of the passages around marks (start, size, start in the first text).

    A mark inside a passage found before adds nothing. In one and the same text a passage may
    not run into its own source.
    """
    found: list[tuple[int, int, int, int]] = []
    reached = 0
    for start, size, other in sorted(marks):
        if start + size <= reached or not np.array_equal(text[start : start + size], first[other : other + size]):
            continue
        room = start - other if same else len(text)
        back = _run(text[:start][::-1], first[:other][::-1])
        end = start + size + _run(text[start + size :], first[other + size :])
        begin, end = start - back, end if not same else min(end, start - back + room)
        words = whole_words(text, begin, end)
        if words > least_words:
            found.append((begin, end, begin - (start - other), words))
            reached = max(reached, end)
    return found


def _extended(pairs: DataFrame, least_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i in range(batch.num_rows):
                doc, other = batch.column("doc_id")[i].as_py(), batch.column("first_doc_id")[i].as_py()
                text, first = (np.frombuffer(batch.column(c)[i].as_py() or b"", np.uint8) for c in ("text", "first_text"))
                marks = [(m["start"], m["size"], m["first_start"]) for m in batch.column("marks")[i].as_py()]
                out += [(doc, *p[:2], other, *p[2:]) for p in passages(text, first, marks, least_words, doc == other)]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "end", "first_doc_id", "first_start", "n_words"])

    return pairs.mapInArrow(run, "doc_id long, start long, end long, first_doc_id long, first_start long, n_words long")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, start, end, first_doc_id, first_start, n_words: passages that an earlier document, or an earlier place, has too.

    A passage has more than `least_words` whole words and is as long as both texts agree.
    Offsets are bytes of the UTF-8 text. The first document is the one with the smallest id that
    has one of the passage's chunks; passages shared with several are a row for each. The first
    occurrence itself is no row: it stays. Null and empty texts have no chunks. Rows of one id are
    one document (its texts are compared one by one). Rows with a null id come after all others;
    they are compared with earlier documents, and named null. Every text is read whole; where two
    ids repeat a chunk by chance, the comparison finds no passage. A text that repeats one short
    period has a boundary in each period or in none, so it is cut into chunks too short to be
    marks, or not at all: repeats of such a period are not found, copies of the whole text are.
    """
    tune(docs.sparkSession)
    # A null id stands behind all ids inside.
    last = F.lit((1 << 63) - 1)
    named = docs.select(F.coalesce(F.col(id_col).cast("long"), last).alias("doc_id"), filled(text_col).alias("text"))
    chunks = _chunked(named)
    seen = chunks.groupBy("digest").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    later = chunks.join(seen, "digest").where("doc_id <> first.doc_id or start <> first.start").distinct()
    marks = later.select("doc_id", F.col("first.doc_id").alias("first_doc_id"), F.struct("start", "size", F.col("first.start").alias("first_start")).alias("mark"))
    # Chunks at one distance in both texts; then all distances of a pair together.
    apart = marks.groupBy("doc_id", "first_doc_id", (F.col("mark.start") - F.col("mark.first_start")).alias("distance")).agg(
        F.collect_list("mark").alias("marks"), F.sum("mark.size").alias("bytes")
    ).where(F.col("bytes") >= LEAST_MARKS)
    pairs = cut_lineage(apart.groupBy("doc_id", "first_doc_id").agg(F.flatten(F.collect_list("marks")).alias("marks")), "marks")
    texts = named.select("doc_id", F.col("text").cast("binary").alias("text"))
    firsts = texts.join(pairs.select(F.col("first_doc_id").alias("doc_id")).distinct(), "doc_id", "left_semi").select(F.col("doc_id").alias("first_doc_id"), F.col("text").alias("first_text"))
    met = pairs.join(firsts, "first_doc_id").join(texts, "doc_id")
    found = _extended(met, least_words).distinct()
    known = lambda c: F.when(F.col(c) < last, F.col(c)).alias(c)
    return found.select(known("doc_id"), "start", "end", known("first_doc_id"), "first_start", "n_words")
