"""Benchmark decontamination: rare word n-grams of the test items as seeds, local alignment of what they meet.

Words are runs of ASCII letters and digits and of all bytes beyond ASCII, in lower case, so
punctuation doesn't hide a copy. A seed is one of an item's rarest n-grams by the number of
documents that hold it: the rarer half of the item's n-grams, ties included. That is an
order within the item, so an item that a third of all documents copy still has its seeds.
Each passage around seeds is aligned with the items of these seeds (Smith-Waterman on
words), and the pair counts when the score reaches a share of what the whole item scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgelake.llm.shared import cut_lineage, filled, tune
from forgelake.llm.text import PUNCTUATED, hash_words, ngram_hashes, text_blocks

SEED_WORDS = 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bits of the filter that tells which n-grams can belong to items; what passes is joined exactly.
FILTER_BITS = 23


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local score of two word sequences, and the end (exclusive) in item and passage; the first of equal ones."""
    steps = np.arange(1, len(passage) + 1, dtype=np.int64) * -GAP
    above = np.zeros(len(passage) + 1, dtype=np.int64)
    best, at = 0, (0, 0)
    for i, word in enumerate(item):
        here = np.maximum(above[:-1] + np.where(passage == word, MATCH, MISMATCH), above[1:] + GAP)
        here = np.maximum(here, 0)
        # A gap in the item: the best of all cells to the left, less their distance.
        here = np.maximum.accumulate(here + steps) - steps
        above = np.concatenate([[0], here])
        top = int(here.argmax())
        if here[top] > best:
            best, at = int(here[top]), (i + 1, top + 1)
    return best, *at


def align(item: np.ndarray, passage: np.ndarray, least: float) -> tuple[int, int, int] | None:
    """Score and word span in the passage of the best alignment, if it reaches `least`."""
    score, end_item, end = smith_waterman(item, passage)
    if score < max(least, 1):
        return None
    _, _, back = smith_waterman(item[:end_item][::-1], passage[:end][::-1])
    return score, end - back, end


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, grams = [], []
            for _, _, data, offsets in text_blocks(batch.column(1)):
                hashes, _, _, firsts = hash_words(data, offsets, PUNCTUATED)
                found, index = ngram_hashes(hashes, firsts, SEED_WORDS, whole_if_short=False)
                for i in range(len(offsets) - 1):
                    words.append(hashes[firsts[i] : firsts[i + 1]].tobytes())
                    grams.append(np.unique(found[index[i] : index[i + 1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary()), pa.array(grams, pa.list_(pa.int64()))], names=["item_id", "item_words", "grams"])

    return benchmark.select(F.col(item_col).cast("long").alias("item_id"), filled(text_col)).mapInArrow(run, "item_id long, item_words binary, grams array<long>")


def _bit_filter(grams: DataFrame) -> np.ndarray:
    """2 ** FILTER_BITS bits, set where an n-gram's first bits lie; at most 2 ** 17 rows reach the driver."""
    place = F.shiftrightunsigned("gram", 64 - FILTER_BITS)
    rows = grams.select(F.shiftrightunsigned(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(gram, {64 - FILTER_BITS}) & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for row in rows.collect():
        bits[row["word"]] = row["bits"]
    return np.unpackbits(bits.view(np.uint8), bitorder="little")


def _met(hashes: np.ndarray, firsts: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-grams that pass the filter: hash, text, position in the text."""
    grams, index = ngram_hashes(hashes, firsts, SEED_WORDS, whole_if_short=False)
    at = np.flatnonzero(bits[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    text = np.searchsorted(index, at, side="right") - 1
    return grams[at], text, at - index[text]


def _frequencies(docs: DataFrame, bits) -> DataFrame:
    """gram, df: the documents that hold each n-gram which passes the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def send() -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64), np.empty(0, np.int64))
            return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n, pa.int64())], names=["gram", "df"])

        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(1)):
                hashes, _, _, firsts = hash_words(data, offsets, PUNCTUATED)
                grams, text, _ = _met(hashes, firsts, bits.value)
                pairs = np.unique(np.stack([text.astype(np.uint64), grams], axis=1), axis=0) if len(grams) else np.empty((0, 2), np.uint64)
                held.append(pairs[:, 1])
                size += len(pairs)
                if size > 1_000_000:
                    yield send()
                    held, size = [], 0
        yield send()

    return docs.mapInArrow(run, "gram long, df long").groupBy("gram").agg(F.sum("df").alias("df"))


def _passages(docs: DataFrame, bits, margin: int) -> DataFrame:
    """doc_id, first (word), words, grams: stretches of text around n-grams that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_blocks(batch.column(1)):
                hashes, _, _, firsts = hash_words(data, offsets, PUNCTUATED)
                grams, text, at = _met(hashes, firsts, bits.value)
                if not len(grams):
                    continue
                new = np.concatenate([[True], (text[1:] != text[:-1]) | (at[1:] - at[:-1] > 2 * margin)])
                starts = np.flatnonzero(new)
                ends = np.append(starts[1:], len(at))
                rows, first, words, found = [], [], [], []
                for s, e in zip(starts, ends, strict=True):
                    t = text[s]
                    a, b = max(0, at[s] - margin), min(firsts[t + 1] - firsts[t], at[e - 1] + SEED_WORDS + margin)
                    rows.append(low + t)
                    first.append(a)
                    words.append(hashes[firsts[t] + a : firsts[t] + b].tobytes())
                    found.append(np.unique(grams[s:e]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(first, pa.int64()), pa.array(words, pa.binary()), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "first", "words", "grams"]
                )

    return docs.mapInArrow(run, "doc_id long, first long, words binary, grams array<long>")


def _aligned(pairs: DataFrame, share: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for i, (x, y) in enumerate(zip(batch.column("item_words"), batch.column("words"), strict=True)):
                item, passage = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                if found := align(item, passage, share * MATCH * len(item)):
                    first = batch.column("first")[i].as_py()
                    rows.append(i)
                    out.append((found[0], found[0] / (MATCH * len(item)), first + found[1], first + found[2]))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("doc_id", "item_id")] + [pa.array(columns[k], t) for k, t in enumerate((pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                names=["doc_id", "item_id", "score", "share", "start_word", "end_word"],
            )

    return pairs.select("doc_id", "item_id", "first", "words", "item_words").mapInArrow(run, "doc_id long, item_id long, score long, share double, start_word long, end_word long")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", share: float = 0.5) -> DataFrame:
    """doc_id, item_id, score, share, start_word, end_word: the best alignment of each document with each item it holds.

    Null or empty texts and items match nothing, nor do items of fewer than SEED_WORDS
    words. Items with a null id take part under the null id. Rows that repeat an id count
    as one document, of which the best alignment is given (then the earliest, then the
    shortest). A document with a null id is reported under the null id. Items of any
    number: the filter has a fixed size, and what passes it is joined on its n-gram.
    """
    spark = tune(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), filled(text_col).alias("text"))
    items = cut_lineage(_items(benchmark, item_col, item_text_col).withColumn("item", F.xxhash64("item_id", "item_words")).dropDuplicates(["item"]), "items")
    of_items = items.select("item", F.explode("grams").alias("gram"))
    margin = int(items.agg(F.max(F.length("item_words"))).first()[0] or 0) // 8
    bits = spark.sparkContext.broadcast(_bit_filter(of_items))
    counted = cut_lineage(_frequencies(docs, bits), "frequencies")
    known = of_items.join(counted, "gram", "left").select("item", "gram", F.coalesce("df", F.lit(0)).alias("df"))
    order = Window.partitionBy("item").orderBy("df")
    ranked = known.withColumn("place", F.rank().over(order)).withColumn("n", F.count("*").over(Window.partitionBy("item")))
    seeds = cut_lineage(ranked.where("place <= ceil(n / 2) and df > 0").select("gram", "item"), "seeds")
    seed_bits = spark.sparkContext.broadcast(_bit_filter(seeds))
    passages = _passages(docs, seed_bits, margin).withColumn("passage", F.xxhash64("doc_id", "first", "words"))
    passages = cut_lineage(passages, "passages")
    met = passages.select("passage", F.explode("grams").alias("gram")).join(seeds, "gram").select("passage", "item").distinct()
    pairs = met.join(items.select("item", "item_id", "item_words"), "item").join(passages.drop("grams").dropDuplicates(["passage"]), "passage")
    best = F.struct(-F.col("score"), "start_word", "end_word")
    found = _aligned(pairs, share).groupBy("doc_id", "item_id").agg(F.min_by(F.struct("score", "share", "start_word", "end_word"), best).alias("x"))
    return found.select("doc_id", "item_id", "x.*")
