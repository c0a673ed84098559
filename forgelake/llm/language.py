"""Language identification by unigram models over pieces of a fixed public vocabulary.

Each language has a probability for every piece of a SentencePiece vocabulary. A text is
scored by the sum over all its segmentations into pieces (the forward algorithm), not by
the best one. Segmentations don't cross words, so a word is scored once however often it
occurs; a word of more than UNIT_BYTES bytes counts as several units. The probabilities
come from a few rounds of expectation-maximisation, each one Spark job, over a bounded
sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from forgelake.llm.shared import cut_lineage, filled, tune
from forgelake.llm.text import BASE, VALUE_OF_BYTE, hash_words, mix, text_blocks

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNIT_BYTES = 48
#: Labelled texts of each language that the model learns from, chosen by a hash of the id.
SAMPLE_TEXTS = 1000
#: Learned languages at most; the model holds a number for each of them and each piece.
MAX_LANGUAGES = 1000
ROUNDS = 3
#: Count that every piece has in every language before learning.
PRIOR = 0.01
#: Each byte multiplies the running sums by this, which keeps them in the range of a double.
SCALE = 64.0
_MARK = np.frombuffer("▁".encode(), dtype=np.uint8)
#: Word scores that a worker remembers.
REMEMBERED = 400_000
_CHUNK = 4096


def _powers(base: int, n: int) -> np.ndarray:
    table = np.full(n, base, dtype=np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


class Pieces:
    """The vocabulary as sorted hashes of byte strings; single bytes are always pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = {bytes([b]) for b in range(256)}
        for k in range(model.get_piece_size()):
            if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k)):
                texts.add(model.id_to_piece(k).encode())
        self.lengths = sorted({len(t) for t in texts if len(t) <= UNIT_BYTES})
        self.powers = _powers(BASE, UNIT_BYTES + 1)
        self.inverse = _powers(pow(BASE, -1, 1 << 64), UNIT_BYTES + 1)
        hashes = np.array([self._hash(np.frombuffer(t, np.uint8)) for t in sorted(texts) if len(t) <= UNIT_BYTES], dtype=np.uint64)
        self.hashes = np.unique(hashes)  # upper and lower case have one hash

    def __len__(self) -> int:
        return len(self.hashes)

    def _hash(self, data: np.ndarray) -> np.uint64:
        return mix((VALUE_OF_BYTE[data] * self.powers[: len(data)]).sum(dtype=np.uint64) + np.uint64(len(data)))

    def grid(self, units: np.ndarray, lengths: np.ndarray) -> dict[int, np.ndarray]:
        """For each piece length, the piece (or -1) that starts at each place of each padded unit."""
        n, width = units.shape
        down = self.inverse
        sums = np.zeros((n, width + 1), dtype=np.uint64)
        np.cumsum(VALUE_OF_BYTE[units] * self.powers[:width], axis=1, out=sums[:, 1:])
        out = {}
        for size in self.lengths:
            if size > width:
                break
            raw = (sums[:, size:] - sums[:, : width - size + 1]) * down[: width - size + 1]
            valid = np.arange(width - size + 1)[None, :] + size <= lengths[:, None]
            wanted = mix(raw[valid] + np.uint64(size))
            at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
            found = np.full(raw.shape, -1, dtype=np.int32)
            found[valid] = np.where(self.hashes[at] == wanted, at, -1)
            out[size] = found
        return out


def _forward(grid: dict[int, np.ndarray], shape: tuple[int, int], table: np.ndarray) -> np.ndarray:
    """Scaled sums over all segmentations of each prefix: unit x place x language; the last row of the table is zero."""
    n, width = shape
    sums = np.zeros((n, width + 1, table.shape[1]))
    sums[:, 0] = 1
    for end in range(1, width + 1):
        for size, found in grid.items():
            if size > end:
                break
            piece = found[:, end - size]
            rows = np.flatnonzero(piece >= 0)
            if len(rows):
                sums[rows, end] += sums[rows, end - size] * table[piece[rows]] * SCALE**size
    return sums


def unit_scores(pieces: Pieces, units: np.ndarray, lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Natural log probability of each unit in each language."""
    out = np.empty((len(units), table.shape[1]))
    order = np.argsort(lengths, kind="stable")
    for at in range(0, len(units), _CHUNK):
        own = order[at : at + _CHUNK]
        width = int(lengths[own].max())
        block = units[own, :width]
        sums = _forward(pieces.grid(block, lengths[own]), block.shape, table)
        out[own] = np.log(sums[np.arange(len(own)), lengths[own]]) - lengths[own][:, None] * np.log(SCALE)
    return out


def expected_counts(pieces: Pieces, units: np.ndarray, lengths: np.ndarray, weights: np.ndarray, table: np.ndarray) -> np.ndarray:
    """How often each piece is expected in units of one language (table has one column), by forward and backward sums."""
    total = np.zeros(len(table))
    order = np.argsort(lengths, kind="stable")
    for at in range(0, len(units), _CHUNK):
        own = order[at : at + _CHUNK]
        size_of, width = lengths[own], int(lengths[own].max())
        block = units[own, :width]
        grid = pieces.grid(block, size_of)
        ahead = _forward(grid, block.shape, table)[:, :, 0]
        back = np.zeros((len(own), width + 1))
        back[np.arange(len(own)), size_of] = 1
        whole = ahead[np.arange(len(own)), size_of]
        for start in range(width - 1, -1, -1):
            for size, found in grid.items():
                if start + size > width:
                    break
                piece = found[:, start]
                rows = np.flatnonzero(piece >= 0)
                if len(rows):
                    inner = table[piece[rows], 0] * SCALE**size * back[rows, start + size]
                    back[rows, start] += inner
                    np.add.at(total, piece[rows], weights[own][rows] * ahead[rows, start] * inner / whole[rows])
    return total[:-1]


def _units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as padded units with the word mark in front: bytes, lengths, and the word of each."""
    sizes = ends - starts + len(_MARK)
    parts = (sizes + UNIT_BYTES - 1) // UNIT_BYTES
    word = np.repeat(np.arange(len(starts)), parts)
    nth = np.arange(len(word)) - np.repeat(np.cumsum(parts) - parts, parts)
    low = nth * UNIT_BYTES
    lengths = np.minimum(sizes[word] - low, UNIT_BYTES)
    width = int(lengths.max())
    inside = low[:, None] + np.arange(width)[None, :]
    place = starts[word][:, None] - len(_MARK) + inside
    units = data[np.clip(place, 0, len(data) - 1)]
    units = np.where(inside < len(_MARK), _MARK[np.minimum(inside, len(_MARK) - 1)], units)
    return units, lengths, word


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # piece x language, and a last row of zeros
    vocabulary: str


def _training_units(sample: DataFrame) -> DataFrame:
    """lang, unit, n over the sampled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, data, offsets in text_blocks(batch.column(1)):
                hashes, starts, ends, firsts = hash_words(data, offsets)
                for t in range(len(offsets) - 1):
                    span = slice(firsts[t], firsts[t + 1])
                    if span.stop == span.start:
                        continue
                    _, first, n = np.unique(hashes[span], return_index=True, return_counts=True)
                    units, lengths, word = _units(data, starts[span][first], ends[span][first])
                    values = [units[i, : lengths[i]].tobytes() for i in range(len(units))]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(np.full(len(units), low + t))), pa.array(values, pa.binary()), pa.array(n[word], pa.int64())], names=["lang", "unit", "n"]
                    )

    return sample.select("lang", "text").mapInArrow(run, "lang string, unit binary, n long").groupBy("lang", "unit").agg(F.sum("n").alias("n"))


def _expect(units: DataFrame, model: Model) -> DataFrame:
    """Expected piece counts of each language: lang, counts (an array of doubles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, place = Pieces(model.vocabulary), {x: k for k, x in enumerate(model.languages)}
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array([place[x] for x in batch.column("lang").to_pylist()])
            values = batch.column("unit").to_pylist()
            for k in np.unique(langs):
                rows = np.flatnonzero(langs == k)
                lengths = np.array([len(values[r]) for r in rows])
                block = np.zeros((len(rows), int(lengths.max())), dtype=np.uint8)
                for i, r in enumerate(rows):
                    block[i, : lengths[i]] = np.frombuffer(values[r], np.uint8)
                weights = batch.column("n").to_numpy()[rows].astype(np.float64)
                name = model.languages[k]
                totals[name] = totals.get(name, 0) + expected_counts(pieces, block, lengths, weights, np.ascontiguousarray(model.table[:, k : k + 1]))
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], names=["lang", "counts"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(np.frombuffer(x, dtype=np.float64) for batch in batches for x in batch.column("counts").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.string()), pa.array([total.tobytes()], pa.binary())], names=["lang", "counts"])

    return units.mapInArrow(run, "lang string, counts binary").groupBy("lang").applyInArrow(add, "lang string, counts binary")


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", vocabulary: str = VOCABULARY, sample_texts: int = SAMPLE_TEXTS) -> Model:
    """Learn from at most `sample_texts` texts of each language; rows without a language or text are left out."""
    spark = tune(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    # Ranked by id alone; the texts join only for the chosen.
    chosen = rows.select("id", "lang").distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample_texts).select(F.col("id").alias("chosen"), F.col("lang").alias("chosen_lang"))
    sample = rows.join(chosen, F.col("id").eqNullSafe(F.col("chosen")) & (F.col("lang") == F.col("chosen_lang")), "left_semi")
    units = cut_lineage(_training_units(sample), "units")
    languages = tuple(sorted(r["lang"] for r in units.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    size = len(Pieces(vocabulary))
    table = np.full((size + 1, len(languages)), 1.0 / size)
    table[-1] = 0
    model = Model(languages, table, vocabulary)
    for _ in range(ROUNDS if languages else 0):
        table = np.zeros_like(model.table)
        for row in _expect(units, model).collect():
            counts = np.frombuffer(row["counts"], dtype=np.float64) + PRIOR
            table[:-1, languages.index(row["lang"])] = counts / counts.sum()
        model = Model(languages, table, vocabulary)
    return model


class _Memory:
    """Word scores seen before: a large sorted part and a small recent one."""

    def __init__(self, languages: int):
        self.languages = languages
        self.keys, self.values = np.empty(0, np.uint64), np.empty((0, languages), np.float64)

    def split(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)
        return self.keys[at] == words, at

    def add(self, words: np.ndarray, values: np.ndarray) -> None:
        if len(self.keys) + len(words) > REMEMBERED:
            self.keys, self.values = words[:0], values[:0]
        keys = np.concatenate([self.keys, words])
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], np.concatenate([self.values, values])[order]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """id, lang_pred, score: the likeliest language of each whole text and its posterior, all languages being equally likely before.

    `und` with score 0 if the text is null or has no letter, or no language was learned.
    Ties go to the first language in order. A null or repeated id is scored like any other.
    With `carry` the whole row of docs comes along as the struct `row`, so that a decision
    on it needs no join.
    """
    spark = tune(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.languages)
        pieces, memory = Pieces(model.vocabulary) if k else None, _Memory(k)
        for batch in batches:
            lettered = batch.column(2).to_numpy(zero_copy_only=False)
            for low, high, data, offsets in text_blocks(batch.column(1)):
                hashes, starts, ends, firsts = hash_words(data, offsets)
                n = high - low
                totals = np.zeros((n, max(k, 1)))
                if k and len(hashes):
                    words, first, back = np.unique(hashes, return_index=True, return_inverse=True)
                    seen, at = memory.split(words)
                    values = np.empty((len(words), k))
                    values[seen] = memory.values[at[seen]] if seen.any() else 0
                    new = np.flatnonzero(~seen)
                    if len(new):
                        units, lengths, word = _units(data, starts[first[new]], ends[first[new]])
                        own = np.zeros((len(new), k))
                        np.add.at(own, word, unit_scores(pieces, units, lengths, model.table))
                        values[new] = own
                        memory.add(words[new], own)
                    full = np.flatnonzero(np.diff(firsts))
                    for c in range(k):
                        totals[full, c] = np.add.reduceat(values[back, c], firsts[:-1][full])
                top = totals.argmax(axis=1)
                posterior = 1.0 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
                sure = lettered[low:high] & (k > 0)
                names = [model.languages[t] if s else "und" for t, s in zip(top, sure, strict=True)]
                judged = [batch.column(0).slice(low, n), pa.array(names, pa.string()), pa.array(np.where(sure, posterior, 0.0))]
                yield pa.RecordBatch.from_arrays([*judged, *[c.slice(low, n) for c in batch.columns[3:]]], names=["doc_id", "lang_pred", "score", *batch.schema.names[3:]])

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), filled(text_col).alias("text"), letters.alias("lettered"), *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(run, StructType([*schema, StructField("row", docs.schema)]) if carry else schema)
