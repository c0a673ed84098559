"""Interpolated modified Kneser-Ney bigram model, counted in Spark and scored from memory-mapped arrays.

Layout in the shared folder, all plain sorted arrays:

- `vocab-B`: sorted word hashes of range B of the hash space, and `freq-B`: their counts.
  The id of a word is its rank over all ranges.
- `keys-S`, `counts-S`: shard S of the bigrams, sorted by key (id of the first word << 32 | id of the second).
  The shard of a bigram comes from a hash of its key, so no frequent word fills one.
- `stats-B`: for each word of range B the number of bigram types it starts with count 1,
  2 and more, and the number of types it ends.

Workers map these files, so the model's size is bounded by the disk and the page cache, not
by a worker's memory. The driver sees one row of totals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.shared import cut_lineage, filled, new_path, open_array, tune, write_array
from forgelake.llm.text import hash_words, mix, text_blocks

#: Hash of the token that ends each text.
END = np.uint64(1)
#: Ranges of the hash space for the vocabulary; a range has a few thousand words per hundred million.
RANGES = 256
#: Bigrams of one shard, before those of equal key are added up.
SHARD_TOKENS = 4_000_000
#: Keys a task gathers before it adds up and sends them on.
HELD_KEYS = 2_000_000
_ZSTD = "zstd"


def _pack(array: np.ndarray) -> bytes:
    """Sorted or small integers, compressed; the first eight bytes are the plain size."""
    plain = np.ascontiguousarray(array).tobytes()
    return len(plain).to_bytes(8, "little") + pa.Codec(_ZSTD).compress(plain, asbytes=True)


def _unpack(block: bytes, dtype: str) -> np.ndarray:
    size = int.from_bytes(block[:8], "little")
    return np.frombuffer(pa.Codec(_ZSTD).decompress(block[8:], size), dtype=dtype)


def _pack_sorted(array: np.ndarray) -> bytes:
    """Sorted uint64 values as differences, byte plane by byte plane."""
    steps = np.diff(array, prepend=np.uint64(0)).astype("<u8")
    return _pack(steps.view(np.uint8).reshape(-1, 8).T)


def _unpack_sorted(block: bytes) -> np.ndarray:
    planes = _unpack(block, "u1")
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def _add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their counts added up."""
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _with_ends(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts with END after each, and the index of each text's first."""
    at = firsts + np.arange(len(firsts))
    out = np.full(int(at[-1]), END, dtype=np.uint64)
    keep = np.ones(len(out), dtype=bool)
    keep[at[1:] - 1] = False
    out[keep] = words
    return out, at


def _token_blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for low, high, data, offsets in text_blocks(batch.column(column)):
            words, _, _, firsts = hash_words(data, offsets)
            yield (batch, low, high, *_with_ends(words, firsts))


def _range_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(56)).astype(np.int64)


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys) % np.uint64(shards)).astype(np.int64)


def _sums(rows: DataFrame, *columns: str) -> tuple[int, ...]:
    return tuple(int(x or 0) for x in rows.agg(*[F.sum(c) for c in columns]).first())


class Vocabulary:
    """Word hash to id, from the mapped ranges."""

    def __init__(self, folder: str, sizes: list[int]):
        self.folder, self.starts = folder, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.mapped: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        if b not in self.mapped:
            full = self.starts[b + 1] > self.starts[b]
            self.mapped[b] = (open_array(self.folder, f"vocab-{b}", "<u8"), open_array(self.folder, f"freq-{b}", "<i8")) if full else (np.empty(0, np.uint64), np.empty(0, np.int64))
        return self.mapped[b]

    def find(self, sorted_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (the vocabulary's size if unknown) and count (0 if unknown) of each of some sorted hashes."""
        ids = np.full(len(sorted_words), self.starts[-1], dtype=np.int64)
        counts = np.zeros(len(sorted_words), dtype=np.int64)
        edges = np.searchsorted(_range_of(sorted_words), np.arange(RANGES + 1))
        for b in np.flatnonzero(np.diff(edges)):
            wanted = sorted_words[edges[b] : edges[b + 1]]
            words, freq = self.of(int(b))
            if len(words):
                at = np.minimum(np.searchsorted(words, wanted), len(words) - 1)
                hit = words[at] == wanted
                ids[edges[b] : edges[b + 1]][hit] = at[hit] + self.starts[b]
                counts[edges[b] : edges[b + 1]][hit] = freq[at[hit]]
        return ids, counts


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, and the totals: everything a worker needs to open them."""

    folder: str
    sizes: tuple[int, ...]  # words of each range
    shards: int
    tokens: int
    texts: int
    types: int  # bigram types
    discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_gamma: float

    @property
    def vocabulary(self) -> int:
        return sum(self.sizes)


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts from the numbers of types with count 1 to 4; where one is 0, a plain 0.75 bounded by the count."""
    if not all(n[:3]):
        return 0.75, 0.75, 0.75
    y = n[0] / (n[0] + 2 * n[1])
    raw = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])
    return tuple(min(max(d, 0.01), k + 0.99) for k, d in enumerate(raw))


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(counts == 0, 0.0, np.asarray((0.0, *d))[np.minimum(counts, 3)])


def _count_words(texts: DataFrame, folder: str) -> tuple[list[int], int, int]:
    """Write the vocabulary; words of each range, tokens, texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = ([], []), 0

        def send() -> Iterator[pa.RecordBatch]:
            words, counts = _add_up(*held)
            edges = np.searchsorted(_range_of(words), np.arange(RANGES + 1))
            full = np.flatnonzero(np.diff(edges))
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), pa.array([words[edges[b] : edges[b + 1]].tobytes() for b in full], pa.binary()), pa.array([_pack(counts[edges[b] : edges[b + 1]]) for b in full], pa.binary())],
                names=["b", "words", "counts"],
            )

        for _, _, _, tokens, _ in _token_blocks(batches, 0):
            words, counts = np.unique(tokens, return_counts=True)
            held[0].append(words)
            held[1].append(counts.astype(np.int64))
            size += len(words)
            if size > HELD_KEYS:
                words, counts = _add_up(*held)
                held, size = ([words], [counts]), len(words)
                if size > HELD_KEYS // 2:
                    yield from send()
                    held, size = ([], []), 0
        yield from send()

    def store(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, words, counts = key[0].as_py(), [], []
        for batch in batches:
            for x, y in zip(batch.column("words"), batch.column("counts"), strict=True):
                words.append(np.frombuffer(x.as_buffer(), dtype=np.uint64))
                counts.append(_unpack(y.as_py(), "<i8"))
            words, counts = ([x] for x in _add_up(words, counts))
        word, count = _add_up(words, counts)
        write_array(folder, f"vocab-{b}", word)
        write_array(folder, f"freq-{b}", count)
        ends = int(count[word == END].sum())
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (b, len(word), int(count.sum()), ends)], names=["b", "size", "tokens", "texts"])

    stored = texts.select("text").mapInArrow(count, "b int, words binary, counts binary").groupBy("b").applyInArrow(store, "b long, size long, tokens long, texts long").collect()
    sizes = [0] * RANGES
    for row in stored:
        sizes[row["b"]] = row["size"]
    return sizes, sum(r["tokens"] for r in stored), sum(r["texts"] for r in stored)


def _count_pairs(texts: DataFrame, folder: str, sizes: list[int], shards: int) -> DataFrame:
    """Write the bigram shards; per shard, counts of counts and what it adds to each word's numbers of types.

    The text's start is the word with the id after the last.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(folder, sizes)
        held, size = ([], []), 0

        def send() -> Iterator[pa.RecordBatch]:
            keys, counts = _add_up(*held)
            shard = _shard_of(keys, shards)
            order = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[order], np.arange(shards + 1))
            for k in np.flatnonzero(np.diff(edges)):
                own = order[edges[k] : edges[k + 1]]
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([_pack_sorted(keys[own])], pa.binary()), pa.array([_pack(counts[own].astype("<u4"))], pa.binary())], names=["shard", "keys", "counts"])

        for _, _, _, tokens, firsts in _token_blocks(batches, 0):
            words, back = np.unique(tokens, return_inverse=True)
            ids = vocabulary.find(words)[0][back].astype(np.uint64)
            before = np.concatenate([ids[:0], ids[-1:], ids[:-1]])
            before[firsts[:-1]] = np.uint64(vocabulary.starts[-1])
            keys, counts = np.unique(before << np.uint64(32) | ids, return_counts=True)
            held[0].append(keys)
            held[1].append(counts.astype(np.int64))
            size += len(keys)
            if size > 2 * HELD_KEYS:
                keys, counts = _add_up(*held)
                held, size = ([keys], [counts]), len(keys)
                if size > HELD_KEYS:
                    yield from send()
                    held, size = ([], []), 0
        yield from send()

    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def store(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, keys, counts, size = key[0].as_py(), [], [], 0
        for batch in batches:
            for x, y in zip(batch.column("keys"), batch.column("counts"), strict=True):
                keys.append(_unpack_sorted(x.as_py()))
                counts.append(_unpack(y.as_py(), "<u4").astype(np.int64))
                size += len(keys[-1])
                if size > 2 * SHARD_TOKENS:
                    keys, counts = ([v] for v in _add_up(keys, counts))
                    size = len(keys[0])
        keys, counts = _add_up(keys, counts)
        write_array(folder, f"keys-{shard}", keys)
        write_array(folder, f"counts-{shard}", counts.astype("<u4"))
        of = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        sums = pa.array([len(keys)], pa.int64())
        # What each word adds: as first word by class of the count, as second word.
        first, second = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        kinds = [first[counts == 1], first[counts == 2], first[counts > 2], second]
        found = [np.unique(k, return_counts=True) for k in kinds]
        del keys, counts, first, second, kinds
        for b in range(RANGES + 1):
            low, high = (starts[b], starts[b + 1]) if b < RANGES else (starts[-1], starts[-1] + 1)
            parts, own = [], 0
            for ids, n in found:
                span = slice(np.searchsorted(ids, low), np.searchsorted(ids, high))
                own += span.stop - span.start
                parts += [_pack_sorted(ids[span].astype(np.uint64)), _pack(n[span].astype("<u4"))]
            if own or b == 0:
                zero = pa.array([0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), *[pa.array([p], pa.binary()) for p in parts], sums if b == 0 else zero, *[pa.array([v], pa.int64()) if b == 0 else zero for v in of]],
                    names=["b", *[f"p{k}" for k in range(8)], "types", "n1", "n2", "n3", "n4"],
                )

    blocks = texts.select("text").mapInArrow(count, "shard int, keys binary, counts binary")
    return blocks.groupBy("shard").applyInArrow(store, "b int, " + ", ".join(f"p{k} binary" for k in range(8)) + ", types long, n1 long, n2 long, n3 long, n4 long")


def _store_stats(parts: DataFrame, folder: str, sizes: list[int]) -> list[int]:
    """Add up each word's numbers of types; the counts of counts of the words' endings."""
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def store(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = key[0].as_py()
        low, size = (int(starts[b]), sizes[b]) if b < RANGES else (int(starts[-1]), 1)
        table = np.zeros((4, size), dtype="<u4")
        for batch in batches:
            for k in range(4):
                for ids, n in zip(batch.column(f"p{2 * k}"), batch.column(f"p{2 * k + 1}"), strict=True):
                    table[k, _unpack_sorted(ids.as_py()).astype(np.int64) - low] += _unpack(n.as_py(), "<u4")
        write_array(folder, f"stats-{b}", table)
        yield pa.RecordBatch.from_arrays([pa.array([int((table[3] == k).sum())], pa.int64()) for k in (1, 2, 3, 4)] + [pa.array([int((table[3] > 2).sum())], pa.int64())], names=["n1", "n2", "n3", "n4", "more"])

    stored = parts.select("b", *[f"p{k}" for k in range(8)]).groupBy("b").applyInArrow(store, "n1 long, n2 long, n3 long, n4 long, more long")
    return list(_sums(stored, "n1", "n2", "n3", "n4", "more"))


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Count a model over all rows of `docs` and write it to the shared folder; null texts count as empty."""
    spark = tune(docs.sparkSession)
    folder = new_path(spark, "ngrams")
    texts = docs.select(filled(text_col).alias("text"))
    sizes, tokens, n_texts = _count_words(texts, folder)
    if sum(sizes) >= 1 << 32:
        raise ValueError("the vocabulary has more words than 32 bits can number")
    shards = tokens // SHARD_TOKENS + 1
    parts = cut_lineage(_count_pairs(texts, folder, sizes, shards), "types")
    types, *of = _sums(parts, "types", "n1", "n2", "n3", "n4")
    *ends, more = _store_stats(parts, folder, sizes)
    word_d = _discounts(ends)
    gamma = (word_d[0] * ends[0] + word_d[1] * ends[1] + word_d[2] * more) / types if types else 1.0
    return Model(folder, tuple(sizes), shards, tokens, n_texts, types, _discounts(of), word_d, gamma)


class Scorer:
    """Looks up probabilities in the mapped arrays of a model."""

    def __init__(self, model: Model):
        self.model, self.vocabulary = model, Vocabulary(model.folder, list(model.sizes))
        self.pairs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.tables: dict[int, np.ndarray] = {}

    def _stats(self, sorted_ids: np.ndarray) -> np.ndarray:
        """Numbers of types (4 rows) of sorted ids; zero for words without any."""
        out = np.zeros((4, len(sorted_ids)), dtype=np.int64)
        starts = np.append(self.vocabulary.starts, self.vocabulary.starts[-1] + 1)
        edges = np.searchsorted(sorted_ids, starts)
        for b in np.flatnonzero(np.diff(edges)):
            b = int(b)
            if b not in self.tables:
                try:
                    self.tables[b] = open_array(self.model.folder, f"stats-{b}", "<u4").reshape(4, -1)
                except FileNotFoundError:
                    self.tables[b] = np.zeros((4, int(starts[b + 1] - starts[b])), dtype="<u4")
            span = slice(edges[b], edges[b + 1])
            out[:, span] = self.tables[b][:, sorted_ids[span] - starts[b]]
        return out

    def _pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of distinct sorted bigram keys."""
        out = np.zeros(len(keys), dtype=np.int64)
        shard = _shard_of(keys, self.model.shards)
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(self.model.shards + 1))
        for k in np.flatnonzero(np.diff(edges)):
            k = int(k)
            if k not in self.pairs:
                try:
                    self.pairs[k] = (open_array(self.model.folder, f"keys-{k}", "<u8"), open_array(self.model.folder, f"counts-{k}", "<u4"))
                except FileNotFoundError:
                    self.pairs[k] = (np.empty(0, np.uint64), np.empty(0, np.uint32))
            known, counts = self.pairs[k]
            if len(known):
                own = order[edges[k] : edges[k + 1]]
                at = np.minimum(np.searchsorted(known, keys[own]), len(known) - 1)
                out[own] = np.where(known[at] == keys[own], counts[at], 0)
        return out

    def score(self, tokens: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, base score and the model's log10 probability."""
        m, v = self.model, self.model.vocabulary
        words, back = np.unique(tokens, return_inverse=True)
        word_ids, counts = self.vocabulary.find(words)
        base = np.log10((counts + 1.0) / (m.tokens + v + 1.0))
        own, place = np.unique(np.append(word_ids, v), return_inverse=True)
        stats = self._stats(own[own < v])
        if own[-1] == v:
            start = self._stats(np.array([v])) if m.types else np.zeros((4, 1), np.int64)
            stats = np.concatenate([stats, start], axis=1)
        seen = np.zeros(len(own), dtype=np.int64)
        seen[place[:-1]] = counts
        endings = np.where(own < v, stats[3], 0)
        lower = (endings - _discount(endings, m.word_discounts)) / max(m.types, 1) + m.word_gamma / (v + 1)
        # Position of each token's word, and of the word before it, among `own`.
        now = place[:-1][back]
        before = np.concatenate([now[:0], now[-1:], now[:-1]])
        unknown_before = (counts[back] == 0)
        unknown_before = np.concatenate([unknown_before[:0], unknown_before[-1:], unknown_before[:-1]])
        unknown_before[firsts[:-1]] = False
        before[firsts[:-1]] = place[-1]
        total = np.where(own < v, seen, m.texts)[before].astype(np.float64)
        total[unknown_before] = 0
        d = m.discounts
        mass = (d[0] * stats[0] + d[1] * stats[1] + d[2] * stats[2])[before]
        pair, which = np.unique(before.astype(np.uint64) << np.uint64(32) | now.astype(np.uint64), return_inverse=True)
        left, right = own[(pair >> np.uint64(32)).astype(np.int64)].astype(np.uint64), own[(pair & np.uint64(0xFFFFFFFF)).astype(np.int64)].astype(np.uint64)
        known = right < v
        found = np.zeros(len(pair), dtype=np.int64)
        found[known] = self._pair_counts(left[known] << np.uint64(32) | right[known])
        c = found[which]
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(total > 0, (c - _discount(c, d) + mass * lower[now]) / total, lower[now])
        return tuple(np.add.reduceat(x, firsts[:-1]) for x in ((counts[back] > 0).astype(np.int64), base[back], np.log10(p)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score, score of each row's whole text; perplexity is 10 ** (-score / n_tokens).

    Null and empty texts have one token, their end. Rows with a null or repeated id are
    scored like any other. Words that no training text has get the uniform share of the
    unigram level; after such a word the unigram level stands alone.
    """
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch, low, high, tokens, firsts in _token_blocks(batches, 1):
            known, base, total = scorer.score(tokens, firsts)
            n = high - low
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, n), pa.array(np.diff(firsts), pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(n, model.tokens), pa.int64()), pa.array(base), pa.array(total)],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return docs.select(F.col(id_col).alias("doc_id"), filled(text_col).alias("text")).mapInArrow(run, f"doc_id {dict(docs.dtypes)[id_col]}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
