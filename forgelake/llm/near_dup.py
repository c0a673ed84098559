"""Near-duplicate documents by an inverted join on MinHash signature coordinates.

A coordinate is made of WIDTH least values, and every (coordinate, value) pair of a
signature is a token under which the document is posted. Two documents whose sets have
similarity s agree in about s ** WIDTH * COORDINATES coordinates; a pair is retained when
it agrees in at least MATCH of them, and confirmed on its full sets. Prefix and skip
merging keep the lists short: a pair with MATCH common tokens has a common one among the
COORDINATES - MATCH + 1 rarest of either document, so only these are posted, and all least
values are compared only for pairs met there. Coordinates of one least value each would
meet documents that share little but frequent shingles, ever more of them as the input
grows.

With 36 coordinates of 4 least values and a threshold of 2, a pair of similarity 0.8 is
missed with a probability below 1e-6, a closer pair with less. Pairs that met must agree
in 124 of 192 least values, which a pair of similarity 0.8 misses as seldom.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgelake.llm.graph import components
from forgelake.llm.shared import cut_lineage, filled, tune
from forgelake.llm.text import mix, ngram_hashes, hash_words, text_blocks

COORDINATES = 36
WIDTH = 4
MATCH = 2
#: Least values compared of pairs that met, those of the posted coordinates among them, and how many must agree.
CHECKED = 192
CHECK_MATCH = 124
#: Members of a posting list that are compared in one piece of work.
BLOCK = 4096
#: Full sets that are compared in one piece of work: shingles, and what a member counts beside its own.
SET_BLOCK = 1 << 22
SET_WEIGHT = 512
#: Counters of the sketch that orders tokens from rare to frequent; the order only has to be the same everywhere.
SKETCH_BITS = 20
SLICES = 64
HEAD_ROUNDS = 2
#: Heads that a document is compared with in a round.
HEADS = 4
_ODD = mix(np.arange(1, CHECKED + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = mix(np.arange(CHECKED + 1, 2 * CHECKED + 1, dtype=np.uint64))


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for _, _, data, offsets in text_blocks(column):
        words, _, _, firsts = hash_words(data, offsets)
        grams, index = ngram_hashes(words, firsts, shingle, whole_if_short=True)
        for i in range(len(offsets) - 1):
            yield np.unique(grams[index[i] : index[i + 1]])


def signature(grams: np.ndarray) -> np.ndarray:
    """Least value of each of CHECKED hash functions over a set that is not empty."""
    low = np.full(CHECKED, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(grams), 1024):
        part = grams[at : at + 1024]
        low = np.minimum(low, (part[:, None] * _ODD[None, :] + _ADD[None, :]).min(axis=0))
    return (mix(low) >> np.uint64(32)).astype(np.uint32)


def coordinates(least: np.ndarray) -> np.ndarray:
    """The COORDINATES values that stand for WIDTH least values each."""
    parts = least[: COORDINATES * WIDTH].reshape(COORDINATES, WIDTH).astype(np.uint64)
    value = np.zeros(COORDINATES, dtype=np.uint64)
    for k in range(WIDTH):
        value = mix((value << np.uint64(32)) ^ (value >> np.uint64(32)) ^ parts[:, k])
    return (value >> np.uint64(32)).astype(np.uint32)


def tokens(signatures: np.ndarray) -> np.ndarray:
    """64-bit tokens of signature rows: one per (coordinate, value)."""
    return mix(signatures.astype(np.uint64) | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)))


def _signed(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, hash of the text, set size, fingerprint of the set, posted coordinates and a byte of each least value (bytes never agree too seldom)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, signatures, lows = [], [], [], []
            for grams in shingle_sets(batch.column(1), shingle):
                sizes.append(len(grams))
                if not len(grams):
                    prints.append(None)
                    signatures.append(None)
                    lows.append(None)
                    continue
                mixed = mix(grams)
                total, other = mixed.sum(dtype=np.uint64), mix(mixed + np.uint64(7)).sum(dtype=np.uint64)
                prints.append(np.array([total, other, len(grams)], dtype=np.uint64).tobytes())
                whole = signature(grams)
                signatures.append(coordinates(whole).tobytes())
                lows.append(whole.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(signatures, pa.binary()), pa.array(lows, pa.binary())],
                names=["doc_id", "text_hash", "n", "fp", "sig", "low"],
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, "doc_id long, text_hash long, n long, fp binary, sig binary, low binary")


def _rarity(representatives: DataFrame) -> np.ndarray:
    """Sketch of how many documents post each token: 2 ** SKETCH_BITS counters of one byte, whatever the input.

    The counters of a partition leave it in slices, summed slice by slice on the executors.
    """
    width = (1 << SKETCH_BITS) // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            found = tokens(np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES))
            total += np.bincount((found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64).ravel(), minlength=len(total))
        if total.any():
            codec = pa.Codec("zstd")
            blocks = [codec.compress(total[k * width : (k + 1) * width].tobytes(), asbytes=True) for k in range(SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(blocks, pa.binary())], names=["slice", "block"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=np.int64)
        for batch in batches:
            for block in batch.column("block").to_pylist():
                total += np.frombuffer(pa.Codec("zstd").decompress(block, width * 8), dtype=np.int64)
        steps = np.minimum(np.ceil(8 * np.log2(total + 1)), 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([steps.tobytes()], pa.binary())], names=["slice", "block"])

    counted = representatives.select("sig").mapInArrow(count, "slice int, block binary")
    rows = counted.groupBy("slice").applyInArrow(add, "slice int, block binary").collect()
    sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
    for row in rows:
        sketch[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["block"], dtype=np.uint8)
    return sketch


def _posted(representatives: DataFrame, sketch) -> DataFrame:
    """token, rep, n: each representative under the rarest tokens that a matching pair must share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix = COORDINATES - MATCH + 1
        for batch in batches:
            found = tokens(np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES))
            weight = sketch.value[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            order = np.lexsort((found, weight), axis=1)[:, :prefix]
            chosen = np.take_along_axis(found, order, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(chosen.ravel(), pa.int64()), batch.column("rep").take(pa.array(np.repeat(np.arange(len(chosen)), prefix))),
                 batch.column("n").take(pa.array(np.repeat(np.arange(len(chosen)), prefix)))],
                names=["token", "rep", "n"],
            )

    return representatives.select("rep", "n", "sig").mapInArrow(run, "token long, rep long, n long")


def _low_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, CHECKED)


def _agreeing(pairs: DataFrame, representatives: DataFrame) -> DataFrame:
    """Of the pairs (rep, head) that agree in CHECK_MATCH least values at least, each document's best one, as (a, b)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            agree = (_low_rows(batch.column("low_a")) == _low_rows(batch.column("low_b"))).sum(axis=1, dtype=np.int64)
            keep = pa.array(agree >= CHECK_MATCH)
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in (batch.column("rep"), batch.column("head"), pa.array(agree))], names=["rep", "head", "agree"])

    left = representatives.select("rep", F.col("low").alias("low_a"))
    right = representatives.select(F.col("rep").alias("head"), F.col("low").alias("low_b"))
    counted = pairs.join(right, "head").join(left, "rep").select("rep", "head", "low_a", "low_b").mapInArrow(count, "rep long, head long, agree long")
    best = counted.groupBy("rep").agg(F.max_by("head", F.struct("agree", "head")).alias("head"))
    return best.select(F.least("rep", "head").alias("a"), F.greatest("rep", "head").alias("b")).distinct()


def _pieces(rows: DataFrame, group: str, weight: Column, most: int) -> DataFrame:
    """Rows of the groups that hold several components, dealt to pieces of work (group, p, q), with their block.

    `most` bounds the weight of a block. A group within it is one piece. In a larger one the
    members of its largest component need no comparison with each other: each of their
    blocks meets the blocks of the other members only, and those meet each other.
    """
    mixed = rows.groupBy(group).agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.sum(weight).alias("whole")).where("least <> most")
    small = rows.join(mixed.where(F.col("whole") <= most).select(group), group).select(*rows.columns, *[F.lit(0).cast("long").alias(c) for c in ("p", "q", "block")])
    large = rows.join(mixed.where(F.col("whole") > most).select(group), group)
    parts = large.groupBy(group, "comp").agg(F.sum(weight).alias("w"))
    plan = parts.groupBy(group).agg(F.max_by("comp", F.struct("w", "comp")).alias("big"), F.ceil(F.max("w") / most).alias("big_blocks"), F.ceil((F.sum("w") - F.max("w")) / most).alias("open_blocks"))
    dealt = large.join(plan, group).withColumn("open", F.col("comp") != F.col("big"))
    block = F.when(F.col("open"), F.pmod(F.xxhash64("rep"), "open_blocks")).otherwise(F.col("open_blocks") + F.pmod(F.xxhash64("rep"), "big_blocks"))
    last = F.when(F.col("open"), F.col("open_blocks") + F.col("big_blocks")).otherwise(F.col("open_blocks")) - 1
    dealt = dealt.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return small.unionByName(dealt.select(*rows.columns, F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block"))


def _by_piece(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[pa.Table]:
    """The rows of one piece at a time, from batches sorted by piece."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in (group, "p", "q")], axis=1)
        bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            if last is not None and last != keys[s].tolist():
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(s, e - s))
            last = keys[s].tolist()
    if held:
        yield pa.Table.from_batches(held)


def _forest(piece: pa.Table, percent: int, linked: Callable[[int, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join the components of a piece: fewer than it has components, and enough to connect all that agreeing pairs connect.

    A member is compared with those behind it that are not yet in its component. `linked`
    says which of some members are linked with one; without it all that agree are.
    """
    rep, n, comp, block = (piece.column(c).to_numpy() for c in ("rep", "n", "comp", "block"))
    label = np.unique(comp, return_inverse=True)[1]
    left = label.max()
    low = _low_rows(piece.column("low").combine_chunks()) if left else None
    two = block.min() != block.max()
    found: list[tuple[int, int]] = []
    for i in range(len(rep) - 1):
        if not left:
            break
        fit = (label[i + 1 :] != label[i]) & (n[i + 1 :] * 100 >= n[i] * percent) & (n[i] * 100 >= n[i + 1 :] * percent)
        if two:  # pairs inside a block belong to the block's own piece of work
            fit &= block[i + 1 :] != block[i]
        others = np.flatnonzero(fit) + i + 1
        for at in range(0, len(others), 1 << 15):
            some = others[at : at + (1 << 15)]
            some = some[(low[some] == low[i]).sum(axis=1, dtype=np.int64) >= CHECK_MATCH]
            if linked is not None and len(some):
                some = some[linked(i, some)]
            some = some[label[some] != label[i]]
            met, first = np.unique(label[some], return_index=True)
            found += [(i, j) for j in some[first].tolist()]
            label[np.isin(label, met)] = label[i]
            left -= len(met)
    at = np.array(found, dtype=np.int64).reshape(-1, 2)
    return np.minimum(rep[at[:, 0]], rep[at[:, 1]]), np.maximum(rep[at[:, 0]], rep[at[:, 1]])


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _met(lists: DataFrame, representatives: DataFrame, percent: int) -> DataFrame:
    """Agreeing pairs that connect all that the agreeing pairs of the lists connect, over what is linked already.

    A list gives fewer pairs than it has components, however many of its members agree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _by_piece(batches, "key"):
            a, b = _forest(piece, percent)
            if len(a):
                yield _pair_batch(a, b)

    rows = _pieces(lists, "key", F.lit(1), BLOCK).join(representatives.select("rep", "low"), "rep").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "rep")
    return rows.select("key", "p", "q", "rep", "n", "comp", "block", "low").mapInArrow(run, "a long, b long").distinct()


def _linked_within(links: DataFrame, known: DataFrame, met: DataFrame, representatives: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Confirmed pairs between the components `known` of `links` that pairs of `met` connect.

    What `met` connects is a group; whatever is linked at all lies in one group. Its members
    are compared on their full sets, which travel once per block and not once per pair, and
    a piece gives no more pairs than join its components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _by_piece(batches, "key"):
            sets = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in piece.column("grams").combine_chunks()]
            sizes = np.array([len(x) for x in sets])
            dense = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(sizes)[:-1])
            own = np.zeros(sizes.sum(), dtype=np.bool_)

            def linked(i: int, others: np.ndarray, dense=dense, sizes=sizes, own=own) -> np.ndarray:
                own[dense[i]] = True
                both = np.array([np.count_nonzero(own[dense[j]]) for j in others])
                own[dense[i]] = False
                return 100 * both >= percent * (sizes[i] + sizes[others] - both)

            a, b = _forest(piece, percent, linked)
            if len(a):
                yield _pair_batch(a, b)

    placed = components(links.unionByName(met)).select(F.col("node").alias("rep"), F.col("component").alias("key"))
    placed = placed.join(known.select(F.col("node").alias("rep"), F.col("component").alias("comp")), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    rows = cut_lineage(placed.join(representatives.select("rep", "n"), "rep"), "groups")
    pieces = cut_lineage(_pieces(rows, "key", F.col("n") + SET_WEIGHT, SET_BLOCK), "pieces")
    sets = _full_sets(docs, pieces.select("rep").distinct(), shingle)
    dealt = pieces.join(representatives.select("rep", "low"), "rep").join(sets, "rep").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "rep")
    return dealt.select("key", "p", "q", "rep", "n", "comp", "block", "low", "grams").mapInArrow(run, "a long, b long").distinct()


def _full_sets(docs: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """rep, grams: the full sets of the documents in `needed`, of which only the texts are read again."""

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [grams.tobytes() for grams in shingle_sets(batch.column(1), shingle)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["rep", "grams"])

    texts = docs.join(needed.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(rebuild, "rep long, grams binary")
    return cut_lineage(texts.dropDuplicates(["rep"]), "sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity; only the texts of these pairs are read again."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
                one, two = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    sets = _full_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), shingle)
    joined = pairs.join(sets.select(F.col("rep").alias("b"), F.col("grams").alias("right")), "b").join(sets.select(F.col("rep").alias("a"), F.col("grams").alias("left")), "a")
    return joined.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long")


def _heads(lists: DataFrame, salt: int) -> DataFrame:
    """Pairs (rep, head): each document with up to HEADS heads that most of its posting lists have.

    The heads of a list are the members that stand in most lists, give or take salted
    hashes: copies that have most in common with the others. HEADS pairs per document at
    most, whatever the size of its lists; lists of one component are passed over.
    """
    count = lists.groupBy("rep").agg(F.count("*").alias("stands"))
    lists = lists.join(count, "rep")

    def head(k: int) -> Column:
        hashed = F.xxhash64(F.lit(salt * HEADS + k), "rep")
        return F.min(F.struct((F.pmod(hashed, F.lit(2 * (salt + k) + 1)) - F.col("stands")).alias("order"), hashed.alias("h"), "rep", "comp"))

    heads = lists.groupBy("key").agg(*[head(k).alias(f"h{k}") for k in range(HEADS)], F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    heads = heads.select("key", F.array_distinct(F.array(*[F.struct(f"h{k}.rep", f"h{k}.comp") for k in range(HEADS)])).alias("heads"))
    met = lists.join(heads, "key").select("rep", "comp", F.explode("heads").alias("head")).where("comp <> head.comp")
    counted = met.groupBy("rep", F.col("head.rep").alias("head")).agg(F.count("*").alias("times"))
    order = Window.partitionBy("rep").orderBy(F.desc("times"), F.xxhash64(F.lit(salt), "head"))
    most = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= HEADS)
    return most.select("rep", "head")


def _with_components(keyed: DataFrame, found: DataFrame) -> DataFrame:
    placed = keyed.drop("comp").join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    return cut_lineage(placed.select("key", "rep", "n", F.coalesce("component", "rep").alias("comp")), "lists")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per doc_id: n_shingles (set size), component_id (smallest id reachable over links), kept, n_class, class_id, text_hash (xxhash64 of the text judged).

    Texts with equal sets form a class, which its smallest id stands for; only these
    representatives are posted and compared. Two rounds compare each document
    with a few heads of its posting lists only, so a large group of copies costs a few rows
    per copy. Of what then still is in different components, the lists name the groups that
    agreeing pairs connect, and each group is compared on full sets, block by block; both
    steps hand on only pairs that join components, not all that agree.

    A null or blank text has an empty set and is linked with nothing. Rows that repeat an
    id count once (the one with the smallest fingerprint). A null id stands alone: its
    component is null and it is kept. Other columns are ignored. `id_col` must be an integer.
    """
    spark = tune(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), filled(text_col).alias("text"))
    rows = cut_lineage(_signed(docs, shingle), "signatures")
    single = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("fp", "n", "text_hash")).alias("x")).select("doc_id", "x.*")
    classes = single.where("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_class"))
    members = cut_lineage(single.join(classes, "fp", "left").select("doc_id", "n", "rep", "n_class", "text_hash"), "classes")
    # A representative has one set, so rows that repeat it are found where the join put them: signatures are shuffled once.
    kept = rows.join(classes.select("fp", F.col("rep").alias("doc_id")), ["fp", "doc_id"]).dropDuplicates(["fp", "doc_id"])
    representatives = cut_lineage(kept.select(F.col("doc_id").alias("rep"), "n", "sig", "low"), "representatives")
    sketch = spark.sparkContext.broadcast(_rarity(representatives))
    posted = _posted(representatives, sketch)
    shared = posted.groupBy("token").agg(F.count("*").alias("posted")).where("posted > 1")
    lists = cut_lineage(posted.join(shared.select("token"), "token").select(F.col("token").alias("key"), "rep", "n", F.col("rep").alias("comp")), "lists")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return cut_lineage(_confirmed(pairs, docs, shingle, percent), "links")

    links = None
    for salt in range(HEAD_ROUNDS):
        found = confirmed(cut_lineage(_agreeing(_heads(lists, salt), representatives), "pairs"))
        links = found if links is None else links.unionByName(found)
        known = components(links)
        lists = _with_components(lists, known)
    met = cut_lineage(_met(lists, representatives, percent), "met")
    final = components(links.unionByName(cut_lineage(_linked_within(links, known, met, representatives, docs, shingle, percent), "links")))

    placed_docs = members.join(final.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"), F.coalesce("n_class", F.lit(1)).alias("n_class"), F.coalesce("rep", "doc_id").alias("class_id"), "text_hash"
    )
    alone = rows.where("doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(1).cast("long").alias("n_class"), F.lit(None).cast("long").alias("class_id"), "text_hash")
    return placed_docs.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
