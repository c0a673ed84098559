"""How far the sources of a language drift from each other: term frequencies and divergences.

One `bytes.translate` lowers A-Z and blanks every other ASCII byte, so `bytes.split` gives the
terms: runs of letters and of bytes above 0x7F, which in UTF-8 belong to no other character.
A Counter per document gives its frequencies. Tasks add the Counters of a (lang, source) up in
a bounded buffer before anything is shuffled, so a hot source or term is one row per task.

All later steps are sparse. A term that a source lacks has the same share p0 there, whichever
term it is, so for two sources g, s the divergence sum over all V kept terms is

  sum over common terms of [f(pg, ps) - f(pg, p0s) - f(p0g, ps) + f(p0g, p0s)]
  + sum over g's terms of f(pg, p0s) + sum over s's terms of f(p0g, ps)
  + (V - terms of g - terms of s) * f(p0g, p0s)

The two middle sums need only how many terms a source has with each count. Common terms are
met term by term in Arrow batches that add up per pair of sources, so no row per pair and term
exists. Every f is at most 10^18, and each sum is at most (sum of p - 1)^2 + sum of q, about
10^18 as well: longs hold them all.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgelake.llm.shared import cut_lineage, filled, tune

#: A-Z as a-z, all other ASCII as spaces, the rest as it is.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
#: Longer texts are split piece by piece at blanks.
PIECE = 1 << 20
#: Entries that a task holds before it passes them on.
BUFFER = 300_000
#: Pairs of sources that are computed at a time.
PAIRS = 1 << 20
#: Ranks are cut in so many parts per group first, so no task sorts the terms of a hot group.
PARTS = 32


def terms(text: bytes) -> Counter:
    """Frequencies of a text's terms."""
    text = text.translate(TABLE)
    if len(text) <= PIECE:
        return Counter(text.split())
    found: Counter = Counter()
    at = 0
    while at < len(text):
        to = text.find(b" ", at + PIECE)
        to = len(text) if to < 0 else to
        found.update(text[at:to].split())
        at = to
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, count, docs): partial sums; the empty term counts the documents themselves."""
    sums: dict[tuple[str, str], dict[bytes, list[int]]] = defaultdict(dict)
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), rows in sums.items():
            names, numbers = list(rows), np.array(list(rows.values()), dtype=np.int64)
            for at in range(0, len(names), 50_000):
                n = len(names[at : at + 50_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(names[at : at + n], pa.binary()).cast(pa.string()), pa.array(numbers[at : at + n, 0]), pa.array(numbers[at : at + n, 1])],
                    names=["lang", "source", "term", "count", "docs"],
                )
        sums.clear()

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        texts = batch.column("text").cast(pa.large_binary())
        for i, (lang, source) in enumerate(zip(langs, sources, strict=True)):
            group = sums[lang, source]
            before = len(group)
            for term, n in ((b"", 0), *terms(texts[i].as_py()).items()):
                entry = group.get(term)
                if entry is None:
                    group[term] = [n, 1]
                else:
                    entry[0] += n
                    entry[1] += 1
            held += len(group) - before
            if held >= BUFFER:
                yield from flush()
                held = 0
    yield from flush()


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, value): the sum over common terms, per task and pair of sources a, b."""
    sums: dict[str, dict[int, int]] = defaultdict(lambda: defaultdict(int))
    f = lambda p, q: (p - q) * (p - q) // q

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, pairs in sums.items():
            code, value = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int64, len(pairs))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array((code >> 32).astype(np.int32)), pa.array((code & 0xFFFFFFFF).astype(np.int32)), pa.array(value)], names=["lang", "a", "b", "value"])
        sums.clear()

    for batch in batches:
        for lang in pc.unique(batch.column("lang")).to_pylist():
            rows = batch.filter(pc.equal(batch.column("lang"), lang)).column("found")
            size = rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            entries = rows.flatten()
            number, p, p0 = (np.asarray(entries.field(n).to_numpy(zero_copy_only=False), dtype=np.int64) for n in ("number", "p", "p0"))
            start = np.repeat(np.cumsum(size) - size, size)  # of each entry's term
            partners = np.repeat(size, size)
            reach = np.cumsum(partners)
            at = 0
            while at < len(partners):
                to = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + PAIRS, side="right")))
                n = partners[at:to]
                one = np.repeat(np.arange(at, to), n)
                two = np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[at:to], n)
                apart = one != two
                one, two = one[apart], two[apart]
                value = f(p[one], p[two]) - f(p[one], p0[two]) - f(p0[one], p[two]) + f(p0[one], p0[two])
                code, place = np.unique((number[one] << 32) | number[two], return_inverse=True)
                total = np.zeros(len(code), dtype=np.int64)
                np.add.at(total, place, value)
                own = sums[lang]
                for c, v in zip(code.tolist(), total.tolist(), strict=True):
                    own[c] += v
                at = to
        if sum(map(len, sums.values())) >= BUFFER:
            yield from flush()
    yield from flush()


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + kept)), exact."""
    wide = lambda c: c.cast("decimal(28,0)")
    return F.lit(1).cast("long") + F.call_function("div", wide(count + 1) * F.lit(1_000_000_000).cast("decimal(10,0)"), wide(total + kept))


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, least_docs: int = 3, ranks: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank.

    Null text, lang and source count as ''. A language keeps the terms found in at least
    `least_docs` of its documents (rows; repeated ones count each). Part `pair` ranks for every
    (lang, source) the other sources of its language by divergence over all kept terms (0
    where there are none), part `term` the terms it uses more than its language does, up to
    `ranks`. Ties go by the item's UTF-8 bytes.

    No documents give no rows, a language's only source no pair, a source without kept terms
    no term. Texts of any length are counted whole. Other columns don't matter.
    """
    tune(docs.sparkSession)
    texts = docs.select(filled("lang").alias("lang"), filled("source").alias("source"), filled("text").alias("text"))
    parts = texts.mapInArrow(_count, "lang string, source string, term string, count long, docs long")
    counts = cut_lineage(parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")), "counts")

    # A term has one row per source here.
    of_term = Window.partitionBy("lang", "term")
    kept = counts.where("term <> ''").withColumn("lang_docs", F.sum("docs").over(of_term)).withColumn("lang_count", F.sum("count").over(of_term))
    kept = cut_lineage(kept.where(F.col("lang_docs") >= least_docs).select("lang", "source", "term", "count", "lang_count"), "kept")
    vocabulary = kept.groupBy("lang", "term").agg(F.max("lang_count").alias("lang_count")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_count").alias("lang_n"))
    used = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count("*").alias("terms"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    groups = counts.where("term = ''").select("lang", "source").join(used, ["lang", "source"], "left").join(vocabulary, "lang", "left")
    groups = groups.select("lang", "source", zero("n"), zero("terms"), zero("v"), zero("lang_n"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    p0 = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("n"), F.col("v")))
    groups = cut_lineage(groups.withColumn("number", number).withColumn("p0", p0), "groups")

    shares = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("count"), F.col("n"), F.col("v")))
    terms_part = _ranked_terms(shares, ranks)
    return terms_part.unionByName(_ranked_pairs(shares, groups))


def _ranked_terms(shares: DataFrame, ranks: int) -> DataFrame:
    q = share(F.col("lang_count"), F.col("lang_n"), F.col("v"))
    more = shares.withColumn("q", q).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    order = [F.desc("value"), F.asc("item")]
    some = Window.partitionBy("lang", "source", "deal").orderBy(*order)
    best = more.withColumn("deal", F.pmod(F.xxhash64("item"), F.lit(PARTS))).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= ranks).drop("deal", "rank")
    whole = Window.partitionBy("lang", "source").orderBy(*order)
    return best.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= ranks)


def _ranked_pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    found = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("number", "p", "p0")).alias("found")).where(F.size("found") > 1)
    common = found.select("lang", "found").mapInArrow(_common, "lang string, a int, b int, value long")
    # How many terms a source has with each share; it meets each other source of its language.
    alike = shares.groupBy("lang", F.col("number").alias("a"), "p").agg(F.count("*").alias("terms"))
    other = groups.select("lang", F.col("number").alias("b"), F.col("p0").alias("q0"))
    met = alike.join(other, "lang").where("a <> b").groupBy("lang", "a", "b").agg(
        F.sum(F.col("terms") * apart(F.col("p"), F.col("q0"))).alias("own"), F.sum(F.col("terms") * apart(F.col("q0"), F.col("p"))).alias("others")
    )
    one = groups.select("lang", "source", F.col("number").alias("a"), F.col("terms").alias("ta"), "v", "p0")
    two = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"), F.col("terms").alias("tb"), F.col("p0").alias("q0"))
    pairs = one.join(two, "lang").where("a <> b")
    absent = F.when(F.col("v") > 0, (F.col("v") - F.col("ta") - F.col("tb")) * apart(F.col("p0"), F.col("q0"))).otherwise(0)
    value = (
        pairs.select("lang", "a", "b", absent.alias("value"))
        .unionByName(met.select("lang", "a", "b", F.col("own").alias("value")))
        .unionByName(met.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("others").alias("value")))
        .unionByName(common).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    )
    rows = pairs.select("lang", "source", "item", "a", "b").join(value, ["lang", "a", "b"])
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    return rows.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


#: The same in DuckDB.
SQL = r"""
with texts as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (select row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from texts),
kept as (select lang, term, count(*)::hugeint as c from words group by lang, term having count(distinct row) >= 3),
langs as (select lang, count(*)::hugeint as v, sum(c)::hugeint as n from kept group by lang),
counts as (select w.lang, w.source, w.term, count(*)::hugeint as c from words w join kept k on w.lang = k.lang and w.term = k.term group by all),
totals as (select lang, source, sum(c)::hugeint as n from counts group by all),
groups as (
  select g.lang, g.source, coalesce(t.n, 0)::hugeint as n, coalesce(l.v, 0)::hugeint as v, coalesce(l.n, 0)::hugeint as ln
  from (select distinct lang, source from texts) g left join totals t on g.lang = t.lang and g.source = t.source left join langs l on g.lang = l.lang),
shares as (
  select g.lang, g.source, k.term, coalesce(c.c, 0) as c, 1 + 1000000000::hugeint * (coalesce(c.c, 0) + 1) // (g.n + g.v) as p, 1 + 1000000000::hugeint * (k.c + 1) // (g.ln + g.v) as q
  from groups g join kept k on g.lang = k.lang left join counts c on g.lang = c.lang and g.source = c.source and k.term = c.term),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // q)::bigint as value from shares where c > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source order by value desc, encode(item)) as rank from terms),
sums as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p)::bigint as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source)
select lang, source, part, item, value, rank::int as rank from ranked where rank <= 200
union all
select lang, source, part, item, value, (row_number() over (partition by lang, source order by value desc, encode(item)))::int as rank from pairs
"""
