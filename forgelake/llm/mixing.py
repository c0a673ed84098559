"""Mixing sources to target weights by Efraimidis-Spirakis sampling; DataFrame operations only.

Every document gets an exponential key -ln(u) / w, u from a hash of its id and w its
quality weight: reading a source in the order of the keys is sampling without replacement
in proportion to the weights. Running totals of words along that order say which documents
a token budget reaches. A source whose target exceeds its size is taken whole as often as
it fits (complete epochs), and only the rest of the target is sampled.

The order of a source is cut into buckets of the key's range. Totals per bucket say in
which one the budget ends; only that one is sorted, and gives the place in the order where
the source is cut. Every document is then compared with its source's cut, so no text is
sorted or written on the way, and a source with a third of all rows is one small window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgelake.llm.shared import cut_lineage, tune

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source is taken at most so many times.
MOST_EPOCHS = 3
BUCKETS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def uniform(id_col: str, seed: int) -> Column:
    """A number in (0, 1) from the md5 of seed and id: the same in every run and engine."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target from one row per source (source, source_size).

    Sources in code point order, null last, take `weights` in turn and share the total size.
    A target that would exceed `most` times its source stops there and the excess is shared
    anew among the others, by weight. The sources that stop are those with the least
    most * size / weight, so one pass in that order finds where it ends. One row per source
    passes these windows, not one per document.
    """
    ranked = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    fill = Window.orderBy(F.col("source_size").cast("double") / F.col("weight"), "place")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    shares = (
        ranked.withColumn("weight", weight)
        .withColumn("capped", F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("open", (F.col("total") - F.col("capped")) * F.col("weight") <= F.col("source_size") * most * F.col("weight_left"))
    )
    # From the first open source on, all are open, at the level of that first one.
    level = F.col("weight") * (F.col("total") - F.col("first.capped")).cast("double") / F.col("first.weight_left")
    placed = shares.withColumn("at", F.row_number().over(fill)).withColumn("first_open", F.when(F.col("open"), F.struct("at", "capped", "weight_left")))
    placed = placed.withColumn("first", F.min("first_open").over(whole))
    is_open = F.coalesce(F.col("at") >= F.col("first.at"), F.lit(False))
    return placed.select("source", "source_size", F.when(is_open, level).otherwise((F.col("source_size") * most).cast("double")).alias("target"))


def mix_sources(
    docs: DataFrame, quality: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: int = 1, size: Column | None = None, keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, source_size, target, taken (words of the mix, repeats counted), source for every row, and the columns in `keep`.

    `quality` holds doc_id and a positive weight; a document it lacks, or of which the
    weight is null or not positive, weighs 1, and of several rows of an id the largest
    weight counts. `size` is the number of words unless given. A null text has size 0. A
    null source is a source of its own, after the others; a null id is hashed as such.
    Equal keys go by id, then size, then a hash of the text; rows alike in all of these share
    what the cut leaves them, rounded down. Each document is taken `epochs` times whole; then documents in
    the order of their keys until the target is reached, the last in part, rounded down.
    Kept columns travel as one, so their names may be any; one that is named like a column of
    the result comes back with `_kept` behind its name.
    A source of size 0 takes nothing. Without documents the result is empty.
    """
    tune(docs.sparkSession)
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)) if size is None else size, F.lit(0)).cast("long")
    digest = F.xxhash64(text_col) if text_col in docs.columns else F.lit(0).cast("long")
    best = None if quality is None else quality.where("weight > 0 and doc_id is not null").groupBy("doc_id").agg(F.max("weight").cast("double").alias("w"))

    def ordered(*more: Column) -> DataFrame:
        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), digest.alias("digest"), *more)
        weight = F.lit(1.0)
        if best is not None:
            rows, weight = rows.join(best, "doc_id", "left"), F.coalesce("w", weight)
        return rows.withColumn("at", F.struct((-F.log(uniform("doc_id", seed)) / weight).alias("key"), "doc_id", "size", "digest")).drop("w", "digest")

    keyed = cut_lineage(ordered(), "keyed")
    per_source = cut_lineage(targets(keyed.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    per_source = per_source.withColumn("epochs", epochs).withColumn("rest", F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size"))
    plan = cut_lineage(_with_cuts(keyed, per_source), "cuts").withColumnRenamed("source", "s")
    # One row per source; a free text as source column may make it many.
    plan = F.broadcast(plan) if plan.limit(100_001).count() <= 100_000 else plan
    rows = ordered(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("carried")) if keep else keyed
    placed = rows.join(plan, rows["source"].eqNullSafe(plan["s"]))
    part = F.when(F.col("at") < F.col("cut"), F.col("size")).when(F.col("at") == F.col("cut"), F.col("share"))
    own = ("doc_id", "size", "source_size", "target", "taken", "source")
    back = [F.col("carried")[c].alias(f"{c}_kept" if c in own else c) for c in keep]
    return placed.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.coalesce(part, F.lit(0))).alias("taken"), "source", *back)


def _with_cuts(keyed: DataFrame, per_source: DataFrame) -> DataFrame:
    """`per_source` with cut, the place in a source's order where `rest` words are reached, and share, what the document there gives.

    Only the one bucket per source that the rest ends in is sorted. Rows alike in all of
    `at` stand at one place and share alike.
    """
    # Keys of weight 1 are spread evenly over the buckets; other weights bend that, but keep it smooth.
    rows = keyed.withColumn("bucket", F.floor((1 - F.exp(-F.col("at.key"))) * BUCKETS).cast("int"))
    per_bucket = rows.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.withColumn("ahead", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
    limits = per_source.select(F.col("source").alias("s"), "rest")
    ends = per_bucket.join(limits, per_bucket["source"].eqNullSafe(limits["s"])).where("ahead <= rest and rest < ahead + in_bucket").select("s", F.col("bucket").alias("b"), "ahead", "rest")
    last = rows.join(ends, rows["source"].eqNullSafe(ends["s"]) & (rows["bucket"] == ends["b"]))
    alike = last.groupBy("s", "at", "ahead", "rest").agg(F.sum("size").alias("words"), F.count("*").alias("many"))
    inside = Window.partitionBy("s").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    alike = alike.withColumn("left", F.col("rest") - F.col("ahead") - F.coalesce(F.sum("words").over(inside), F.lit(0)))
    cuts = alike.where("0 <= left and left < words").select("s", F.col("at").alias("cut"), F.floor(F.col("left") / F.col("many")).cast("long").alias("share"))
    return per_source.join(cuts, per_source["source"].eqNullSafe(cuts["s"]), "left").drop("s")


def quality_weights(labels: DataFrame) -> DataFrame:
    """doc_id, weight: good documents are drawn four times as readily as bad ones, unjudged ones in between."""
    return labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))


#: The same in DuckDB. The last step of each source's level is one division, as above.
SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
quality as (
  select doc_id, max(case when quality = 1 then 2.0 when quality = 0 then 0.5 else 1.0 end)::double as w from labels where doc_id is not null group by doc_id),
keyed as (
  select d.doc_id, d.source, d.size,
    -ln((('0x' || substr(md5('1:' || coalesce(d.doc_id::varchar, 'null')), 1, 13))::bigint::double + 0.5) / 4503599627370496.0) / coalesce(q.w, 1.0) as key
  from sized d left join quality q on d.doc_id = q.doc_id),
ranked as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source is null, source collate "C") - 1 as place from keyed group by source),
weighed as (select *, case place % 3 when 0 then 5 when 1 then 2 else 1 end as weight from ranked),
filled as (
  select *, row_number() over o as pos, coalesce(sum(source_size * 3) over p, 0) as capped,
    sum(weight) over () - coalesce(sum(weight) over p, 0) as weight_left, sum(source_size) over () as total
  from weighed
  window o as (order by source_size::double / weight, place), p as (order by source_size::double / weight, place rows between unbounded preceding and 1 preceding)),
opened as (select *, (total - capped) * weight <= source_size * 3 * weight_left as open from filled),
level as (select pos as first_pos, capped as first_capped, weight_left as first_left from opened where open order by pos limit 1),
targets as (
  select source, source_size, case when pos >= first_pos then weight * (total - first_capped)::double / first_left else (source_size * 3)::double end as target
  from opened left join level on true),
placed as (
  select k.*, t.source_size, t.target, case when t.source_size > 0 then floor(t.target / t.source_size)::bigint else 0 end as epochs,
    coalesce(sum(k.size) over (partition by k.source order by k.key, k.doc_id, k.size rows between unbounded preceding and 1 preceding), 0)::bigint as ahead
  from keyed k join targets t on k.source is not distinct from t.source)
select doc_id, source, size, source_size, target,
  (epochs * size + greatest(0, least(size, floor(target)::bigint - epochs * source_size - ahead)))::bigint as taken
from placed
"""
