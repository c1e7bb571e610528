"""Mixing sources to target weights by hash-threshold histograms; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, stored, table

HASH_BITS = 60
LEVEL_BITS = 15


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(key: Column) -> Column:
    """60 bits of the md5 of the id as text; a null id counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """Target of each source. sources: one row each (source, source_size).

    Sources in order of code points, null last, weigh `weights` in turn and share the total
    of all sizes; a target stops at max_repeat times its source's size, and the excess is
    shared by weight among the others until none is above. With the sources in order of
    size per weight, those before the first that fits its share are at their limit. The
    windows run over one row per source.
    """
    ranked = sources.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())))
    turn = F.array(*[F.lit(int(w)) for w in weights])
    ranked = ranked.select(
        "source", "source_size", "rank",
        F.element_at(turn, ((F.col("rank") - 1) % len(weights) + 1).cast("int")).alias("w"),
        (F.col("source_size") * max_repeat).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    share = ranked.withColumns({
        "left": F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "w_left": F.sum("w").over(after), "place": F.row_number().over(order)})
    share = share.withColumn("fits", F.col("left").cast("double") * F.col("w") / F.col("w_left")
                             <= F.col("cap"))
    first = F.min(F.when(F.col("fits"), F.struct("place", "left", "w_left"))).over(every)
    share = share.withColumn("first", first)
    return share.select(
        "source", "source_size",
        F.when(F.col("first").isNull() | (F.col("place") < F.col("first.place")),
               F.col("cap").cast("double"))
        .otherwise(F.col("first.left").cast("double") * F.col("w") / F.col("first.w_left"))
        .alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3, keep: Sequence[str] = ()) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, copies; then the columns of `keep`.

    A document's size is its number of words (null: 0). Every document is taken as often as
    its source's size fits wholly into the target; the rest goes to the documents whose hash
    is below the source's threshold. Sizes are summed by source and bucket of 15 hash bits;
    only the bucket in which the budget ends is summed again by the next 15 bits, four times
    at most. The last cell is taken if that comes nearer to the target.

    Rows of one id share a hash and are taken together. Null sources form one source, a null
    id hashes as empty text, empty texts have size 0, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        n_words(F.col(text_col)).alias("size"), id_hash(F.col(id_col)).alias("h"))
    sized = stored(sized)
    state = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")),
                    weights, max_repeat)
    size = F.col("source_size")
    whole = F.when(size > 0, F.least(F.floor(F.col("target") / size), F.lit(max_repeat))).otherwise(0)
    state = stored(state.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.col("target") - F.col("whole") * size).withColumns(
        {"prefix": F.lit(0).cast("long"), "below": F.lit(0).cast("long"),
         "cell": F.lit(0).cast("long")}))
    for level in range(HASH_BITS // LEVEL_BITS):
        state = stored(_refined(sized, state, HASH_BITS - LEVEL_BITS * (level + 1)))
    near = F.abs(F.col("below") + F.col("cell") - F.col("rest")) < F.abs(F.col("rest") - F.col("below"))
    state = state.select(F.col("source").alias("_source"), "source_size", "target", "whole",
                         (F.col("prefix") + near.cast("long")).alias("_threshold"))
    rows = sized if not keep else docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("_s"),
        n_words(F.col(text_col)).alias("size"), id_hash(F.col(id_col)).alias("h"),
        F.struct(*[F.col(c) for c in keep]).alias("_kept"))
    on = F.col("_s" if keep else "source").eqNullSafe(F.col("_source"))
    copies = F.col("whole") + (F.col("h") < F.col("_threshold")).cast("long")
    out = rows.join(state, on, "left").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"),
        copies.alias("copies"), *(["_kept"] if keep else []))
    return out


def _refined(sized: DataFrame, state: DataFrame, shift: int) -> DataFrame:
    """One level down: the bucket of the next bits in which each source's budget ends."""
    here = state.select(F.col("source").alias("_source"), "prefix")
    rows = sized.join(here, F.col("source").eqNullSafe(F.col("_source"))
                      & (F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix")))
    bins = rows.groupBy("source", F.shiftright("h", shift).alias("bin")).agg(
        F.sum("size").alias("n"))
    by_bin = Window.partitionBy("source").orderBy("bin")
    found = bins.withColumn("upto", F.sum("n").over(by_bin)).join(
        state.select(F.col("source").alias("_source"), "rest", F.col("below").alias("_below")),
        F.col("source").eqNullSafe(F.col("_source")))
    found = found.withColumn("crosses", F.col("_below") + F.col("upto") >= F.col("rest"))
    found = found.groupBy("_source").agg(
        F.min(F.when(F.col("crosses"), F.struct("bin", "upto", "n"))).alias("hit"),
        F.max(F.struct("bin", "upto", "n")).alias("last"))
    hit = F.coalesce("hit", "last")  # sums of doubles may end a trifle above all there is
    found = found.select("_source", hit["bin"].alias("bin"), hit["n"].alias("n"),
                         (hit["upto"] - hit["n"]).alias("before"))
    joined = state.join(found, F.col("source").eqNullSafe(F.col("_source")), "left")
    return joined.select(
        "source", "source_size", "target", "whole", "rest",
        F.coalesce("bin", F.shiftleft("prefix", LEVEL_BITS)).alias("prefix"),
        (F.col("below") + F.coalesce("before", F.lit(0))).alias("below"),
        F.coalesce("n", F.lit(0).cast("long")).alias("cell"))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


ORACLE_OP5 = rf"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM d GROUP BY source),
w AS (SELECT *, (rank - 1) % 3 + 1 AS w, source_size * 3 AS cap FROM s),
p AS (
  SELECT *, row_number() OVER o AS place,
         sum(source_size) OVER () - coalesce(sum(cap) OVER (
           ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_,
         sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
  FROM w WINDOW o AS (ORDER BY cap / w, rank)),
f AS (
  SELECT * FROM p WHERE CAST(left_ AS DOUBLE) * w / w_left <= cap ORDER BY place LIMIT 1),
t AS (
  SELECT p.source, p.source_size,
         CASE WHEN f.place IS NULL OR p.place < f.place THEN CAST(p.cap AS DOUBLE)
              ELSE CAST(f.left_ AS DOUBLE) * p.w / f.w_left END AS target
  FROM p LEFT JOIN f ON TRUE),
q AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS whole
  FROM t),
r AS (SELECT *, target - whole * source_size AS rest FROM q),
c AS (
  SELECT source, h, sum(size) AS n,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto
  FROM d GROUP BY source, h),
hit AS (
  SELECT r.source, min(h) FILTER (upto >= rest) AS h,
         min_by(n, h) FILTER (upto >= rest) AS n, min_by(upto, h) FILTER (upto >= rest) AS upto
  FROM r JOIN c ON r.source IS NOT DISTINCT FROM c.source GROUP BY r.source),
b AS (
  SELECT r.*, CASE WHEN hit.h IS NULL THEN 1152921504606846976
                   ELSE hit.h + CAST(abs(hit.upto - rest) < abs(rest - (hit.upto - hit.n)) AS INT)
              END AS threshold
  FROM r JOIN hit ON r.source IS NOT DISTINCT FROM hit.source)
SELECT d.doc_id, d.size, b.source_size, b.target,
       CAST(d.size * (b.whole + CAST(d.h < b.threshold AS INT)) AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
"""
