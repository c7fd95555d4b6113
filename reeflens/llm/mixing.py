"""Mixing of sources to target weights, with floor(rate) copies and one hash-seeded draw.

Words are summed per source; targets are shares of all words by weight,
stopped at ``CAP`` times the source's own words with the excess shared again.
A document of a source with repetition rate r is taken floor(r) times, and
once more when its draw is below the fraction of r.  Draws come from the
document's id, so reruns agree; each source uses that one of ``4 * 4`` seeds
whose taken words are nearest to its target.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored
from .sqltext import n_words, whole

WEIGHTS = (1, 2, 3)
CAP = 3
#: md5 values per document, each split into four 32-bit draws.
DIGESTS = 4


def _draws(id_col: Column) -> list[Column]:
    """Numbers in [0, 1) that depend on the id alone."""
    out = []
    for k in range(DIGESTS):
        digest = F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(f":{k}")))
        out += [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") / F.lit(4294967296.0) for i in range(4)]
    return out


def _weighted(sources: DataFrame) -> DataFrame:
    """Sources with their weight: WEIGHTS repeat over the sources by code point, null last.

    Ranks are row numbers in stored range partitions plus the rows of the
    partitions before, so no task gets all sources.
    """
    parts = max(1, int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    order = F.col("source").asc_nulls_last()
    # written with its partition number: what a later plan reads no longer depends on the partitioning
    ranged = stored(sources.repartitionByRange(parts, order).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("part").agg(F.count("*").alias("rows")).withColumn(
        "offset", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows")
    rank = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.col("offset")
    index = F.pmod(rank, F.lit(len(WEIGHTS))).cast("int") + 1
    return ranged.join(offsets, "part").select(
        "source", "source_size", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), index).cast("long").alias("weight"))


def source_plan(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target, whole, part, seed)`` from ``(id, source, size)`` rows.

    ``whole`` and ``part`` are the integer part and the fraction of the rate.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stored(_weighted(per_source), "weights")
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    share, rest = total or 0, weight or 1  # words to share, weights to share them by
    big = "decimal(38,0)"
    while True:
        over = (F.col("weight").cast(big) * F.lit(Decimal(share)).cast("decimal(19,0)")
                > F.col("source_size").cast(big) * F.lit(Decimal(CAP * rest)).cast("decimal(19,0)"))
        fixed, free = sources.agg(F.sum(F.when(over, CAP * F.col("source_size"))), F.sum(F.when(~over, F.col("weight")))).first()
        if (now := ((total or 0) - (fixed or 0), free or 1)) == (share, rest):
            break
        share, rest = now
    target = F.when(over, (CAP * F.col("source_size")).cast("double")).otherwise(
        (F.col("weight") * F.lit(share)).cast("double") / F.lit(float(rest)))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = sources.withColumn("target", target).select(
        "source", "source_size", "target", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("part"))

    draws = _draws(F.col("id"))
    taken = sizes.alias("d").join(rated.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source"))).groupBy("r.source").agg(
        *[F.sum(F.when(u < F.col("part"), F.col("size")).otherwise(0)).alias(f"t{k}") for k, u in enumerate(draws)])
    miss = [F.struct(F.abs(F.col("whole") * F.col("source_size") + F.col(f"t{k}") - F.col("target")).alias("miss"),
                     F.lit(k).alias("seed")) for k in range(len(draws))]
    return stored(rated.alias("r").join(taken.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "r.source", "source_size", "target", "whole", "part", F.array_min(F.array(*miss))["seed"].alias("seed")), "plan")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` (times the mix takes the row).

    The size of a null or empty text is 0.  Null sources are one source, the
    last.  A source without words has target 0 and its rows are not taken.
    Rows that repeat an id draw alike; a null id draws as the text 'null'.
    Columns of ``docs`` with the names added here are replaced.  An empty
    table gives an empty result.
    """
    added = ("size", "source_size", "target", "copies")
    names = [c for c in docs.columns if c not in added or c in (id_col, source_col, text_col)]
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       n_words(whole(text_col)).alias("size"))
    return _apply(docs.select(*names, n_words(whole(text_col)).alias("size")), source_plan(stored(rows, "sizes")),
                  id_col, source_col)


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The digest of ``mix_sources``: ids, sizes, targets and copies without the texts, read once."""
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                              n_words(whole(text_col)).alias("size")), "sizes")
    return _apply(rows, source_plan(rows), "id", "source").withColumnRenamed("id", id_col)


def _apply(docs: DataFrame, plan: DataFrame, id_col: str, source_col: str) -> DataFrame:
    seeded = F.element_at(F.array(*_draws(F.col(f"d.{id_col}"))), F.col("p.seed") + 1)
    copies = (F.col("p.whole") + (seeded < F.col("p.part")).cast("long")).alias("copies")
    return docs.alias("d").join(plan.alias("p"), F.col(f"d.{source_col}").cast("string").eqNullSafe(F.col("p.source"))).select(
        "d.*", "p.source_size", "p.target", copies)
