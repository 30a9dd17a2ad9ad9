"""Mixing sources to target weights by systematic sampling.

Each source has a target (its share by weight of ``total`` times all words, at
most ``cap`` times its own size, the excess reshared).  Every document of a
source is expected target / size times.  Along a fixed order of the source's
documents the expected copies are prefix-summed, one random offset per source is
added, and a document is emitted once for each integer boundary that its
interval crosses.  The order is by size, so the words taken stay within about one
document of the target.

Defined results: a null text has size 0; a null source is a source of its own,
last in the order of weights; a source without words has target 0 and takes
nothing; repeated rows count once each; an empty table gives an empty result.
The offset and the order come from MD5, so reruns agree.

Scale: only (row id, source, size) is ranked.  The rank is taken over range
partitions, which split a hot source and a hot size; the offsets of partitions
and the list of sources are the only things that meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.common import RID, WORD, global_rank, saved, text_or_empty, with_rid

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
CAP = 2.0


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) fixed by the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size): the water level at
    which the uncapped sources share what the capped ones leave."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = saved(sizes.withColumn("w", w).withColumn("limit", F.col("source_size") * F.lit(cap)))
    want = rows.agg(F.sum("source_size") * F.lit(total)).first()[0] or 0.0
    level, capped = 0.0, -1
    while True:  # each turn caps at least one more source
        full = (F.col("w") * F.lit(level) >= F.col("limit")) if capped >= 0 else F.lit(False)
        n, held, free = rows.agg(F.sum(full.cast("int")), F.sum(F.when(full, F.col("limit")).otherwise(0.0)),
                                 F.sum(F.when(full, 0.0).otherwise(F.col("w")))).first()
        if (n or 0) == capped or not free:
            break
        level, capped = (want - held) / free, n
    return rows.select("source", "source_size", F.least(F.col("w") * F.lit(level), F.col("limit")).alias("target"))


def copies(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, cap: float = CAP, seed: str = "mix") -> DataFrame:
    """One row per document: row id, doc_id, source, size, source_size, target, copies."""
    rows = saved(with_rid(docs, ["doc_id", "source", "text"]).select(
        RID, "doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"))).alias("spread")))
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    before = Window.orderBy(F.col("source").isNull(), F.col("source")).rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select("source", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    targets = source_targets(per.select("source", "source_size"), weights, total, cap) \
        .join(starts.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    ranked = global_rank(rows.withColumn("no_source", F.col("source").isNull()),
                         ["no_source", "source", "size", "spread", "doc_id", RID])
    t = targets.select(F.col("source").alias("s3"), "source_size", "target", "start")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    at = (F.col("rank") - F.col("start")).cast("double")
    offset = uniform(F.lit(seed), F.coalesce("source", F.lit("")))
    return ranked.join(t, F.col("source").eqNullSafe(F.col("s3"))).select(
        RID, "doc_id", "source", "size", "source_size", "target",
        (F.floor((at + 1) * rate + offset) - F.floor(at * rate + offset)).cast("long").alias("copies"))


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, source."""
    return copies(docs).select("doc_id", "size", "source_size", "target",
                               (F.col("copies") * F.col("size")).alias("taken"), "copies", "source")


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as it was emitted."""
    docs = docs if RID not in docs.columns else docs.withColumnRenamed(RID, RID + "_in")
    whole = with_rid(docs)
    names = whole.drop(RID).columns
    times = copies(whole.drop(RID), **params).filter("copies > 0").select(RID, F.col("copies").alias("_tl_copies"))
    return whole.join(times, RID).withColumn("_tl_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_tl_copies"))) \
        .select(*names)
