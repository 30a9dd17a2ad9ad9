"""Exact deduplication by distributed MSD radix partitioning.

Texts (white-space runs folded to one space) are compared byte by byte from the
front.  Each level splits every open group by the next digit, a run of
successive bytes whose width grows with the level, so a text of n bytes takes
about log n levels.  A group that is down to one text is settled; a group whose
texts have ended is a group of equal texts.  Keys are the bytes themselves, so
equality needs no digest.

Defined results: a null text is the empty text; empty texts form one group; of
equal texts the smallest doc_id stays, a null doc_id after all others, and of
rows with equal doc_id one; an empty table gives an empty result; other columns
are never read.

Scale: the first level moves only the first bytes of each text.  A text goes on
only when another shares them: those texts are picked out map-side by a bitmap of
fixed size and by row id, cut once into the digits of all levels, and each level
reads its own digit alone.  A hot digit (a shared first line, a group of copies) is
one row in the counts, and the join back is a plain sort-merge join of two saved
tables, whose skewed partitions AQE splits (the hints keep that plan at every size,
so a run on a part of the data tells what the whole will cost).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import RID, SPACE, met_map_side, saved, text_or_empty, with_rid

FIRST_DIGIT = 64
GROWTH = 4


def folded(text: Column) -> Column:
    """The text whose equality counts: white-space runs are one space."""
    return F.regexp_replace(text, SPACE, " ")


def _digits(texts: DataFrame, first_digit: int, growth: int) -> DataFrame:
    """Texts (row id, bytes, size) cut into the digits after the first: row id, level, digit."""
    starts, widths = [first_digit], []
    while starts[-1] < 1 << 31:
        widths.append(first_digit * growth ** len(starts))
        starts.append(starts[-1] + widths[-1])
    start, width = (F.array(*[F.lit(x) for x in v]) for v in (starts[:-1], widths))
    levels = F.filter(F.sequence(F.lit(0), F.lit(len(widths) - 1)), lambda k: F.get(start, k) < F.col("size"))
    return texts.select(RID, "bytes", F.explode(levels).alias("level")).select(
        RID, "level", F.substring("bytes", (F.get(start, F.col("level")) + 1).cast("int"), F.get(width, F.col("level")).cast("int")).alias("digit"))


def radix_groups(docs: DataFrame, first_digit: int = FIRST_DIGIT, growth: int = GROWTH) -> tuple[DataFrame, DataFrame]:
    """(rows, copies): every row with its id, doc_id and SHA-256; and for rows with
    an equal text elsewhere their group, its size and the row that stays."""
    texts = with_rid(docs, ["doc_id", "text"]).select(
        RID, "doc_id", folded(text_or_empty()).cast("binary").alias("bytes"))
    heads = saved(texts.select(RID, "doc_id", F.sha2("bytes", 256).alias("text_sha256"), F.octet_length("bytes").cast("long").alias("size"),
                               F.substring("bytes", 1, first_digit).alias("digit")))
    rows = heads.select(RID, "doc_id", "text_sha256")
    # saved tables as join sides: a hot digit or group is then a plain shuffle, which AQE splits
    shared = saved(heads.groupBy("digit").agg(F.count("*").alias("n"), F.min(RID).alias("gid")).filter("n > 1").drop("n"))
    level = saved(heads.join(shared.hint("merge"), "digit").select(RID, "doc_id", "gid", "size"))
    end, width, k = first_digit, first_digit * growth, 0
    ended = [level.filter(F.col("size") <= end).select(RID, "doc_id", "gid")]
    going = level.filter(F.col("size") > end)
    longer = texts.select(RID, "bytes", F.octet_length("bytes").alias("size")).filter(F.col("size") > first_digit)
    digits = saved(_digits(met_map_side(longer, going, RID).join(going.select(RID).hint("merge"), RID), first_digit, growth), "level")
    while going.limit(1).count():
        now = saved(digits.filter(F.col("level") == k).select(RID, "digit").join(going.hint("merge"), RID))
        groups = saved(now.groupBy("gid", "digit").agg(F.count("*").alias("n"), F.min(RID).alias("new")).filter("n > 1").drop("n"))
        level = saved(now.join(groups.hint("merge"), ["gid", "digit"]).select(RID, "doc_id", F.col("new").alias("gid"), "size"))
        end, width, k = end + width, width * growth, k + 1
        ended.append(level.filter(F.col("size") <= end).select(RID, "doc_id", "gid"))
        going = level.filter(F.col("size") > end)
    equal = ended[0]
    for more in ended[1:]:
        equal = equal.union(more)
    sizes = saved(equal.groupBy("gid").agg(F.count("*").alias("group_size"), F.min("doc_id").alias("keep_id")))
    stays = equal.join(sizes, "gid").filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))) \
        .groupBy("gid").agg(F.min(RID).alias("keep_rid"))
    copies = equal.join(saved(sizes.join(stays, "gid")), "gid").select(
        RID, "keep_id", "group_size", (F.col(RID) == F.col("keep_rid")).alias("kept"))
    return rows, copies


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, copies = radix_groups(docs)
    return rows.join(copies, RID, "left").select(
        "doc_id", F.when(F.col("kept").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    docs = docs if RID not in docs.columns else docs.withColumnRenamed(RID, RID + "_in")
    whole = with_rid(docs)
    base = whole.drop(RID)
    _, copies = radix_groups(base)
    gone = copies.filter(~F.col("kept")).select(RID)
    return whole.join(gone, RID, "left_anti").drop(RID)
