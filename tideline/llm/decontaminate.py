"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Words are runs of letters and digits (everything outside ASCII punctuation and
white space) of text with A-Z lower-cased.  A window is ``size`` consecutive
words of a benchmark item; an item of fewer words, but not none, is one window.
One scan hashes every window of every document, for each window length that the
benchmark has, and probes the broadcast set of window hashes; hits are then
compared word for word with the benchmark's windows.  A document word inside any
occurrence of a window is hit.  Either the hit spans or whole documents go.

DataFrame functions only: no Python workers.

Defined results: a null or empty text has no words and no hits; an item without
words has no window; a null item_id counts as an item named by the empty text;
repeated item rows are one item by their id; repeated document rows are judged
one by one; an empty benchmark hits nothing, an empty table gives an empty
result; other columns, whatever their names, pass through ``decontaminate``.

Scale: documents never move.  Only hits leave the scan, with one narrow row for
each document.  The hash set is dealt over several passes when it has more than
``SET_ROWS`` hashes, so what is broadcast has a fixed bound.  A passage that a
third of all documents hold is that many hits; they meet the windows in a join of
two saved tables, which AQE broadcasts or splits, and are gathered by document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.common import RID, saved, text_or_empty, with_rid

WINDOW = 10
#: Hashes in one broadcast set (8 bytes each, about 32 MB as a hash relation).
SET_ROWS = 1 << 20

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words and what lies between them, before lower-casing.
TOKENS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FIRST_WORD = r"^[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text; only A-Z is lower-cased (``lower`` does the same to a text of ASCII, faster)."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, SEPARATORS), "")


def _starts(words: str, length: int) -> Column:
    """1-based places where a window of ``length`` words can start."""
    last = F.size(words) - F.lit(length - 1)
    return F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(hash, gram, length, item): each distinct window of the items, once for each item that has it."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             words_of(text_or_empty()).alias("w")).filter(F.size("w") > 0)
    span = F.least(F.size("w"), F.lit(size))
    places = items.select("item", "w", span.alias("length"), F.explode(F.sequence(F.lit(1), F.size("w") - span + 1)).alias("at"))
    grams = places.select("item", "length", F.slice("w", F.col("at"), F.col("length")).alias("g"))
    return grams.select(_hash(F.transform("g", lambda x: F.xxhash64(x))).alias("hash"), F.array_join("g", " ").alias("gram"), "length", "item").distinct()


def _hash(word_hashes: Column) -> Column:
    return F.xxhash64(word_hashes)


def _scan(docs: DataFrame, lengths: list[int], hashes: DataFrame) -> DataFrame:
    """One row for each document (``start`` null, with n_words) and one for each window
    whose hash is in the set."""
    rows = docs.select(RID, "doc_id", words_of(text_or_empty()).alias("w"))
    rows = rows.select("*", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    at = "array<struct<start:int,length:int,hash:bigint>>"

    def windows_of(n: int) -> Column:
        return F.transform(_starts("w", n), lambda i: F.struct(
            i.alias("start"), F.lit(n).alias("length"), _hash(F.slice("h", i, F.lit(n))).alias("hash"))).cast(at)

    windows = [windows_of(n) for n in lengths]
    itself = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit(None).cast("long").alias("hash"))).cast(at)
    places = rows.select(RID, "doc_id", "w", F.inline(F.concat(itself, *windows)))
    met = places.join(F.broadcast(hashes.select("hash", F.lit(True).alias("in_set"))), "hash", "left") \
        .filter((F.col("start") == 0) | F.col("in_set"))
    inside = F.col("start") > 0
    return met.select(
        RID, F.when(~inside, F.col("doc_id")).alias("doc_id"), F.when(~inside, F.size("w").cast("long")).alias("n_words"),
        F.when(inside, F.col("start") - 1).alias("start"), "length", "hash",
        F.when(inside, F.array_join(F.slice("w", F.greatest("start", F.lit(1)), F.col("length")), " ")).alias("gram"))


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, set_rows: int = SET_ROWS) -> tuple[DataFrame, DataFrame]:
    """(documents, hits) of ``docs`` with a row id: each document with n_words, and each
    verified occurrence of a window: row id, start, length, hash, gram; with ``windows``
    of the benchmark joined to the hits by (hash, gram)."""
    windows = saved(benchmark_windows(benchmark, size))
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())
    hashes = windows.select("hash").distinct()
    passes = max(1, math.ceil(hashes.count() / set_rows))
    if not lengths:
        own = docs.select(RID, "doc_id", F.size(words_of(text_or_empty())).cast("long").alias("n_words"))
        none = own.filter("false").select(RID, F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("item"))
        return saved(own), none
    parts = [saved(_scan(docs, lengths, hashes.filter(F.pmod("hash", F.lit(passes)) == k))) for k in range(passes)]
    documents = parts[0].filter(F.col("start").isNull()).select(RID, "doc_id", "n_words")
    met = parts[0].filter(F.col("start").isNotNull())
    for p in parts[1:]:
        met = met.unionByName(p.filter(F.col("start").isNotNull()))
    hits = met.select(RID, "start", "length", "hash", "gram").join(
        windows.select("hash", "gram", "item"), ["hash", "gram"]).select(RID, "start", "length", "item")
    return documents, hits


def _islands(hits: DataFrame) -> DataFrame:
    """(row id, first, beyond): the runs of hit words of each document, which don't touch."""
    spans = hits.groupBy(RID, "start").agg(F.max(F.col("start") + F.col("length")).alias("beyond"))
    order = Window.partitionBy(RID).orderBy("start")
    before = F.max("beyond").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("opens", F.when(F.col("start") > F.coalesce(before, F.lit(-1)), 1).otherwise(0))
    runs = opened.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(RID, "run").agg(F.min("start").alias("first"), F.max("beyond").alias("beyond"))


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, set_rows: int = SET_ROWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (sorted as strings,
    comma-joined), contaminated."""
    documents, hits = scan(with_rid(docs, ["doc_id", "text"]), benchmark, size, set_rows)
    hits = saved(hits)
    covered = _islands(hits).groupBy(RID).agg(F.sum(F.col("beyond") - F.col("first")).alias("n_hit"))
    items = hits.select(RID, "item").distinct().groupBy(RID).agg(F.array_sort(F.collect_list("item")).alias("items"))
    out = documents.join(covered.join(items, RID), RID, "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"),
                      F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", size: int = WINDOW,
                  set_rows: int = SET_ROWS) -> DataFrame:
    """``docs`` without what the benchmark holds, all columns.  ``remove="documents"``
    drops contaminated documents; ``"spans"`` takes each run of hit words, and what lies
    between them, out of the text and leaves the rest as it is."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    docs = docs if RID not in docs.columns else docs.withColumnRenamed(RID, RID + "_in")
    whole = with_rid(docs)
    _, hits = scan(whole, benchmark, size, set_rows)
    if remove == "documents":
        out = whole.join(hits.select(RID).distinct(), RID, "left_anti")
    else:
        runs = _islands(hits).groupBy(RID).agg(F.array_sort(F.collect_list(F.struct("first", "beyond"))).alias("_tl_runs"))
        out = whole.join(runs, RID, "left").withColumn(
            "text", F.when(F.col("_tl_runs").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("_tl_runs")))).drop("_tl_runs")
    out = out.drop(RID)
    return out.withColumnRenamed(RID + "_in", RID) if RID + "_in" in out.columns else out


def _without(text: Column, runs: Column) -> Column:
    """A text without some runs of its words.  Words and separators alternate, so word j
    is token 2j, or 2j + 1 when a separator comes first."""
    tokens = F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0))
    lead = F.when(text.rlike(FIRST_WORD), 0).otherwise(1)
    begins = F.transform(runs, lambda r: 2 * r["first"] + lead)
    ends = F.transform(runs, lambda r: 2 * r["beyond"] - 1 + lead)  # the token after the run's last word
    kept = F.zip_with(F.concat(F.array(F.lit(0)), ends), F.concat(begins, F.array(F.size(tokens))),
                      lambda a, b: F.slice(tokens, a + 1, b - a))
    return F.array_join(F.flatten(kept), "")
