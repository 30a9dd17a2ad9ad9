"""Exact substring deduplication by level-wise doubling.

A word is removed when a window of ``window`` consecutive words covers it whose
word sequence also starts elsewhere.  Windows are found by length: the shortest
level looks at half a window, and only windows repeated there are extended to
twice the length, until the full length is reached or no candidate survives.

The first level needs no row for each position.  In each full window the
half-length run with the smallest hash is its anchor; equal windows have equal
anchors, so a window can repeat only if its anchor does, and about a tenth of all
positions are anchors.  Later levels look at every window whose anchor survived.

Defined results: a null text has no words; texts with fewer words than the
window keep them all; repeated rows are different documents and so remove each
other; an empty table gives an empty result; other columns are never read.

Scale: the rows of a level are (hash, row id, position).  Before the shuffle each
task settles the windows it has seen twice itself and sends one marker for each,
so a passage in a third of all documents is a marker per task.  Texts move once
to meet their surviving anchors; only texts that have some are kept for the rest.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm import common as C
from tideline.llm.common import RID, SPACE, WORD, saved, text_or_empty, with_rid

WINDOW = 35
#: Positions that a task gathers before it settles what repeats among them.
TALLY_ROWS = 1_000_000
ROWS = f"key long, {RID} long, pos int, run int, known boolean"
_POS = np.uint64((1 << 36) - 1)


def _anchors(half_hash: np.ndarray, window: int, half: int) -> np.ndarray:
    """For each full window the position of its half-length run with the smallest
    hash, the first of equal ones; rises with the window."""
    n = len(half_hash)
    key = (half_hash & ~_POS) | np.arange(n, dtype=np.uint64)
    span, have = window - half + 1, 1
    low = key
    while have < span:
        step = min(have, span - have)
        low = np.minimum(low[:len(low) - step], low[step:])
        have += step
    return (low & _POS).astype(np.int64)


def _documents(batch: pa.RecordBatch):
    """(index in the batch, word hashes) of each text."""
    for i, j, data, offsets in C.text_passes(batch.column("text")):
        starts, ends, rows = C.word_spans(data, offsets, ~C.SPACE_BYTES)
        words = C.span_hash(C.prefix_hash(data), starts, ends)
        at = np.searchsorted(rows, np.arange(j - i + 1))
        for r in range(j - i):
            yield i + r, words[at[r]:at[r + 1]]


class _Tally:
    """Gathers (hash, row, position) and settles locally what repeats locally."""

    def __init__(self):
        self.parts, self.n = [], 0

    def add(self, key, rid, pos):
        if len(key):
            self.parts.append((key, np.full(len(key), rid, np.int64), pos.astype(np.int32)))
            self.n += len(key)

    def flush(self):
        key, rid, pos = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.n = [], 0
        order = np.argsort(key)
        ks = key[order]
        same = ks[1:] == ks[:-1]
        dup = np.zeros(len(ks), bool)
        dup[1:] |= same
        dup[:-1] |= same
        known = np.zeros(len(ks), bool)
        known[order[dup]] = True
        markers = np.unique(ks[dup])
        k = np.flatnonzero(known)
        if len(k):  # consecutive positions of one document are one row
            cut = np.flatnonzero(np.concatenate(([True], (rid[k][1:] != rid[k][:-1]) | (pos[k][1:] != pos[k][:-1] + 1))))
            run = np.diff(np.append(cut, len(k))).astype(np.int32)
            k = k[cut]
        else:
            run = np.zeros(0, np.int32)
        s = np.flatnonzero(~known)
        spread = C.mix64(rid[k].astype(np.uint64) * C.STEP[5] + pos[k].astype(np.uint64))
        m = len(markers)
        rids = pa.array(np.concatenate((rid[s], rid[k], np.zeros(m, np.int64))),
                        mask=np.concatenate((np.zeros(len(s) + len(k), bool), np.ones(m, bool))))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((key[s], spread, markers)).view(np.int64)), rids,
             pa.array(np.concatenate((pos[s], pos[k], np.full(m, -1, np.int32)))),
             pa.array(np.concatenate((np.ones(len(s), np.int32), run, np.zeros(m, np.int32)))),
             pa.array(np.concatenate((np.zeros(len(s), bool), np.ones(len(k), bool), np.zeros(m, bool))))],
            names=["key", RID, "pos", "run", "known"])


def _anchor_rows(window: int, half: int):
    def rows(batches):
        tally = _Tally()
        for batch in batches:
            rids = batch.column(RID).to_numpy()
            for r, words in _documents(batch):
                if len(words) >= window:
                    h = C.window_hash(words, half)
                    at = np.unique(_anchors(h, window, half))
                    tally.add(h[at], rids[r], at)
                if tally.n >= TALLY_ROWS:
                    yield tally.flush()
        if tally.n:
            yield tally.flush()
    return rows


def _marked(spans, n: int) -> np.ndarray:
    """The positions that (pos, run) spans hold, as a mask."""
    edge = np.zeros(n + 1, np.int32)
    pos, run = spans
    np.add.at(edge, pos, 1)
    np.add.at(edge, np.minimum(pos + run, n), -1)
    return np.cumsum(edge[:n]) > 0


def _span_lists(column: pa.ListArray):
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = column.offsets.to_numpy()
    flat = column.values
    pos, run = flat.field("pos").to_numpy(), flat.field("run").to_numpy()
    for r in range(len(column)):
        yield pos[at[r]:at[r + 1]], run[at[r]:at[r + 1]]


def _window_rows(window: int, half: int, length: int, shorter: int | None):
    """Windows of ``length`` words that may repeat: those whose anchor survived, or
    (``shorter``) whose two windows of the level before did."""
    def rows(batches):
        tally = _Tally()
        for batch in batches:
            rids = batch.column(RID).to_numpy()
            spans = list(_span_lists(batch.column("spans")))
            for r, words in _documents(batch):
                if len(words) >= window:
                    if shorter is None:
                        alive = _marked(spans[r], len(words))[_anchors(C.window_hash(words, half), window, half)]
                    else:
                        m = _marked(spans[r], len(words) - shorter + 1)
                        alive = m[:len(words) - length + 1] & m[length - shorter:]
                    at = np.flatnonzero(alive)
                    tally.add(C.window_hash(words, length)[at], rids[r], at)
                if tally.n >= TALLY_ROWS:
                    yield tally.flush()
        if tally.n:
            yield tally.flush()
    return rows


def _survivors(rows: DataFrame) -> DataFrame:
    """Per document the (pos, run) spans of windows that start anywhere else too."""
    return rows.withColumn("n", F.count("*").over(Window.partitionBy("key"))) \
        .filter(f"{RID} IS NOT NULL AND (known OR n > 1)") \
        .groupBy(RID).agg(F.collect_list(F.struct("pos", "run")).alias("spans"))


def _cut(window: int):
    def rows(batches):
        for batch in batches:
            spans = list(_span_lists(batch.column("spans")))
            texts = batch.column("text")
            kept, gone, counts, cuts = [], [], [], []
            for i, j, data, offsets in C.text_passes(texts):
                starts, ends, rws = C.word_spans(data, offsets, ~C.SPACE_BYTES)
                raw = data.tobytes()
                at = np.searchsorted(rws, np.arange(j - i + 1))
                for r in range(j - i):
                    a, b = at[r], at[r + 1]
                    pos, run = spans[i + r]
                    drop = _marked((pos, run + (window - 1)), b - a)
                    keep = np.flatnonzero(~drop) + a
                    kept.append(b" ".join([raw[x:y] for x, y in zip(starts[keep].tolist(), ends[keep].tolist())]).decode("utf-8", "replace"))
                    gone.append(int(drop.sum()))
                    counts.append(int(b - a))
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], drop.astype(np.int8), [0]))))
                    cuts.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(cuts, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                names=["doc_id", "n_words", "n_removed", "kept", "removed"])
    return rows


def lengths(window: int, first: int) -> list[int]:
    """Window lengths after the first level: each twice the one before, the last
    ``window`` itself."""
    out, n = [], first
    while n < window or not out:
        n = min(2 * n, window)
        out.append(n)
    return out


def substring_dedup(docs: DataFrame, window: int = WINDOW, kept_as: Callable[[Column], Column] = lambda t: t) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the kept words joined
    by one space, through ``kept_as``), removed (spans of word numbers, end open)."""
    half = (window + 1) // 2
    texts = with_rid(docs, ["doc_id", "text"])
    anchors = _survivors(texts.select(RID, "text").mapInArrow(_anchor_rows(window, half), ROWS))
    plain = F.trim(F.regexp_replace(text_or_empty(), SPACE, " "))
    touched = F.col("spans").isNotNull()
    met = saved(texts.join(anchors, RID, "left").select(
        RID, "doc_id", "spans", F.when(touched, F.col("text")).alias("text"),
        F.when(~touched, F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")).alias("n_words"),
        F.when(~touched, kept_as(plain)).alias("kept")))
    some = met.filter("spans IS NOT NULL")
    spans, shorter = some.select(RID, "text", "spans"), None
    for length in lengths(window, half):
        found = saved(_survivors(spans.mapInArrow(_window_rows(window, half, length, shorter), ROWS)))
        spans, shorter = some.select(RID, "text").join(found, RID), length
    none = F.array().cast("array<struct<pos:int,run:int>>")
    cut = some.select(RID, "doc_id", "text").join(found, RID, "left") \
        .select("doc_id", "text", F.coalesce("spans", none).alias("spans")) \
        .mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept string, "
                                  "removed array<struct<start:int,end:int>>")
    whole = met.filter("spans IS NULL").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept",
        F.array().cast("array<struct<start:int,end:int>>").alias("removed"))
    return whole.union(cut.withColumn("kept", kept_as(F.col("kept"))))
