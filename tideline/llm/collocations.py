"""Phrase collocations from weighted acyclic automata.

A shard is a run of texts of one language in a task.  Its words start a path each: the
word and the words after it inside the piece, three at most.  The sorted paths with their
counts build the shard's count transducer incrementally: an arc opens where a
path leaves its predecessor, and a closed last state is looked up in a register,
so equal ones are kept once.  The weight of a prefix is the sum of the paths below
it, so one transducer holds the counts of phrases of one, two and three words.

The transducers are cut at prefixes into ranges of about ``RANGE_PATHS`` paths
each; one task unites the cuts of a range and sums their weights.  A prefix that a
boundary cuts, and every first word that may go on, is summed once more over the
ranges.  What has the least count makes the corpus transducer, a table of
(lang, phrase, count); composing it with the cuts of a candidate looks up the parts.

Words are runs of anything but blank and tab in pieces between
``. , ; : ! ?`` and line ends, with A-Z lower-cased; counts are per language (null: und).
Scores are exact integers (decimal arithmetic of 38 digits).

Defined results: a null or empty text has no words; repeated rows count again; of
equal scores the larger count goes first, then the smaller phrase by bytes; of
equal cuts the first; a language without candidates has no row; an empty table
gives an empty result; other columns are never read.

Scale: texts are read once and don't move.  Ranges are cut at quantiles of all
paths (every ``HEAD``-th path of each shard), not by word, so a word that starts a
third of all paths spans many ranges.  The boundaries handed to the tasks are one
path for ``RANGE_PATHS`` paths.  Later joins hold phrases of the least count only.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm import common as C
from tideline.llm.common import global_rank, saved
from tideline.llm.ship import ship

MIN_COUNT = 10
TOP = 2000
#: A candidate goes when a longer one around it has this share of its count.
INSIDE_PERCENT = 50
#: Bytes of text counted at once; a longer text is cut between pieces.
SHARD_BYTES = 8 << 20
#: Paths of a shard: a task unites the transducers of its texts until they have so many.
SHARD_PATHS = 2_000_000
RANGE_PATHS = 1_000_000
HEAD = 4096

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False

SHARD = "lang string, machine binary, heads array<array<binary>>"
CUT = "lang string, part int, machine binary"
COUNTED = "lang string, words array<binary>, n long"


# ---------------------------------------------------------------- transducers
class Paths:
    """Sorted distinct paths: words in byte order, codes from 1 (0: the path ended), counts."""

    def __init__(self, words: pa.Array, c1, c2, c3, n):
        self.words, self.c1, self.c2, self.c3, self.n = words, c1, c2, c3, n

    def __len__(self):
        return len(self.n)

    @cached_property
    def names(self) -> list[bytes]:
        return self.words.to_pylist()

    def between(self, lo: int, hi: int) -> Paths:
        """A run of the paths, with the words that it needs."""
        c1, c2, c3 = self.c1[lo:hi], self.c2[lo:hi], self.c3[lo:hi]
        used = np.zeros(len(self.words) + 1, bool)
        for c in (c1, c2, c3):
            used[c] = True
        used[0] = True
        code = np.cumsum(used) - 1
        return Paths(self.words.take(pa.array(np.flatnonzero(used)[1:] - 1)), code[c1], code[c2], code[c3], self.n[lo:hi])

    def head(self, i: int) -> list[bytes]:
        return [self.words[c - 1].as_py() for c in (int(self.c1[i]), int(self.c2[i]), int(self.c3[i])) if c]

    def find(self, path: list[bytes]) -> int:
        """Where a path stands, or would stand."""
        lo, hi = 0, len(self)
        for k, c in enumerate((self.c1, self.c2, self.c3)):
            word = path[k] if k < len(path) else None
            at = bisect_left(self.names, word) if word is not None else -1
            code = at + 1
            lo, last = lo + int(np.searchsorted(c[lo:hi], code)), lo + int(np.searchsorted(c[lo:hi], code, "right"))
            if word is not None and (at >= len(self.names) or self.names[at] != word):
                return lo
            hi = last
        return lo


def summed(words: pa.Array, c1, c2, c3, n=None) -> Paths:
    """Paths in order, equal ones as one with their counts summed."""
    v = len(words) + 1
    if v ** 3 < 1 << 63:
        key = (c1.astype(np.int64) * v + c2) * v + c3
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
    else:
        order = np.lexsort((c3, c2, c1))
        a, b, c = c1[order], c2[order], c3[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
    first = np.flatnonzero(new)
    at = order[first]
    n = np.diff(np.append(first, len(order))) if n is None else np.add.reduceat(n[order], first) if len(first) else n
    return Paths(words, c1[at], c2[at], c3[at], np.asarray(n, np.int64))


def coded(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words in byte order, code of each value from 1)."""
    d = values.dictionary_encode()
    order = pc.array_sort_indices(d.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(1, len(order) + 1)
    return d.dictionary.take(order), rank[d.indices.to_numpy()] if len(values) else np.zeros(0, np.int64)


def built(p: Paths) -> dict:
    """The transducer of sorted paths.  Arcs of the start state: ``one``, with ``fan`` arcs
    in the state behind; their labels ``two`` and states ``target``; the register of last
    states: ``out`` arcs each, with labels ``three`` (0: ended) and ``weight``."""
    new1 = np.ones(len(p), bool)
    new1[1:] = p.c1[1:] != p.c1[:-1]
    new2 = new1.copy()
    new2[1:] |= p.c2[1:] != p.c2[:-1]
    at = np.flatnonzero(new2)
    size = np.diff(np.append(at, len(p)))
    target = np.empty(len(at), np.int64)
    single = size == 1
    # a state of one arc is its label and weight
    only, inverse = np.unique(p.n[at[single]] * (len(p.words) + 1) + p.c3[at[single]], return_inverse=True)
    target[single] = inverse
    out, three, weight = [np.ones(len(only), np.int64)], [only % (len(p.words) + 1)], [only // (len(p.words) + 1)]
    register, many = {}, np.flatnonzero(~single)
    for k, i, j in zip(many.tolist(), at[many].tolist(), (at[many] + size[many]).tolist()):
        state = (p.c3[i:j].tobytes(), p.n[i:j].tobytes())
        known = register.get(state)
        if known is None:
            known = register[state] = len(only) + len(register)
            out.append([j - i])
            three.append(p.c3[i:j])
            weight.append(p.n[i:j])
        target[k] = known
    first = np.flatnonzero(new1)
    fan = np.add.reduceat(new2.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    return {"words": p.words, "one": p.c1[first], "fan": fan, "two": p.c2[at], "target": target,
            "out": np.concatenate(out), "three": np.concatenate(three), "weight": np.concatenate(weight)}


ARCS = ("one", "fan", "two", "target", "out", "three", "weight")


def packed(m: dict) -> bytes:
    """A transducer as compressed bytes: sizes, words (none holds a blank), arcs byte by byte."""
    words = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(m["words"])], pa.int32()), m["words"]), b" ")[0].as_py() \
        if len(m["words"]) else b""
    planes = [np.asarray(m[f], np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for f in ARCS]
    sizes = np.array([len(m["words"]), len(words), *[len(m[f]) for f in ARCS]], np.int64)
    body = words + b"".join(planes)
    return sizes.tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> dict:
    k = 8 * (2 + len(ARCS))
    n_words, n_bytes, *sizes = np.frombuffer(data[:k], np.int64).tolist()
    body = pa.decompress(data[k:], n_bytes + 8 * sum(sizes), codec="zstd", asbytes=True)
    m = {"words": pa.array(body[:n_bytes].split(b" ") if n_words else [], pa.binary())}
    for f, n in zip(ARCS, sizes):
        arcs = np.frombuffer(body, np.uint8, 8 * n, n_bytes).reshape(8, n).T.copy().view(np.int64).reshape(-1)
        m[f] = arcs if f == "weight" else arcs.astype(np.int32)
        n_bytes += 8 * n
    return m


def expanded(m: dict) -> tuple[np.ndarray, ...]:
    """The paths of a transducer: codes of the three words and weight."""
    out, target = m["out"], m["target"]
    size, starts = out[target], np.cumsum(out) - out
    total = int(size.sum())
    arc = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts[target], size)
    c1 = np.repeat(np.repeat(m["one"], m["fan"]), size)
    return c1, np.repeat(m["two"], size), m["three"][arc], m["weight"][arc]


def united(machines: list[dict]) -> Paths:
    """The union of transducers: weights of equal paths are summed."""
    words, code = coded(pa.concat_arrays([m["words"] for m in machines]) if machines else pa.array([], pa.binary()))
    code, total = code.astype(np.int32), sum(int(m["out"][m["target"]].sum()) for m in machines)
    c1, c2, c3, n = (np.empty(total, t) for t in (np.int32, np.int32, np.int32, np.int64))
    base = at = 0
    for m in machines:
        own = np.concatenate([np.zeros(1, np.int32), code[base:base + len(m["words"])]])
        base += len(m["words"])
        a, b, c, w = expanded(m)
        to = slice(at, at + len(w))
        c1[to], c2[to], c3[to], n[to], at = own[a], own[b], own[c], w, to.stop
    return summed(words, c1, c2, c3, n)


# -------------------------------------------------------------------- shards
def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, row offsets, rows) of a pass; a text longer than a shard is cut between pieces."""
    if len(data) <= SHARD_BYTES or len(offsets) > 2:
        yield data, offsets, np.arange(len(offsets) - 1)
        return
    ends, lo = np.flatnonzero(_BREAK[data]), 0
    while lo < len(data):
        hi = len(data)
        if hi - lo > SHARD_BYTES:
            k = int(np.searchsorted(ends, lo + SHARD_BYTES, "right")) - 1
            k = k if k >= 0 and ends[k] >= lo else int(np.searchsorted(ends, lo))
            hi = int(ends[k]) + 1 if k < len(ends) else hi
        yield data[lo:hi], np.array([0, hi - lo]), np.zeros(1, np.int64)
        lo = hi


def _shard(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, names: list[str]) -> Iterator[tuple[str, Paths]]:
    """The sorted paths of a shard by language."""
    starts, ends, rows = C.word_spans(data, offsets, _WORD)
    if not len(starts):
        return
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32 if len(data) < 1 << 31 else np.int64)
    kind = pa.binary() if at.dtype == np.int32 else pa.large_binary()
    values = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(at), pa.py_buffer(C.LOWER[data[_WORD[data]]])])
    words, code = coded(values)
    words = words.cast(pa.binary())
    piece = np.cumsum(_BREAK[data])[starts]
    on = np.zeros(len(starts) + 2, bool)
    on[:len(starts) - 1] = (rows[1:] == rows[:-1]) & (piece[1:] == piece[:-1])
    after = np.concatenate([code, [0, 0]])
    c2 = np.where(on[:-2], after[1:-1], 0)
    c3 = np.where(on[:-2] & on[1:-1], after[2:], 0)
    own = langs[rows]
    for k in np.unique(own):
        mine = own == k
        p = summed(words, code[mine], c2[mine], c3[mine])
        yield names[k], p if mine.all() else p.between(0, len(p))


def _sharder(head: int):
    """Shard transducers of a task's texts, with every ``head``-th path."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        paths: Counter = Counter()

        def shard(lang: str) -> pa.RecordBatch:
            machines = held.pop(lang)
            del paths[lang]
            p = united([unpacked(m) for m in machines])
            heads = [p.head(k) for k in range(head // 2, len(p), head)]
            return _emit(_SHARD_ARROW, lang=lang, heads=heads, machine=machines[0] if len(machines) == 1 else packed(built(p)))

        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            for i, j, data, offsets in C.text_passes(batch.column("text"), SHARD_BYTES):
                for bytes_, at, rows in _segments(data, offsets):
                    for lang, p in _shard(bytes_, at, codes[i:j][rows], names):
                        held.setdefault(lang, []).append(packed(built(p)))
                        paths[lang] += len(p)
                    while paths.total() >= SHARD_PATHS:
                        yield shard(max(paths, key=lambda x: (paths[x], x)))
        for lang in sorted(held):
            yield shard(lang)
    return shards


def _emit(schema: pa.Schema, **row) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)


_SHARD_ARROW = pa.schema([("lang", pa.string()), ("machine", pa.binary()), ("heads", pa.list_(pa.list_(pa.binary())))])
_CUT_ARROW = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("machine", pa.binary())])


# --------------------------------------------------------------------- union
def _cutter(bounds: dict[str, list[tuple[int, list[bytes]]]], firsts: dict[str, int]):
    """Cuts shard transducers at the boundaries of their language; ``firsts`` numbers the
    first range of each."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                lang = batch.column("lang")[r].as_py()
                m = unpacked(batch.column("machine")[r].as_py())
                p = Paths(m["words"], *expanded(m))
                mine = bounds.get(lang, [])
                at = [0, *[p.find(b) for b in mine], len(p)]
                for k, (lo, hi) in enumerate(zip(at, at[1:])):
                    if hi > lo:
                        yield _emit(_CUT_ARROW, lang=lang, part=firsts[lang] + k, machine=packed(built(p.between(lo, hi))))
    return cut


def _unite(least: int):
    def unite(table: pa.Table) -> pa.Table:
        p = united([unpacked(x.as_py()) for x in table.column("machine")])
        rows, n = [[]], [int(p.n.sum())]
        for k in (1, 2, 3):
            cs = [p.c1, p.c2, p.c3][:k]
            new = np.zeros(len(p), bool)
            new[:1] = True
            for c in cs:
                new[1:] |= c[1:] != c[:-1]
            at = np.flatnonzero(new)
            count = np.add.reduceat(p.n, at)
            want = count >= least
            if k < 3:  # a boundary may have cut the first and the last prefix
                want[[0, -1]] = True
            want &= cs[-1][at] > 0
            for i, c in zip(at[want].tolist(), count[want].tolist()):
                rows.append([p.names[x[i] - 1] for x in cs])
                n.append(c)
        lang = table.column("lang")[0].as_py()
        return pa.table({"lang": pa.array([lang] * len(n), pa.string()), "words": pa.array(rows, pa.list_(pa.binary())),
                         "n": pa.array(n, pa.int64())})
    return unite


def corpus_transducer(docs: DataFrame, least: int = MIN_COUNT, range_paths: int = RANGE_PATHS, head: int = HEAD) -> DataFrame:
    """(lang, phrase, size, n): the count of every phrase of one to three words found
    ``least`` times or more, and with size 0 the words of each language."""
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    shards = saved(rows.mapInArrow(_sharder(head), SHARD))
    heads = shards.select("lang", F.explode("heads").alias("head"))
    step = max(1, range_paths // head)
    # ranges don't cross languages; a language with few paths is one range
    ranked = global_rank(heads, ["lang", "head"])
    bounds: dict[str, list[list[bytes]]] = {}
    for r in ranked.filter(F.col("rank") % step == step - 1).orderBy("rank").collect():
        mine = bounds.setdefault(r["lang"], [])
        head = [bytes(w) for w in r["head"]]
        if not mine or mine[-1] != head:
            mine.append(head)
    langs = sorted(r[0] for r in shards.select("lang").distinct().collect())
    firsts, n = {}, 0
    for lang in langs:
        firsts[lang] = n
        n += len(bounds.get(lang, [])) + 1
    cuts = shards.drop("heads").mapInArrow(_cutter(bounds, firsts), CUT)
    parts = cuts.groupBy("part").applyInArrow(_unite(least), COUNTED)
    phrase = F.array_join(F.transform("words", lambda w: w.cast("string")), " ")
    return parts.select("lang", phrase.alias("phrase"), F.size("words").alias("size"), "n") \
        .groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("size") == 0))


# ------------------------------------------------------------------- phrases
def _joined(words: Column, first, n) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def composed(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidates with l, r and score of their lowest-scoring cut: the parts of each cut
    are looked up in the counts."""
    w = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "a", w.alias("w"), F.explode(F.sequence(F.lit(1), F.size(w) - 1)).alias("k")) \
        .select("lang", "phrase", "a", "k", _joined("w", F.lit(1), F.col("k")).alias("first"),
                _joined("w", F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))
    found = counts.filter("size > 0").select("lang", "phrase", "n")
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"]) \
        .join(found.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    score = F.expr("div(a2, lr)")
    cuts = cuts.withColumn("a2", (wide["a"] * wide["a"]).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")) \
        .withColumn("lr", wide["l"] * wide["r"]).withColumn("score", score)
    return cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")) \
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP, inside_percent: int = INSIDE_PERCENT,
                 range_paths: int = RANGE_PATHS, head: int = HEAD) -> DataFrame:
    """The first ``top`` phrases of two and three words of each language: lang, rank,
    phrase, a, l, r, n, score."""
    counts = saved(corpus_transducer(docs, least, range_paths, head))
    candidates = counts.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"))
    w = F.split("phrase", " ")
    around = candidates.filter("size = 3").select("lang", "a", F.explode(F.array_distinct(F.array(
        _joined(w, F.lit(1), F.lit(2)), _joined(w, F.lit(2), F.lit(2))))).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    scored = saved(composed(candidates, counts))
    stays = scored.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * inside_percent))
    totals = counts.filter("size = 0").select("lang", F.col("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return stays.drop("longer").withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top) \
        .join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
