"""Toxicity by nearest labelled examples.

Examples are a bounded sample of labelled training documents.  Terms are all words
and word beginnings of the examples; their weights are TF-IDF with document
frequencies of the whole corpus, times a factor that grows with the term's chi-square
against the label and is 1 for a term that has nothing to do with it.  A document's
neighbours are its ``K`` nearest examples by exact cosine, found with an inverted
index: terms that many examples hold are a dense matrix, multiplied for many
documents at once; what the other terms can add to an example is bounded by the
lengths of both, and only if that leaves too many examples their postings are added.
What may be among the nearest is then computed exactly.  Neighbours vote by closeness;
the votes are calibrated on the examples themselves, each scored without itself.

Defined results: a null or empty text, and a text without any of the examples' terms,
gets the rate of toxic examples among examples without terms; without labelled
examples every score is 0.5; several labels of a doc_id count as toxic if one is;
a null label or doc_id is not learned from and a null doc_id is not held out;
equal cosines are ordered by example; repeated rows are scored alike.  A term that no
example holds has no weight.

Scale: the sample (``MAX_EXAMPLES`` labels, the first by hash, as far as ``MAX_TERMS``
terms go) bounds everything that is broadcast, in rows and in bytes.  The corpus is read twice, for document frequencies (one row per term
and task moves) and for scores; nothing else of it moves.
The driver holds one gathered table at a time and nothing of the model once it is sent;
``drop_toxic`` saves the row ids that go and destroys the model.
"""

from __future__ import annotations

import ctypes
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm import common as C
from tideline.llm.common import RID, saved, with_rid

MAX_EXAMPLES = 20_000
#: Terms of all examples together (a term counts once for each example that holds it); an
#: example of more than a hundredth of them is not taken.
MAX_TERMS = 3_000_000
K = 15
#: Terms that a larger share of the examples holds are columns of the dense matrix.
WIDE = 0.06
#: Documents that meet the dense matrix at once.
TOGETHER = 256
#: Beyond any rounding error of single-precision sums of at most 1.
SLACK = 1e-4
TOXIC = 0.7
FOLDS, HELD_FOLD = 3, 1
#: Word beginnings of so many bytes are terms too.
BEGINNINGS = (4, 6)
BINS = 40
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _terms(column: pa.Array):
    """(first row, rows, row of each term, term hash) by passes over the texts."""
    for i, j, data, offsets in C.text_passes(column):
        starts, ends, rows = C.word_spans(data, offsets, _LETTER)
        prefix = C.prefix_hash(data, C.LOWER)
        parts, at = [C.span_hash(prefix, starts, ends)], [rows]
        for n in BEGINNINGS:
            long = ends - starts > n
            parts.append(C.mix64(C.span_hash(prefix, starts[long], starts[long] + n) ^ C.STEP[9]))
            at.append(rows[long])
        yield i, j - i, np.concatenate(at), np.concatenate(parts)


def _presence(batches):
    """Documents of each label that hold a term."""
    for batch in batches:
        toxic = np.array(batch.column("toxic").to_pylist(), np.int64)
        for i, n, row, term in _terms(batch.column("text")):
            order = np.lexsort((row, term))
            t, r = term[order], row[order]
            once = np.concatenate(([True], (t[1:] != t[:-1]) | (r[1:] != r[:-1]))) if len(t) else np.zeros(0, bool)
            t, y = t[once], toxic[i + r[once]]
            names, back = np.unique(t, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(np.bincount(back, y, len(names)).astype(np.int64)),
                 pa.array(np.bincount(back, 1 - y, len(names)).astype(np.int64))], names=["term", "n1", "n0"])


def _sizes(batches):
    """How many distinct terms each document holds."""
    for batch in batches:
        for i, n, row, term in _terms(batch.column("text")):
            order = np.lexsort((term, row))
            r, t = row[order], term[order]
            once = np.ones(len(r), bool)
            once[1:] = (r[1:] != r[:-1]) | (t[1:] != t[:-1])
            yield pa.RecordBatch.from_arrays([batch.column(RID).slice(i, n), batch.column("doc_id").slice(i, n),
                                              pa.array(np.bincount(r[once], minlength=n).astype(np.int64))], names=[RID, "doc_id", "n"])


def _counts(vocabulary: np.ndarray, extra: list[str]):
    """Per document the numbers (places in the sorted vocabulary) and counts of its terms."""
    def rows(batches):
        for batch in batches:
            for i, n, row, term in _terms(batch.column("text")):
                at, ids, counts = np.zeros(n + 1, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)
                if len(vocabulary):
                    place = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
                    hit = vocabulary[place] == term
                    key, c = np.unique(row[hit] * len(vocabulary) + place[hit], return_counts=True)
                    at[1:] = np.searchsorted(key // len(vocabulary), np.arange(1, n + 1))
                    ids, counts = (key % len(vocabulary)).astype(np.int32), c.astype(np.int32)
                offsets = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, n) for c in extra] + [pa.ListArray.from_arrays(offsets, pa.array(ids)),
                                                                    pa.ListArray.from_arrays(offsets, pa.array(counts))],
                    names=[*extra, "ids", "counts"])
    return rows


def _document_counts(shared):
    """(term number, documents that hold it) of each task."""
    def rows(batches):
        vocabulary = shared.value
        total = np.zeros(len(vocabulary), np.int64)
        for batch in _counts(vocabulary, [])(batches):
            total += np.bincount(batch.column("ids").values.to_numpy(), minlength=len(vocabulary))
        held = np.flatnonzero(total)
        for i in range(0, len(held), 100_000):
            part = held[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["id", "n"])
    return rows


def one_thread() -> None:
    """A task has one core: numpy's OpenBLAS, if it is that, shall not spin on others."""
    try:
        with open("/proc/self/maps") as maps:
            for path in {line.split(maxsplit=5)[5].strip() for line in maps if "openblas" in line}:
                lib = ctypes.CDLL(path)
                for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
                    if hasattr(lib, name):
                        getattr(lib, name)(1)
    except OSError:
        pass


def _kth(scores: np.ndarray, k: int) -> float:
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) > k else 0.0


class BlockMaxIndex:
    """Exact top-k by cosine over weighted example vectors.  Each example is a block
    of its own, bounded by its dense part and the length of the rest."""

    def __init__(self, vectors, n_terms: int):
        parts = [(np.asarray(ids, np.int32), np.asarray(w, np.float64)) for ids, w in vectors]
        none = np.zeros(0, np.int32), np.zeros(0)
        self.fill(np.concatenate(([0], np.cumsum([len(ids) for ids, _ in parts], dtype=np.int64))),
                  np.concatenate([none[0], *(ids for ids, _ in parts)]), np.concatenate([none[1], *(w for _, w in parts)]), np.ones(len(parts)), n_terms)

    def fill(self, at: np.ndarray, ids: np.ndarray, values, unit: np.ndarray, n_terms: int):
        """Example e has the terms ids[at[e]:at[e + 1]]; ``values[places] / unit[e]`` are their weights."""
        self.at, self.ids, self.values, self.unit = at, ids, values, unit
        n = self.n = len(at) - 1
        held = np.bincount(ids, minlength=n_terms)
        wide = np.flatnonzero(held > WIDE * n)
        self.column = np.full(n_terms, -1, np.int32)
        self.column[wide] = np.arange(len(wide))
        held[wide] = 0
        self.starts = np.concatenate(([0], np.cumsum(held)))
        self.wide = np.zeros((len(wide), n), np.float32)
        self.length = np.zeros(n, np.float32)
        term, slots, weights = (np.zeros(self.starts[-1], t) for t in (np.int32, np.int32, np.float32))
        done = 0
        for i in range(0, n, 512):  # few at a time, for memory
            j = min(i + 512, n)
            place = np.arange(at[i], at[j])
            slot, column = np.repeat(np.arange(i, j), np.diff(at[i:j + 1])), self.column[ids[at[i]:at[j]]]
            v = values[place] / unit[slot]
            self.wide[column[column >= 0], slot[column >= 0]] = v[column >= 0]
            rest = column < 0
            self.length[i:j] = np.sqrt(np.bincount(slot[rest] - i, v[rest] ** 2, minlength=j - i))
            to = slice(done, done + int(rest.sum()))
            term[to], slots[to], weights[to], done = ids[place[rest]], slot[rest], v[rest], to.stop
        order = np.argsort(term, kind="stable")
        # example and weight side by side, so that a term's postings are one slice
        self.postings = np.stack([slots[order], weights[order].view(np.int32)], 1)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a positive cosine, best first,
        equal ones by example."""
        return next(self.nearest_each([(terms, weights)], k, [without]))

    def nearest_each(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int]):
        """``nearest`` of each query."""
        self.query = np.zeros(len(self.column))
        for i in range(0, len(queries), TOGETHER):
            some = queries[i:i + TOGETHER]
            rows = np.zeros((len(some), len(self.wide)), np.float32)
            for row, (terms, weights) in zip(rows, some):
                column = self.column[terms]
                row[column[column >= 0]] = weights[column >= 0]
            dense = rows @ self.wide
            for (terms, weights), part, skip in zip(some, dense, without[i:i + TOGETHER]):
                yield self._nearest(terms, weights, part, k, skip)

    def _nearest(self, terms, weights, part, k, without):
        if not len(terms) or not self.n:
            return np.zeros(0, np.int64), np.zeros(0)
        rest = self.column[terms] < 0
        more, w = terms[rest], weights[rest]
        if without >= 0:
            part[without] = -1
        found = np.flatnonzero(part + np.float32(np.sqrt((w * w).sum())) * self.length >= _kth(part, k) - SLACK)
        if len(found) > 4 * k:
            a, b = self.starts[more], self.starts[more + 1]
            held = np.flatnonzero(b > a)
            if len(held):
                met = np.concatenate([self.postings[x:y] for x, y in zip(a[held].tolist(), b[held].tolist())])
                part = part + np.bincount(met[:, 0], met[:, 1].copy().view(np.float32) * np.repeat(w[held], b[held] - a[held]), self.n)
                if without >= 0:
                    part[without] = -1
            found = np.flatnonzero((part > 0) & (part >= _kth(part, k) - SLACK))
        found = found[(found != without) & (self.at[found + 1] > self.at[found])]
        if not len(found):
            return np.zeros(0, np.int64), np.zeros(0)
        self.query[terms] = weights
        c = np.array([self.query[self.ids[x:y]] @ self.values[x:y] for x, y in zip(self.at[found].tolist(), self.at[found + 1].tolist())])
        c = np.round(c / self.unit[found], 12)
        self.query[terms] = 0
        found, c = found[c > 0], c[c > 0]
        best = np.lexsort((found, -c))[:k]
        return found[best], np.minimum(c[best], 1.0)


def weigh(ids, counts, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF vector."""
    ids = np.asarray(ids, np.int64)
    w = (1 + np.log(np.asarray(counts, np.float64))) * idf[ids]
    return ids, w / np.sqrt((w * w).sum()) if len(w) else w


def closeness(cosines: np.ndarray, k: int) -> np.ndarray:
    """Weights of neighbours by distance (Dudani): 1 for the nearest, falling to 0 for the
    k-th; with fewer than ``k`` neighbours to 0 at cosine 0."""
    low = cosines[-1] if len(cosines) == k else 0.0
    high = cosines[0]
    return np.ones(len(cosines)) if high <= low else (cosines - low) / (high - low)


class Model:
    """What tasks receive: the examples' terms and counts, bounded by MAX_EXAMPLES.
    Each worker builds its index once."""

    def __init__(self, examples: pa.Table, vocabulary: np.ndarray, weight: np.ndarray):
        self.vocabulary, self.weight = vocabulary, weight
        self.doc = examples["doc_id"].to_numpy().astype(np.int64)
        self.toxic = examples["toxic"].to_numpy().astype(np.float64)
        lists = [examples[c].combine_chunks() for c in ("ids", "counts")] if len(self.doc) else []
        self.at = np.concatenate(([0], np.cumsum(lists[0].value_lengths().to_numpy(), dtype=np.int64))) if lists else np.zeros(1, np.int64)
        self.ids, self.counts = (x.flatten().to_numpy() for x in lists) if lists else (np.zeros(0, np.int32),) * 2
        empty = np.diff(self.at) == 0
        self.rate = (self.toxic.sum() + 0.5) / (len(self.toxic) + 1)
        self.rate_empty = (self.toxic[empty].sum() + self.rate) / (empty.sum() + 1)
        self.grid = self.fit = self._index = None

    def forget(self) -> None:
        """Only the rates stay, for ``calibrate``: the tasks have the rest."""
        self.vocabulary = self.weight = self.doc = self.toxic = self.at = self.ids = self.counts = None

    def example(self, e: int) -> tuple[np.ndarray, np.ndarray]:
        return self.ids[self.at[e]:self.at[e + 1]], self.counts[self.at[e]:self.at[e + 1]]

    @property
    def index(self) -> BlockMaxIndex:
        if self._index is None:
            one_thread()
            self._index = BlockMaxIndex.__new__(BlockMaxIndex)
            values = (1 + np.log(self.counts.astype(np.float64))) * self.weight[self.ids]
            norms = (np.sqrt((values[a:b] ** 2).sum()) for a, b in zip(self.at[:-1], self.at[1:]))
            self._index.fill(self.at, self.ids, values, np.fromiter(norms, np.float64, len(self.doc)), len(self.weight))
        return self._index

    def votes(self, documents: list, without: list[int] | None = None):
        """(share of votes for toxic, evidence) of each (ids, counts)"""
        near = self.index.nearest_each([weigh(*d, self.weight) for d in documents], K, without or [-1] * len(documents))
        for e, c in near:
            if not len(e):
                yield self.rate_empty, []
                continue
            w = closeness(c, K)
            yield float((w @ self.toxic[e] + self.rate) / (w.sum() + 1)), list(zip(e.tolist(), c.tolist()))

    def calibrate(self, bins):
        """Rising fit of the toxic rate to the vote (pool adjacent violators) from (vote, examples, toxic)."""
        pools = []
        for x, n, y in sorted(bins):
            pools.append([x * n, n, y])
            while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last)]
        self.grid = np.array([p[0] / p[1] for p in pools])
        self.fit = np.array([(p[2] + self.rate) / (p[1] + 1) for p in pools])


def curve(grid, fit, vote: float) -> float:
    """The calibrated score of a vote."""
    if grid is None or not len(grid):
        return float(vote)
    # a hundredth of the vote itself keeps the order within a pool
    return float(np.clip(0.99 * np.interp(vote, grid, fit) + 0.01 * vote, 0, 1))


def _self_votes(shared):
    def rows(batches):
        model = shared.value
        for batch in batches:
            examples = batch.column("id").to_pylist()
            for i in range(0, len(examples), TOGETHER):
                some = examples[i:i + TOGETHER]
                votes = [v for v, _ in model.votes([model.example(e) for e in some], some)]
                yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), pa.array(model.toxic[some].astype(np.int32))],
                                                 names=["vote", "toxic"])
    return rows


def _score(shared, grid, fit, extra: list[str]):
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())]))

    def rows(batches):
        model = shared.value
        known: dict = {}
        for batch in _counts(model.vocabulary, extra)(batches):
            at = batch.column("ids").offsets.to_numpy()
            ids, counts = batch.column("ids").values.to_numpy(), batch.column("counts").values.to_numpy()
            scores, proofs = [], []
            for i in range(0, batch.num_rows, TOGETHER):
                documents = [(ids[a:b], counts[a:b]) for a, b in zip(at[i:i + TOGETHER], at[i + 1:i + TOGETHER + 1])]
                keys = [hashlib.blake2b(a.tobytes() + b.tobytes(), digest_size=16).digest() for a, b in documents]
                if len(known) >= 20_000:
                    known.clear()
                new = {k: d for k, d in zip(keys, documents) if k not in known}
                for k, (vote, near) in zip(new, model.votes(list(new.values()))):
                    known[k] = curve(grid, fit, vote), [
                        {"doc_id": int(model.doc[e]), "toxic": int(model.toxic[e]), "cosine": c} for e, c in near[:3]]
                scores.extend(known[k][0] for k in keys)
                proofs.extend(known[k][1] for k in keys)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in extra] + [pa.array(scores, pa.float64()), pa.array(proofs, evidence)],
                                             names=[*extra, "score", "evidence"])
    return rows


def term_factors(held, n1: float, n0: float) -> np.ndarray:
    """1 for a term that is as frequent under both labels, more by its chi-square in
    units of what chance alone reaches about once in so many terms."""
    out = np.empty(len(held))
    for i in range(0, len(out), 1 << 16):  # few at a time, for memory
        a, b = (held[c].slice(i, 1 << 16).to_numpy().astype(np.float64) for c in ("n1", "n0"))
        beside = n1 * n0 * (a + b) * (n1 + n0 - a - b)
        out[i:i + len(a)] = np.divide((n1 + n0) * (a * (n0 - b) - b * (n1 - a)) ** 2, beside, out=np.zeros(len(a)), where=beside > 0)
    return 1 + out / (2 * np.log(max(len(out), 1)) + 1)


def _give_back() -> None:
    """Arrow keeps the memory of tables that are gone: the driver has better use for it."""
    pa.default_memory_pool().release_unused()


def _vocabulary(held: pa.Table, n1: float, n0: float) -> tuple[np.ndarray, np.ndarray]:
    """The sorted terms and their factors."""
    terms = held["term"].to_numpy().view(np.uint64)
    order = np.argsort(terms)
    return terms[order], term_factors(held, n1, n0)[order]


def _in_order(gathered: pa.Table) -> pa.Table:
    """The examples by doc_id and row id, without their row id: each list is copied once."""
    order = np.lexsort((gathered[RID].to_numpy(), gathered["doc_id"].to_numpy()))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    sizes = pc.list_value_length(gathered["ids"]).to_numpy().astype(np.int64)
    at = np.concatenate(([0], np.cumsum(sizes[order])))
    lists = []
    for name in ("ids", "counts"):
        values, row = np.empty(at[-1], np.int32), 0
        for chunk in gathered[name].chunks:
            ends, flat = chunk.offsets.to_numpy(), chunk.values.to_numpy()
            for a, b, k in zip(ends[:-1].tolist(), ends[1:].tolist(), place[row:row + len(chunk)].tolist()):
                values[at[k]:at[k + 1]] = flat[a:b]
            row += len(chunk)
        lists.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values)))
    return pa.table({"doc_id": gathered["doc_id"].to_numpy()[order], "toxic": gathered["toxic"].to_numpy()[order],
                     "ids": lists[0], "counts": lists[1]})


def _texts(docs: DataFrame) -> DataFrame:
    return with_rid(docs, ["doc_id", "text"]).withColumn("held_out", _held_out("doc_id"))


def _held_out(c: str) -> Column:
    return F.coalesce(F.crc32(F.col(c).cast("string")) % FOLDS == HELD_FOLD, F.lit(False))


def _learned(texts: DataFrame, labels: DataFrame, max_examples: int, max_terms: int):
    """(broadcast model, grid, fit).  The driver holds one of the gathered tables at a time
    and of the model no more than is sent."""
    spark = texts.sparkSession
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(~_held_out("doc_id")) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")) \
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_examples)
    sample = saved(texts.join(F.broadcast(known), "doc_id").select(RID, "doc_id", "toxic", "text"))
    size = sample.select(RID, "doc_id", "text").mapInArrow(_sizes, f"{RID} long, doc_id long, n long").filter(F.col("n") <= max_terms // 100)
    so_far = F.sum("n").over(Window.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", RID))  # of at most max_examples labels
    sample = saved(sample.join(size.withColumn("n", so_far).filter(F.col("n") <= max_terms).select(RID), RID))
    n1, n0 = (float(x or 0) for x in sample.select("toxic", "text").distinct().agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first())
    held = sample.select("toxic", "text").distinct().mapInArrow(_presence, "term long, n1 long, n0 long") \
        .groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).toArrow()
    vocabulary, factors = _vocabulary(held, n1, n0)
    del held
    _give_back()
    shared_terms = spark.sparkContext.broadcast(vocabulary)

    df = texts.select("text").mapInArrow(_document_counts(shared_terms), "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    n_docs = texts.count()
    weight = np.full(len(vocabulary), np.log(1.0 + n_docs) + 1)
    weight[df["id"].to_numpy()] = np.log((1.0 + n_docs) / (1.0 + df["n"].to_numpy())) + 1
    weight *= factors
    del df, factors
    _give_back()

    def counted(batches):
        return _counts(shared_terms.value, [RID, "doc_id", "toxic"])(batches)

    examples = _in_order(sample.select(RID, "doc_id", "toxic", "text").mapInArrow(
        counted, f"{RID} long, doc_id long, toxic int, ids array<int>, counts array<int>").toArrow())
    shared_terms.destroy()
    model = Model(examples, vocabulary, weight)
    shared = spark.sparkContext.broadcast(model)
    n = len(examples)
    del examples, vocabulary, weight
    model.forget()
    _give_back()
    if n:
        bins = spark.range(0, n, 1, -(-n // 256)).mapInArrow(_self_votes(shared), "vote double, toxic int") \
            .groupBy(F.floor(F.col("vote") * BINS)).agg(F.avg("vote"), F.count("*"), F.sum("toxic")).collect()
        model.calibrate([tuple(r)[1:] for r in bins])
    return shared, model.grid, model.fit


def _scored(texts: DataFrame, shared, grid, fit) -> DataFrame:
    extra = [RID, "doc_id", "held_out"]
    return texts.select(*extra, "text").mapInArrow(
        _score(shared, grid, fit, extra), f"{RID} long, doc_id long, held_out boolean, score double, "
                                                      "evidence array<struct<doc_id:long,toxic:int,cosine:double>>") \
        .withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, max_terms: int = MAX_TERMS) -> DataFrame:
    """One row per document: row id, doc_id, held_out, score, predicted, evidence (the
    three nearest examples).  Held-out documents are not learned from."""
    texts = _texts(docs)
    return _scored(texts, *_learned(texts, labels, max_examples, max_terms))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns."""
    docs = docs if RID not in docs.columns else docs.withColumnRenamed(RID, RID + "_in")
    whole = with_rid(docs)
    texts = _texts(whole.drop(RID))
    shared, grid, fit = _learned(texts, labels, MAX_EXAMPLES, MAX_TERMS)
    gone = saved(_scored(texts, shared, grid, fit).filter("predicted = 1").select(RID))
    shared.destroy()  # nothing reads the model any more
    return whole.join(gone, RID, "left_anti").drop(RID)
