"""Language identification by mixture inference.

Each language is a distribution over letter trigrams, learned from the labelled
training documents.  A document is a mixture of languages: expectation-
maximisation estimates its proportions from the trigram likelihoods, and the set
of languages is the one whose likelihood, less a price for each further language,
is highest.  The prediction is the language with the largest share.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and
so is every text when no labelled training document has a letter; a null lang is
not learned from; a null doc_id counts as not held out; equal shares go to the
first language in order; repeated rows are scored alike; other columns are never
inputs.

Scale: one pass counts trigrams per language in every task and Spark sums them, one
pass scores rows where they are.  No text is shuffled.  A trigram is its three code
points, so none shares a count with another.  The model that tasks receive holds each
trigram seen in training with one number per language: it grows with the letters of
the corpus, not with its length (some ten thousand trigrams for each alphabetic
language), and a trigram that training never saw has the smoothed probability.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm import common as C
from tideline.llm.ship import ship

#: Distinct trigrams that a task holds before it hands its counts on.
TASK_TRIGRAMS = 1_000_000
SMOOTHING = 0.1
EM_STEPS = 10
#: Price of one more language, in units of log(number of trigrams).
PRICE = 2.0
UNKNOWN = "und"
FOLDS, HELD_FOLD = 4, 2
_TOP = 0x32400  # no letter has a code point from here on


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Lower-case code point of each letter, 0 for any other character."""
    out = np.zeros(_TOP + 1, np.uint32)
    for c in range(_TOP):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def trigrams(column: pa.Array):
    """(first row, rows, row of each letter, the trigram around it as a number), by passes."""
    table = letters()
    for i, j, data, offsets in C.text_passes(column):
        at = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
        points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        c = table[np.minimum(points, _TOP)]
        if not len(c):
            yield i, j - i, np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        before, after = np.roll(c, 1), np.roll(c, -1)
        before[at[:-1][at[:-1] < len(c)]] = 0
        after[at[1:][at[1:] > 0] - 1] = 0
        use = np.flatnonzero(c)
        key = before[use].astype(np.int64) << 42 | c[use].astype(np.int64) << 21 | after[use].astype(np.int64)
        yield i, j - i, np.searchsorted(at, use, "right") - 1, key


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _count(batches):
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def rows():
        for name, parts in held.items():
            keys, n = _summed(parts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(n)], names=["lang", "trigram", "n"])
        held.clear()

    for batch in batches:
        names = batch.column("lang").to_pylist()
        known = {n: k for k, n in enumerate(dict.fromkeys(names))}
        code = np.array([known[n] for n in names], np.int64)
        for i, n, row, key in trigrams(batch.column("text")):
            own = code[i + row]
            for name, k in known.items():
                mine = key[own == k]
                if len(mine):
                    held[name] = [_summed([*held.get(name, []), np.unique(mine, return_counts=True)])]
            if sum(len(p[0][0]) for p in held.values()) > TASK_TRIGRAMS:
                yield from rows()
    yield from rows()


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, trigrams in order, trigrams x languages probabilities, with a last row
    for a trigram that was never seen) from text and lang."""
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text") \
        .mapInArrow(_count, "lang string, trigram long, n long").groupBy("lang", "trigram").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(rows["lang"].unique())
    keys, place = np.unique(rows["trigram"].to_numpy(np.int64), return_inverse=True)
    counts = np.zeros((len(keys) + 1, len(names)))
    counts[place, rows["lang"].map({n: k for k, n in enumerate(names)}).to_numpy(int)] = rows["n"].to_numpy()
    return names, keys, ((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * len(counts))).astype(np.float32)


def _em(p: np.ndarray, w: np.ndarray, doc: np.ndarray, first: np.ndarray, total: np.ndarray, allowed: np.ndarray):
    """(shares, log likelihood) per document; p: entries x languages, grouped by document."""
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(EM_STEPS):
        r = share[doc] * p
        s = r.sum(1)
        r *= (w / s)[:, None]
        share = np.add.reduceat(r, first, axis=0) / total[:, None]
    return share, np.add.reduceat(w * np.log((share[doc] * p).sum(1)), first)


def infer(p: np.ndarray, w: np.ndarray, first: np.ndarray):
    """Shares (documents x languages, 0 outside the chosen set) and the posterior of
    the best language on its own."""
    n_docs, n_lang = len(first), p.shape[1]
    size = np.diff(np.append(first, len(w)))
    doc = np.repeat(np.arange(n_docs), size)
    total = np.add.reduceat(w, first)
    alone = np.add.reduceat(np.log(p) * w[:, None], first, axis=0)
    best = alone.argmax(1)
    chosen = np.zeros((n_docs, n_lang))
    chosen[np.arange(n_docs), best] = 1
    worth = alone.max(1)
    posterior = 1 / np.exp(np.minimum(alone - worth[:, None], 0)).sum(1)
    price = PRICE * np.log(total + 1)
    share, like = _em(p, w, doc, first, total, np.ones((n_docs, n_lang)))
    order = np.argsort(-share, axis=1, kind="stable")
    for k in range(2, n_lang + 1):  # the k languages with the largest shares; the full mixture bounds what they can reach
        try_ = np.flatnonzero(like - price * (k - 1) > worth)
        if not len(try_):
            break
        allowed = np.zeros((len(try_), n_lang))
        np.put_along_axis(allowed, order[try_, :k], 1, 1)
        part = np.isin(doc, try_)
        starts = np.concatenate(([0], np.cumsum(size[try_])[:-1]))
        s, l = _em(p[part], w[part], np.repeat(np.arange(len(try_)), size[try_]), starts, total[try_], allowed)
        better = l - price[try_] * (k - 1) > worth[try_]
        chosen[try_[better]] = s[better]
        worth[try_[better]] = (l - price[try_] * (k - 1))[better]
    return chosen, posterior


def _predict(names: list[str], shared):
    def rows(batches):
        keys, prob = shared.value
        for batch in batches:
            n = batch.num_rows
            pred, score = np.full(n, UNKNOWN, object), np.zeros(n)
            sets: list[list[dict]] = [[] for _ in range(n)]
            for i, m, row, trigram in trigrams(batch.column("text")):
                if not len(row) or not names:
                    continue
                place = np.minimum(np.searchsorted(keys, trigram), len(keys) - 1)
                place[keys[place] != trigram] = len(keys)
                key, w = np.unique(row * len(prob) + place, return_counts=True)
                r = key // len(prob)
                first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
                share, posterior = infer(prob[key % len(prob)], w.astype(np.float32), first)
                top = share.argmax(1)
                for d, t, q, s in zip((r[first] + i).tolist(), top.tolist(), posterior.tolist(), share):
                    pred[d], score[d] = names[t], min(1.0, float(s[t]) * (q if s[t] == 1 else 1.0))
                    sets[d] = [{"lang": names[k], "share": float(s[k])} for k in np.argsort(-s, kind="stable") if s[k] > 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score),
                 pa.array(sets, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                names=["doc_id", "held_out", "lang_pred", "score", "languages"])
    return rows


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, languages (the chosen
    set with shares).  Held-out documents are not learned from."""
    ship(docs.sparkSession)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_FOLD, F.lit(False))
    rows = docs.select("doc_id", "text", "lang", held.alias("held_out"))
    names, keys, prob = learn(rows.filter("NOT held_out"))
    shared = docs.sparkSession.sparkContext.broadcast((keys, prob))
    return rows.select("doc_id", "text", "held_out").mapInArrow(
        _predict(names, shared),
        "doc_id long, held_out boolean, lang_pred string, score double, languages array<struct<lang:string,share:double>>")
