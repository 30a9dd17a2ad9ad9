"""Byte-level BPE encoding and decoding with the ranks of a given vocabulary file.

Spark's regular expressions cut each text into words by the vocabulary's pattern.
A task encodes each distinct word of an Arrow batch once: the word starts as an
array of single bytes, and the merge with the lowest rank is folded in until none
is left.  Ids of a text are its words' ids in order.  Decoding concatenates the
byte pieces of the ids.

(The fold runs in Arrow tasks, not in Spark's higher-order functions over a literal
rank map: a lookup in a map of 50,000 entries is a linear search there, and joining
words encoded once for the whole corpus back to the texts would shuffle every
word.  See the README for figures.)

Defined results: a null text is the empty text and has no ids; special tokens'
strings are ordinary text; an id outside the vocabulary, or null, in decoding is an
error; repeated rows are encoded alike; an empty table gives an empty result; a word
of any length is merged in n log n steps; the columns named in ``keep`` pass through.

Scale: no shuffle.  Broadcast is the vocabulary, a file of fixed size.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import text_or_empty
from tideline.llm.ship import ship

#: Words that a task gathers into one output batch.
OUT_WORDS = 200_000
#: Encoded words that a Python worker remembers from batch to batch.
REMEMBER = 200_000
SHORT = 48
_remembered: dict[int, dict[bytes, list[int]]] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 piece and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def unicode_pattern(pattern: str) -> str:
    """The pattern with white space as Unicode has it, for Spark."""
    return "(?U)" + pattern


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the leftmost pair of lowest rank merges until no pair has a rank."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > SHORT:
        return _fold_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        low, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (low is None or r < low):
                low, at = r, i
        if low is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges from a heap of pairs over a linked list."""
    n = len(word)
    end = list(range(1, n + 1))       # end of the part that starts here
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    live = [True] * n
    heap = []

    def push(i):
        j = after[i]
        if j < n:
            r = ranks.get(word[i:end[j]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[i], end[j]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, mid, last = heapq.heappop(heap)
        j = after[i] if live[i] else n
        if not live[i] or j >= n or end[i] != mid or end[j] != last:
            continue  # one of the two has merged meanwhile
        live[j] = False
        end[i], after[i] = last, after[j]
        if after[i] < n:
            before[after[i]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = after[i]
    return out


def _gather(starts: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The runs values[start:start + size], one after another."""
    total = int(sizes.sum())
    if not total:
        return values[:0]
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return values[shift + np.arange(total)]


class Pieces:
    """Byte pieces by id, for decoding."""

    def __init__(self, ranks: dict[bytes, int]):
        by_id = dict((i, p) for p, i in ranks.items())
        self.known = np.zeros(max(by_id, default=-1) + 1, bool)
        self.known[list(by_id)] = True
        pieces = [by_id.get(i, b"") for i in range(len(self.known))]
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts whose ids are ids[at[r]:at[r + 1]]."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.sizes[ids]
        cut = np.concatenate(([0], np.cumsum(sizes)))[at]
        return _gather(self.starts[ids], sizes, self.bytes), cut


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _encode(shared, keep: list[str], with_bytes: bool):
    def rows(batches):
        ranks, mark = shared.value
        pieces = Pieces(ranks) if with_bytes else None
        memory = _remembered.setdefault(mark, {})
        for batch in batches:
            words = batch.column("words")
            at = words.offsets.to_numpy().astype(np.int64)
            coded = words.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
            index, at = coded.indices.to_numpy(), at - at[0]
            each = []
            for w in coded.dictionary.cast(pa.binary()).to_pylist():
                ids = memory.get(w)
                if ids is None:
                    ids = fold(w, ranks)
                    if len(memory) < REMEMBER:
                        memory[w] = ids
                each.append(ids)
            sizes = np.fromiter(map(len, each), np.int64, len(each))
            flat = np.fromiter((i for ids in each for i in ids), np.int32, int(sizes.sum()))
            del each
            starts = np.cumsum(sizes) - sizes
            i, n = 0, batch.num_rows
            while i < n:
                j = max(i + 1, int(np.searchsorted(at, at[i] + OUT_WORDS, "right")) - 1)
                own = index[at[i]:at[j]]
                ids = _gather(starts[own], sizes[own], flat)
                cut = np.concatenate(([0], np.cumsum(sizes[own])))[at[i:j + 1] - at[i]]
                columns = [batch.column(c).slice(i, j - i) for c in keep]
                columns.append(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(ids, pa.int32())))
                if with_bytes:
                    columns.append(_binary(*pieces.decode(ids, cut)))
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids"] + ["decoded"] * with_bytes)
                i = j
    return rows


def _shared(df: DataFrame, path: str):
    ranks = load_ranks(path)
    return df.sparkSession.sparkContext.broadcast((ranks, hash(frozenset(ranks.items()))))


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str], with_bytes: bool = False) -> DataFrame:
    """``keep`` columns of each row and the ids of its text; ``with_bytes`` adds the
    bytes that decoding the ids gives."""
    ship(docs.sparkSession)
    words = F.regexp_extract_all(text_or_empty(), F.lit(unicode_pattern(pattern)), F.lit(0))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
                       + ["ids array<int>"] + ["decoded binary"] * with_bytes)
    return docs.select(*keep, words.alias("words")).mapInArrow(_encode(_shared(docs, path), keep, with_bytes), schema)


def decode(tokens: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of each row and the bytes of its ``ids``."""
    ship(tokens.sparkSession)
    shared = _shared(tokens, path)

    def rows(batches):
        pieces = Pieces(shared.value[0])
        for batch in batches:
            ids = batch.column("ids")
            at = ids.offsets.to_numpy().astype(np.int64)
            values = ids.values.slice(at[0], at[-1] - at[0])
            if values.null_count:
                raise ValueError("an id is null")
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [_binary(*pieces.decode(values.to_numpy(), at - at[0]))],
                                             names=[*keep, "decoded"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.select(*keep).schema] + ["decoded binary"])
    return tokens.select(*keep, "ids").mapInArrow(rows, schema)
