"""Near-duplicate join on word shingles by parity sketches.

A document is its set of distinct 5-word shingles.  Two documents link when the
Jaccard similarity is at least 80 %, which bounds their symmetric difference by
d = (a + b) / 9 for sizes a and b.

* Sketch.  Each shingle hash is XORed into one lane of a sketch, and flips one bit
  of a bit sketch.  Shingles that both sets hold cancel, so at most d lanes differ
  and the Hamming distance of the bits is at most the symmetric difference.
* Size bands.  Band j holds the pairs whose smaller size lies in [A_j, A_j+1); it
  has its own d and a few more than d lanes.  A document takes part in one or two
  bands.
* Pigeonhole.  More than d lanes of a document are filled, so a linked pair agrees
  on ``need`` filled lanes at least, and lanes are joined by equality.  A document
  whose filled lanes do not exceed d (a few very small ones) also enters its
  shingles one by one; two such documents meet there.
* Verify.  A group that shares a lane has a hub, its most central member, and each
  member is compared with the hub on whole shingle sets.  What is left are pairs of
  a group that are not both linked to its hub.  Near the hub they are found by their
  differences from it: x and y differ in delta(x) XOR delta(y), so a link needs
  overlapping deltas, and an ordered prefix of each delta finds every such overlap
  (rare shingles first).  Members far from the hub are few and are compared by the
  Hamming bound.  Every candidate is then verified on whole sets.

Defined results: null and empty texts and texts without words have an empty set and
link with nothing; equal sets (also of repeated rows) link; a null doc_id never
names a component unless all its ids are null; an empty table gives an empty
result; other columns are never read.

Scale: one shuffle of 16-byte (lane signature, set id) rows, about 0.5 per word.
Equal sets are one id, and a task enters an id once, so a hot group of copies
does not reach the shuffle.  A lane that a family of near copies shares is read
as a stream by one task, a family has as many lanes as d, and they spread.  Work in
a family grows with the size of its deltas, not with its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm import common as C
from tideline.llm.common import RID, components, saved, with_rid

SHINGLE = 5
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 80
BAND_GROWTH = 1.5
#: Lanes beyond d + 1, as a share of d.
SPARE = 5
#: Longs of the bit sketch.
LONGS = 16
_LANE = np.uint64(0xD6E8FEB86659FD93)


def bands(upto: int, percent: int = PERCENT) -> list[tuple[int, int, int, int]]:
    """(smallest size, largest size, d, lanes) of each band, for sizes up to ``upto``."""
    out, low = [], 1
    while low <= upto:
        after = max(low + 1, int(low * BAND_GROWTH))
        a = after - 1
        b = a * 100 // percent
        d = (a + b) * (100 - percent) // (100 + percent)
        out.append((low, b, d, d + 1 + max(1, -(-d // SPARE))))
        low = after
    return out


def distinct_shingles(column: pa.Array, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for i, j, data, offsets in C.text_passes(column):
        starts, ends, rows = C.word_spans(data, offsets, ~C.SPACE_BYTES)
        words = C.span_hash(C.prefix_hash(data, C.LOWER), starts, ends)
        at = np.searchsorted(rows, np.arange(j - i + 1))
        runs = C.window_hash(words, k)
        for r in range(j - i):
            a, b = at[r], at[r + 1]
            if b - a >= k:
                yield np.unique(runs[a:b - k + 1])
            elif b > a:
                yield C.window_hash(words[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)


def set_hashes(shingles: np.ndarray) -> tuple[int, int]:
    return (int(np.bitwise_xor.reduce(C.mix64(shingles + C.STEP[2])).astype(np.int64)),
            int(C.mix64(shingles ^ C.STEP[3]).sum(dtype=np.uint64).astype(np.int64)))


def lane_signatures(shingles: np.ndarray, all_bands) -> tuple[list[np.ndarray], int]:
    """The document's lane signatures in all its bands, and how many of them a
    linked partner shares at least."""
    n, out, need = len(shingles), [], 1 << 30
    keys = C.mix64(shingles ^ C.STEP[4])
    for j, (low, high, d, lanes) in enumerate(all_bands):
        if not low <= n <= high:
            continue
        lane = ((shingles >> np.uint64(32)) * np.uint64(lanes)) >> np.uint64(32)  # rises with the shingle
        first = np.flatnonzero(np.concatenate(([True], lane[1:] != lane[:-1])))
        parity = np.bitwise_xor.reduceat(keys, first)
        out.append(C.mix64(parity ^ ((lane[first] + np.uint64(j << 32)) * _LANE)))
        if len(first) <= d:
            out.append(C.mix64(keys ^ C.mix64(np.full(1, j + 1, np.uint64))))
            need = 1
        else:
            need = min(need, len(first) - d)
    return out, need


def _bands_for(n: int, cache: dict) -> list:
    size = 1 << 12
    while size < n:
        size *= 2
    if size not in cache:
        cache[size] = bands(size)
    return cache[size]


BITS = [f"b{i}" for i in range(LONGS)]
SET_ROWS = f"{RID} long, doc_id long, n long, h1 long, h2 long, need int, " + ", ".join(f"{b} long" for b in BITS)
LANE_ROWS = "sig long, h1 long"
SHINGLE_ROWS = f"{RID} long, shingles array<long>"


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles that fall on each of the sketch's bits."""
    at = (C.mix64(shingles ^ C.STEP[10]) % np.uint64(64 * LONGS)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=64 * LONGS) & 1).astype(np.uint8)).view(np.int64)


def _sets(batches):
    cache: dict = {}
    for batch in batches:
        rows = [(len(s), *set_hashes(s), lane_signatures(s, _bands_for(len(s), cache))[1] if len(s) else 0, *bit_sketch(s).tolist())
                for s in distinct_shingles(batch.column("text"))]
        columns = [list(x) for x in zip(*rows)] if rows else [[]] * (4 + LONGS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(RID), batch.column("doc_id"), *[pa.array(c, pa.int32() if i == 3 else pa.int64()) for i, c in enumerate(columns)]],
            names=[RID, "doc_id", "n", "h1", "h2", "need", *BITS])


def _lanes(batches):
    cache: dict = {}
    for batch in batches:
        seen, sigs, ids, rows = set(), [], [], 0
        for s in distinct_shingles(batch.column("text")):
            if len(s):
                key = (len(s), *set_hashes(s))
                if key not in seen:
                    seen.add(key)
                    for sig in lane_signatures(s, _bands_for(len(s), cache))[0]:
                        sigs.append(sig)
                        ids.append(np.full(len(sig), key[1], np.int64))
                        rows += len(sig)
            if rows >= 200_000:
                yield _lane_batch(sigs, ids)
                sigs, ids, rows = [], [], 0
        if rows:
            yield _lane_batch(sigs, ids)


def _lane_batch(sigs, ids):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(ids))],
                                      names=["sig", "h1"])


def _shingle_lists(batches):
    for batch in batches:
        lists = list(distinct_shingles(batch.column("text")))
        at = np.cumsum([0] + [len(x) for x in lists])
        values = np.concatenate(lists).view(np.int64) if lists else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(RID), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values))],
            names=[RID, "shingles"])


def _hamming(a: str, b: str) -> str:
    return " + ".join(f"bit_count({a}.{x} ^ {b}.{x})" for x in BITS)


def _deltas(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (x, y) of class ids with what their shingle sets differ in."""
    left = sets.select(F.col("cid").alias("x"), F.col("shingles").alias("sx"))
    right = sets.select(F.col("cid").alias("y"), F.col("shingles").alias("sy"))
    return pairs.join(left, "x").join(right, "y") \
        .withColumn("delta", F.concat(F.array_except("sx", "sy"), F.array_except("sy", "sx"))).drop("sx", "sy")


def _linked(percent: int, size_x: str = "nx", size_y: str = "ny", gap: str = "gap") -> Column:
    """100 * intersection >= percent * union, from the sizes and the symmetric difference."""
    return F.expr(f"100 * ({size_x} + {size_y} - {gap}) >= {percent} * ({size_x} + {size_y} + {gap})")


def _shared_lanes(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(sig, h1, g) of lanes that g different sets share, without sets that share too
    few lanes to have a partner."""
    in_lane = Window.partitionBy("sig").orderBy("h1")
    head = F.first("h1").over(in_lane.rowsBetween(Window.unboundedPreceding, 0))
    shared = saved(
        texts.select("text").mapInArrow(_lanes, LANE_ROWS)
        .select("sig", "h1", head.alias("head"), F.lag("h1").over(in_lane).alias("prev"), F.lead("h1").over(in_lane).alias("next"))
        .filter("(h1 <> head AND h1 <> prev) OR (h1 = head AND next <> h1)").select("sig", "h1"))
    need = classes.groupBy("h1").agg(F.min("need").alias("need"))
    enough = shared.groupBy("h1").agg(F.count("*").alias("n")).join(need, "h1").filter("n >= need").select("h1")
    members = saved(shared.join(enough, "h1", "left_semi"))
    sizes = saved(members.groupBy("sig").agg(F.count("*").alias("g")).filter("g > 1"))
    return saved(members.join(sizes, "sig"))


def _stars(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(x, y, nx, ny, hx, agree): class x meets hub y in ``agree`` lanes; hx is the
    Hamming bound on their difference.  A linked pair agrees on ``need`` lanes, so a
    member may leave hubs that hold less than half of that together."""
    central = members.groupBy("h1").agg(F.sum("g").alias("c"))
    hubs = saved(members.join(central, "h1").groupBy("sig").agg(F.max(F.struct("c", "h1")).getField("h1").alias("hub")))
    meet = saved(members.join(hubs, "sig").filter("h1 <> hub").groupBy("h1", "hub").agg(F.count("*").alias("agree")))
    x = classes.select("h1", F.col("cid").alias("x"), F.col("n").alias("nx"), "need", F.struct(*BITS).alias("bx"))
    y = classes.select(F.col("h1").alias("hub"), F.col("cid").alias("y"), F.col("n").alias("ny"), F.struct(*BITS).alias("by"))
    least = Window.partitionBy("x").orderBy("agree", "hub").rowsBetween(Window.unboundedPreceding, 0)
    return saved(meet.join(x, "h1").withColumn("given_up", F.sum("agree").over(least)).filter("given_up > (need - 1) div 2")
                 .join(y, "hub").select("x", "y", "nx", "ny", "agree", F.expr(_hamming("bx", "by")).cast("long").alias("hx")))


def _near_pairs(near: DataFrame) -> DataFrame:
    """Pairs of members near one hub, not both linked to it, that may link: near holds
    (x, y, nx, gap, linked, delta) for hub y."""
    def hubs(rows: DataFrame) -> DataFrame:
        return rows.groupBy("y").agg(F.min(F.when(~F.col("linked"), F.col("gap"))).alias("out"), F.min("gap").alias("least"),
                                     F.max("nx").alias("most")).filter("out IS NOT NULL")

    one, bound = ["x", "y", "nx", "gap", "linked"], F.expr("least(nx div 4, (nx + most) div 9)")
    low = F.expr("if(linked, gap + out - d, gap + greatest(least, gap - d) - d)")
    holders = Window.partitionBy("y", "t")
    alive = saved(near.join(saved(hubs(near).select("y")), "y", "left_semi").select(*one, F.explode("delta").alias("t")))
    for _ in range(2):  # a link needs shared delta shingles: drop what is held once, and members left with too few
        # one of a pair is not linked to the hub: what only linked members hold joins none
        held = alive.withColumn("df", F.count("*").over(holders)).withColumn("sure", F.bool_and("linked").over(holders)) \
            .filter("df > 1 AND NOT sure")
        # a row a member again, rare shingles first: what follows joins members, not shingles
        members = saved(held.groupBy(*one).agg(F.sort_array(F.collect_list(F.struct("df", "t"))).getField("t").alias("left")))
        able = members.join(saved(hubs(members)), "y").withColumn("d", bound).withColumn("low", F.greatest(low, F.lit(1))) \
            .select(*one, "left", F.size("left").alias("u"), F.expr("(low + 1) div 2").alias("o")).filter("u >= o")
        alive = able.select(*one, F.explode("left").alias("t"))
    prefix = saved(able.select(*one, "u", F.explode(F.expr("slice(left, 1, cast(u - o + 1 as int))")).alias("t")))
    two = prefix.select("y", "t", *[F.col(c).alias(c + "2") for c in ("x", "nx", "gap", "linked", "u")])
    return prefix.join(two, ["y", "t"]).filter(
        "x < x2 AND NOT (linked AND linked2) AND 2 * least(u, u2) >= gap + gap2 - (nx + nx2) div 9").select("x", "x2").distinct()


def _sure_pairs(near: DataFrame) -> DataFrame:
    """Pairs of members so near one hub that they link whether or not their deltas overlap."""
    two = near.select("y", *[F.col(c).alias(c + "2") for c in ("x", "nx", "gap")])
    return near.join(two, "y").filter("x < x2 AND 9 * (gap + gap2) <= nx + nx2").select("x", F.col("x2").alias("y")).distinct()


def _far_pairs(far: DataFrame, edge: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs with a member far from their hub that the Hamming bound lets link."""
    bits = classes.select(F.col("cid").alias("x"), F.col("n").alias("nx"), F.struct(*BITS).alias("bx"))
    one = saved(far.select("x", "y").join(bits, "x"))
    two = saved(one.union(edge.select("x", "y").join(bits, "x").select(*one.columns))) \
        .select("y", *[F.col(c).alias(c + "2") for c in ("x", "nx", "bx")])
    return one.join(two, "y").filter(f"x <> x2 AND least(nx, nx2) * 100 >= greatest(nx, nx2) * {PERCENT} AND "
                                     f"{_hamming('bx', 'bx2')} <= (nx + nx2) div 9") \
        .select(F.least("x", "x2").alias("x"), F.greatest("x", "x2").alias("x2")).distinct()


def jaccard_components(docs: DataFrame, every_link: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, links): every row with its set size, class and component (both row
    ids); and verified links between classes (row ids of representatives) that
    connect every component, or with ``every_link`` all links there are."""
    texts = with_rid(docs, ["doc_id", "text"])
    sets = saved(texts.mapInArrow(_sets, SET_ROWS))
    classes = saved(sets.filter("n > 0").groupBy("h1", "h2", "n").agg(
        F.min(RID).alias("cid"), F.min("need").alias("need"), *[F.min(b).alias(b) for b in BITS]))
    stars = _stars(_shared_lanes(texts, classes), classes)
    # twice the largest difference that any partner allows: beyond it a member is far
    close = "hx <= 2 * (nx div 4)"
    playing = stars.filter(close).select(F.explode(F.array("x", "y")).alias(RID)).distinct()
    whole = saved(texts.join(saved(playing), RID, "left_semi").select(RID, "text").mapInArrow(_shingle_lists, SHINGLE_ROWS)
                  .withColumnRenamed(RID, "cid"))

    def compared(pairs: DataFrame) -> DataFrame:
        return saved(_deltas(pairs.select("x", "y", "nx", "ny"), whole).withColumn("gap", F.size("delta").cast("long"))
                     .withColumn("linked", _linked(PERCENT)))

    # each class with its best hub; then whatever meets in a lane and is not yet one component
    best = F.row_number().over(Window.partitionBy("x").orderBy(F.desc("agree"), "hx", "y"))
    chosen = saved(stars.filter(close).withColumn("at", best).filter("at = 1").drop("at"))
    first = compared(chosen)
    links = first.filter("linked").select("x", "y")
    labels = components(links, "x", "y")
    label = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias("l" + c))
    mixed = stars if every_link else stars.join(label("x"), "x", "left").join(label("y"), "y", "left") \
        .filter("coalesce(lx, x) <> coalesce(ly, y)")
    mixed = saved(mixed.select("y").distinct())
    stars = saved(stars.join(mixed, "y", "left_semi"))
    more = compared(stars.filter(close).join(chosen.select("x", "y"), ["x", "y"], "left_anti"))
    near = saved(first.join(mixed, "y", "left_semi").union(more.select(*first.columns)))
    links = saved(links.union(more.filter("linked").select("x", "y")))
    labels = components(links, "x", "y") if not every_link else labels

    inside = near.filter("gap <= 2 * (nx div 4)")
    far = saved(near.filter("gap > 2 * (nx div 4)").select("x", "y").union(stars.filter(f"NOT ({close})").select("x", "y")))
    open_pairs = inside.withColumn("linked", F.lit(False)) if every_link else inside
    pairs = saved(_near_pairs(open_pairs).union(_far_pairs(far, inside.filter("gap >= nx div 5"), classes)).distinct()
                  .withColumnRenamed("x2", "y"))
    if not every_link:
        pairs = pairs.join(label("x"), "x", "left").join(label("y"), "y", "left").filter("coalesce(lx, x) <> coalesce(ly, y)").select("x", "y")
    sizes = classes.select(F.col("cid").alias("x"), F.col("n").alias("nx"), F.struct(*BITS).alias("bx"))
    pairs = pairs.join(sizes, "x").join(sizes.select(F.col("x").alias("y"), F.col("nx").alias("ny"), F.col("bx").alias("by")), "y") \
        .filter(f"{_hamming('bx', 'by')} <= (nx + ny) div 9")
    lists = pairs.select(F.explode(F.array("x", "y")).alias(RID)).distinct().join(whole.select(F.col("cid").alias(RID)), RID, "left_anti")
    extra = saved(texts.join(saved(lists), RID, "left_semi").select(RID, "text").mapInArrow(_shingle_lists, SHINGLE_ROWS)
                  .withColumnRenamed(RID, "cid"))
    found = _deltas(pairs, whole.union(extra)).withColumn("gap", F.size("delta")).filter(_linked(PERCENT)).select("x", "y")
    if every_link:
        links = links.union(_sure_pairs(inside)).union(found)
        links = saved(links.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
    else:
        links = saved(links.union(found))

    named = components(links, "x", "y").select(F.col("node").alias("cid"), "component")
    rows = sets.select(RID, "doc_id", "n", "h1", "h2").join(classes.select("h1", "h2", "n", "cid"), ["h1", "h2", "n"], "left") \
        .join(named, "cid", "left") \
        .select(RID, "doc_id", "n", F.coalesce("cid", RID).alias("cid"),
                F.coalesce("component", "cid", RID).alias("component"))
    return saved(rows), links


def near_duplicate_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The join itself: (documents, links).  Each row has its row id, doc_id, n_shingles and
    class_id, the row id of the first document with an equal set (null for an empty one);
    rows of a class link with each other.  ``links`` has every linked pair of different
    classes once, class_a < class_b.  Its size is that of the answer, so it grows with the
    square of a family of different near copies."""
    rows, links = jaccard_components(docs, every_link=True)
    return (rows.select(RID, "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("cid")).alias("class_id")),
            links.select(F.col("x").alias("class_a"), F.col("y").alias("class_b")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_component
    (rows of the component)."""
    rows, _ = jaccard_components(docs)
    # a saved join side leaves two plain shuffles, of which AQE splits a hot component
    named = saved(rows.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n_component")))
    return rows.join(named, "component").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "n_component")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest
    doc_id (a null one last, the first of repeated rows), all columns."""
    docs = docs if RID not in docs.columns else docs.withColumnRenamed(RID, RID + "_in")
    whole = with_rid(docs)
    rows, _ = jaccard_components(whole.drop(RID))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", RID)).getField(RID)
    stays = saved(rows.groupBy("component").agg(first.alias("stay"), F.count("*").alias("g")).filter("g > 1"))
    gone = rows.join(stays, "component").filter(F.col(RID) != F.col("stay")).select(RID)
    return whole.join(gone, RID, "left_anti").drop(RID)
