"""Merkle manifest of a dataset by butterfly exchange.

A leaf is the SHA-256 of a row's fields.  The leaves of a source stand in the
order of doc_id and form a tree of fixed fanout; the subroots, ordered by source,
form a second tree, whose root names the whole dataset.  Each row gets its path:
the siblings of its run on every level up to the root.

A tree is cut into aligned blocks of fanout ** BLOCK_LEVELS leaves.  A block hashes
its own subtree; then, round by round, the blocks of a run exchange the roots that
they hold: block b asks, in each sibling subtree, the block at its own place
there, and both hash the ancestor.  After log(blocks) rounds every block holds
its upper path and the tree's root, with no way down again.  Where the last
subtree of a tree is cut short, its blocks serve the missing places in turn.

Defined results: a null field is ``-``; rows of equal doc_id stand in the order of
their leaves, a null doc_id first, a null source before all others; equal rows
are different leaves; a tree of one leaf has the leaf as its root and adds
nothing to the path; an empty table gives an empty result; columns that are not
fields of the leaf are read only when ``carry`` names them.

Scale: texts are hashed where they are read and never move.  Leaves move twice,
once to be ranked (range-partitioned, so a source with a third of all rows is cut
like any other) and once into their block, whose size is fixed.  A round moves
one root for each block and sibling: a few hundredths of the leaves in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import global_rank, saved

FANOUT = 3
#: A block has FANOUT ** BLOCK_LEVELS leaves.
BLOCK_LEVELS = 5
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PATH = "array<struct<place:int,siblings:array<string>>>"


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf_of(fields: list[Column]) -> Column:
    """The leaf of a row: each field as its byte count, ``:`` and its value; ``-`` when null."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-"))
             for f in fields]
    return digest(F.concat(*parts))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda node, p: digest(F.concat(
        F.array_join(F.slice(p["siblings"], F.lit(1), p["place"]), ""), node,
        F.array_join(F.slice(p["siblings"], p["place"] + 1, F.lit(FANOUT)), ""))))


def path_digest(path: Column) -> Column:
    """One digest of all siblings on the path, in order."""
    return digest(F.array_join(F.flatten(F.transform(path, lambda p: p["siblings"])), ""))


def _height(n: str, most: int) -> Column:
    """Levels over ``n`` leaves until one node remains, ``most`` at the most."""
    out = F.lit(most)
    for h in reversed(range(most)):
        out = F.when(F.col(n) <= FANOUT ** h, h).otherwise(out)
    return out


def _above(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda k: digest(F.array_join(F.slice(nodes, k * FANOUT + 1, F.lit(FANOUT)), "")))


def blocks_of(leaves: DataFrame) -> DataFrame:
    """Leaves (tree, n of the tree, pos, node, item) as blocks: tree, block, blocks of the
    tree, items in order, the nodes of every level inside the block, its root."""
    size = FANOUT ** BLOCK_LEVELS
    rows = leaves.groupBy("tree", F.expr(f"pos div {size}").alias("block"), "n").agg(
        F.array_sort(F.collect_list(F.struct("pos", "node", "item"))).alias("rows"))
    rows = rows.select("tree", "block", F.expr(f"(n + {size - 1}) div {size}").alias("blocks"), F.col("rows.item").alias("items"),
                       _height("n", BLOCK_LEVELS).alias("height"), F.col("rows.node").alias("leaves"))
    steps = F.filter(F.sequence(F.lit(0), F.lit(BLOCK_LEVELS - 1)), lambda k: k < F.col("height"))
    levels = F.aggregate(steps, F.array("leaves"), lambda a, _: F.concat(a, F.array(_above(F.element_at(a, -1)))))
    return rows.withColumn("levels", levels).select(
        "tree", "block", "blocks", "items", "height", "levels", F.element_at("levels", -1)[0].alias("node"))


def exchanged(blocks: DataFrame) -> DataFrame:
    """(tree, block, path, root): each block's path above itself, by rounds in which the
    blocks of a run exchange the roots that they hold."""
    held = saved(blocks.select("tree", "block", "blocks", "node", F.array().cast(PATH).alias("path")))
    most, span = held.agg(F.max("blocks")).first()[0] or 0, 1
    while span < most:
        q, last = F.expr(f"block div {span}"), F.expr(f"(blocks - 1) div {span}")
        now = held.select("*", q.alias("q"), last.alias("last"), F.expr(f"block div {span * FANOUT} * {FANOUT}").alias("first"))
        ask = now.filter("last > 0").select("tree", "block", "blocks", "q", F.explode(F.expr(
            f"filter(sequence(first, least(first + {FANOUT - 1}, last)), s -> s != q)")).alias("s"))
        # the block at the same place of the sibling subtree; a short one serves its missing places in turn
        ask = ask.select("tree", "block", "s", F.expr(
            f"s * {span} + (block - q * {span}) % least({span}L, blocks - s * {span})").alias("partner"))
        got = ask.join(held.select("tree", F.col("block").alias("partner"), "node"), ["tree", "partner"]) \
            .groupBy("tree", "block").agg(F.array_sort(F.collect_list(F.struct("s", "node"))).alias("got"))
        rows = now.join(got, ["tree", "block"], "left").withColumn(
            "got", F.coalesce("got", F.array().cast("array<struct<s:bigint,node:string>>")))
        run = F.array_sort(F.concat("got", F.array(F.struct(F.col("q").alias("s"), "node"))))
        step = F.struct((F.col("q") - F.col("first")).cast("int").alias("place"), F.col("got.node").alias("siblings"))
        held = saved(rows.select(
            "tree", "block", "blocks",
            F.when(F.col("last") > 0, digest(F.array_join(F.transform(run, lambda x: x["node"]), ""))).otherwise(F.col("node")).alias("node"),
            F.when(F.col("last") > 0, F.concat("path", F.array(step))).otherwise(F.col("path")).cast(PATH).alias("path")))
        span *= FANOUT
    return held.select("tree", "block", "path", F.col("node").alias("root"))


def _own_path(i: Column, levels: Column, height: Column) -> Column:
    """The path of leaf i inside its block."""
    powers = F.array(*[F.lit(FANOUT ** k) for k in range(BLOCK_LEVELS)])

    def step(k):
        at = F.floor(i / F.get(powers, k)).cast("int")
        place = at % FANOUT
        run = F.slice(F.get(levels, k), at - place + 1, F.lit(FANOUT))
        others = F.concat(F.slice(run, F.lit(1), place), F.slice(run, place + 2, F.lit(FANOUT)))
        return F.struct(place.alias("place"), others.alias("siblings"))

    return F.transform(F.filter(F.sequence(F.lit(0), F.lit(BLOCK_LEVELS - 1)), lambda k: k < height), step)


def _with_paths(blocks: DataFrame, above: Column) -> DataFrame:
    """Each item of the blocks with its leaf and its path, ``above`` added at the end."""
    rows = F.transform("items", lambda x, i: F.struct(
        x.alias("item"), F.get(F.col("levels")[0], i).alias("leaf"),
        F.concat(_own_path(i, F.col("levels"), F.col("height")).cast(PATH), above).alias("path")))
    return blocks.select("root", "top", F.inline(rows.alias("rows")))


def manifest(docs: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, leaf, subroot, root, path (place and
    siblings for each level, from the leaf to the root), and the columns of ``carry``."""
    kept = {"doc_id": F.col("doc_id"), "source": F.col("source")} | (carry or {})
    leaves = saved(docs.select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("tree"), leaf_of([F.col(f) for f in FIELDS]).alias("node"),
        F.struct(*[c.alias(k) for k, c in kept.items()]).alias("item"), F.col("doc_id").alias("_tl_doc")))
    ranked = saved(global_rank(leaves, ["tree", "_tl_doc", "node"]).drop("_tl_doc"))
    sources = saved(ranked.groupBy("tree").agg(F.count("*").alias("n"), F.min("rank").alias("start")))
    blocks = saved(blocks_of(ranked.join(sources, "tree").withColumn("pos", F.col("rank") - F.col("start"))))
    paths = saved(exchanged(blocks))
    subroots = paths.filter("block = 0").select("tree", F.col("root").alias("node"))
    upper = global_rank(subroots, ["tree"]).select(
        F.lit("").alias("tree"), F.lit(sources.count()).alias("n"), F.col("rank").alias("pos"), "node", F.struct("tree").alias("item"))
    tops = saved(blocks_of(upper))
    tops = _with_paths(tops.join(exchanged(tops), ["tree", "block"]).withColumn("top", F.col("root")), F.col("path")) \
        .select(F.col("item.tree").alias("tree"), F.col("path").alias("upper"), "top")
    whole = blocks.join(paths, ["tree", "block"]).join(saved(tops), "tree")
    rows = _with_paths(whole, F.concat("path", "upper"))
    return rows.select(*[F.col("item")[k].alias(k) for k in kept], "leaf", F.col("root").alias("subroot"), F.col("top").alias("root"), "path")
