"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph (a line, a long one in pieces of ``PIECE_WORDS`` words) has a 64-bit
digest.  Every digest goes into one cell of each of three tables; a cell keeps the
number, the XOR of the digests and the XOR of their checks.  Two versions are
compared by subtracting their cells: what both hold cancels.  A cell left with one
digest gives it away; taking that out of its other cells frees more (peeling).  When
cells remain, the versions are sketched again four times larger.

The fingerprint of a text is its sketch with one bucket; versions are compared on
sketches whose buckets hold a few digests each.

Defined results: a null text is empty and has no paragraph; white-space-only lines
are no paragraphs; two texts without paragraphs have likeness 1; a repeated
paragraph counts once; the next document of the last is the first, a null doc_id
comes after all others, rows with equal doc_id follow each other; a single document
is its own next; an empty table gives an empty result.

Scale: the texts move once (both joins by row id share the exchange) and heads of
texts once more; cells are then summed where the rows are.  Only the digests of
versions that must be sketched again move a second time.  Only DataFrame functions
run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import RID, global_rank, saved, text_or_empty, with_rid

PIECE_WORDS = 24
HASHES, TABLE = 3, 5
CELLS = HASHES * TABLE
#: Digests of both versions per bucket at the first try.
LOAD = 4
PEEL_ROUNDS = 8
_PIECE = rf"(?:\S++[^\S\n]++){{0,{PIECE_WORDS - 1}}}\S++"


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), lambda p: F.xxhash64(p)))


def _check(digest: str) -> str:
    return f"(xxhash64({digest}, 99) & 4294967295)"


def _places(digest: str) -> list[str]:
    return [f"pmod(xxhash64({digest}, {j}), {TABLE})" for j in range(HASHES)]


def _sums() -> list[Column]:
    """The cells of a sketch as aggregates over rows (d, side, chk, p0..p2); side 0 is no digest."""
    out = []
    for j in range(HASHES):
        for c in range(TABLE):
            here, i = f"side <> 0 AND p{j} = {c}", j * TABLE + c
            out += [F.expr(f"coalesce(sum(if({here}, side, 0L)), 0L)").alias(f"n{i}"),
                    F.expr(f"bit_xor(if({here}, d, 0L))").alias(f"k{i}"),
                    F.expr(f"bit_xor(if({here}, chk, 0L))").alias(f"h{i}")]
    return out


def _cells() -> str:
    return "array(" + ", ".join(f"struct(n{i} AS n, k{i} AS k, h{i} AS h)" for i in range(CELLS)) + ")"


def _placed(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.expr(_check("d")).alias("chk"), *[F.expr(p).alias(f"p{j}") for j, p in enumerate(_places("d"))])


def sketch_text(cells: str) -> Column:
    """A sketch as text: its cells in order, in hexadecimal."""
    return F.expr(f"array_join(transform({cells}, c -> concat_ws('.', hex(c.n), hex(c.k), hex(c.h))), ' ')")


def _buckets(total: str, factor: int = 1) -> str:
    """How many buckets a pair with so many digests on both sides is sketched with."""
    return f"CAST(greatest(1, pow(2, ceil(log2(greatest({total}, 1) / {LOAD}D)))) AS BIGINT) * {factor}L"


def _summed(long: DataFrame, *keys: str) -> DataFrame:
    """Subtracted sketches: the cells of each key and bucket from rows (keys, b: number
    of buckets, side, d)."""
    return _placed(long.withColumn("bucket", F.expr("pmod(xxhash64(d, 7), b)"))).groupBy(RID, *keys, "bucket").agg(*_sums())


_CLEAN = "forall(s.cells, c -> c.n = 0 AND c.k = 0 AND c.h = 0)"


def _peeled() -> Column:
    """(cells, found) after peeling the cells of a bucket: found holds each digest
    with the side it comes from (1 or -1)."""
    at = "array(" + ", ".join(f"CAST({j * TABLE} + {p} AS INT)" for j, p in enumerate(_places("c.k"))) + ")"
    pure = f"""array_distinct(transform(filter(s.cells, c -> abs(c.n) = 1 AND {_check('c.k')} = c.h),
               c -> struct(c.k AS k, c.n AS n, c.h AS h, {at} AS at)))"""
    step = """named_struct('cells', transform(s.cells, (c, i) -> aggregate(filter(pure, p -> array_contains(p.at, i)), c,
                 (acc, p) -> named_struct('n', acc.n - p.n, 'k', acc.k ^ p.k, 'h', acc.h ^ p.h))),
               'found', concat(s.found, transform(pure, p -> named_struct('digest', p.k, 'side', p.n))))"""
    return F.expr(f"""aggregate(sequence(1, {PEEL_ROUNDS}),
        named_struct('cells', {_cells()}, 'found', CAST(array() AS array<struct<digest:bigint,side:bigint>>)),
        (s, r) -> element_at(transform(array({pure}), pure -> if(size(pure) = 0, s, {step})), 1))""")


def differences(pairs: DataFrame, with_digests: bool = False, factor: int = 1) -> DataFrame:
    """For rows (row id, pair, a, o: digest lists of two versions) the number of
    differing digests, and on request the digests with their side (1: only in a,
    -1: only in o), recovered from subtracted sketches."""
    todo, done = pairs.withColumn("total", F.size("a") + F.size("o")), None
    while True:
        long = todo.repartition(RID).select(RID, "pair", F.expr(_buckets("total", factor)).alias("b"), F.explode_outer(F.expr(
            "concat(transform(a, x -> struct(1L AS side, x AS d)), transform(o, x -> struct(-1L AS side, x AS d)))")).alias("x")) \
            .select(RID, "pair", "b", F.coalesce("x.side", F.lit(0)).alias("side"), F.coalesce("x.d", F.lit(0)).alias("d"))
        per = [F.sum(F.size("s.found")).cast("long").alias("differing"), F.min(F.expr(_CLEAN)).alias("decoded")]
        if with_digests:
            per.append(F.flatten(F.collect_list("s.found")).alias("digests"))
        got = saved(_summed(long, "pair").select(RID, "pair", _peeled().alias("s")).groupBy(RID, "pair").agg(*per))
        ready = got.filter("decoded").drop("decoded")
        done = ready if done is None else done.union(ready)
        failed = got.filter("NOT decoded").select(RID, "pair")
        if not failed.limit(1).count():
            return done
        todo, factor = saved(todo.join(failed, [RID, "pair"])), factor * 4


def likeness(a: str, o: str, differing: str) -> Column:
    """Share of common digests among all, from the sizes and the differing ones."""
    return F.expr(f"if({a} + {o} = 0, 1D, CAST({a} + {o} - {differing} AS DOUBLE) / ({a} + {o} + {differing}))")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    texts = with_rid(docs, ["doc_id", "text"]).select(RID, "doc_id", text_or_empty().alias("text"))
    sizes = saved(texts.select(RID, "doc_id", F.char_length("text").cast("long").alias("n_chars"),
                               F.col("doc_id").isNull().alias("no_id")))
    ranked = saved(global_rank(sizes, ["no_id", "doc_id", RID]))
    total = ranked.count()
    after = ranked.select(((F.col("rank") - 1 + total) % max(total, 1)).alias("rank"), F.col(RID).alias("next"))
    pairs = ranked.join(after, "rank").select(F.col(RID).alias("own"), "doc_id", "next", F.floor(F.col("n_chars") / 4).cast("int").alias("cut"))
    # both joins read the same exchange of (row id, text)
    whole = texts.select(RID, "text")
    heads = whole.join(pairs, whole[RID] == pairs["next"]).select(
        F.col("own").alias(RID), "doc_id", "cut", F.expr("substring(text, 1, cut)").alias("head"), digests(F.col("text")).alias("b"))
    rows = whole.join(heads, RID).withColumn("n_chars", F.char_length("text").cast("long")) \
        .withColumn("edited", F.expr("concat(substring(text, 1, CAST(n_chars AS INT) - cut), head)")) \
        .select(RID, "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("e"), "b")
    # kinds 0 and 1: the fingerprints; 2: edited text against own; 3: next document against own
    entry = "transform({0}, x -> struct({1} AS kind, {2}L AS side, {3} AS b, x AS d))"
    entries = ", ".join(entry.format(*x) for x in [
        ("a", 0, 1, "1L"), ("e", 1, 1, "1L"), ("a", 2, 1, "be"), ("e", 2, -1, "be"), ("a", 3, 1, "bn"), ("b", 3, -1, "bn")])
    long = rows.select(RID, "a", "e", "b", F.expr(_buckets("size(a) + size(e)")).alias("be"), F.expr(_buckets("size(a) + size(b)")).alias("bn")) \
        .select(RID, F.explode(F.expr(f"concat({entries})")).alias("x")).select(RID, "x.*")
    per = _summed(long, "kind").select(
        RID, "kind", F.when(F.col("kind") < 2, sketch_text(_cells())).alias("print"), F.when(F.col("kind") >= 2, _peeled()).alias("s")) \
        .groupBy(RID).agg(
            F.max(F.expr("if(kind = 0, print, NULL)")).alias("fingerprint"), F.max(F.expr("if(kind = 1, print, NULL)")).alias("edited_fingerprint"),
            *[F.sum(F.expr(f"if(kind = {k}, size(s.found), 0)")).cast("long").alias(f"d{k}") for k in (2, 3)],
            *[F.min(F.expr(f"if(kind = {k}, {_CLEAN}, true)")).alias(f"ok{k}") for k in (2, 3)])
    empty = sketch_text("array_repeat(named_struct('n', 0L, 'k', 0L, 'h', 0L), %d)" % CELLS)
    ok = lambda k: F.coalesce(f"ok{k}", F.lit(True))
    again = ~(ok(2) & ok(3))
    first = saved(rows.join(per, RID, "left").select(
        RID, "doc_id", "n_chars", "edited_sha256", F.size("a").alias("na"), F.size("e").alias("ne"), F.size("b").alias("nb"),
        F.coalesce("fingerprint", empty).alias("fingerprint"), F.coalesce("edited_fingerprint", empty).alias("edited_fingerprint"),
        F.coalesce("d2", F.lit(0)).alias("d2"), F.coalesce("d3", F.lit(0)).alias("d3"), ok(2).alias("ok2"), ok(3).alias("ok3"),
        *[F.when(again, F.col(c)).alias(c) for c in ("a", "e", "b")]))
    # sketches that kept cells are made anew, larger
    failed = first.filter("NOT (ok2 AND ok3)")
    if failed.limit(1).count():
        versions = failed.select(RID, F.explode(F.expr(
            "filter(array(struct(2 AS pair, a, e AS o, ok2 AS ok), struct(3 AS pair, a, b AS o, ok3 AS ok)), x -> NOT x.ok)")).alias("x")) \
            .select(RID, "x.pair", "x.a", "x.o")
        gone = differences(versions, factor=4).groupBy(RID).agg(*[F.max(F.expr(f"if(pair = {k}, differing, NULL)")).alias(f"r{k}") for k in (2, 3)])
        first = first.join(gone, RID, "left").withColumn("d2", F.coalesce("r2", "d2")).withColumn("d3", F.coalesce("r3", "d3"))
    return first.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                        likeness("na", "ne", "d2").alias("near_edited"), likeness("na", "nb", "d3").alias("near_next"))
