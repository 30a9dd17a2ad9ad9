"""Collocation mining, the Merkle manifest and benchmark decontamination against
plain Python, with nulls, empty and very long texts, ties, repeated rows, empty
tables and columns with clashing names."""
import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import brute
from tideline.llm import collocations, decontaminate, merkle

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])
ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
CLASHING = ("rank", "phrase", "tree", "node", "item", "path", "root", "start", "hash", "w", "h", "n", "score", "_tl_rid", "words")


@pytest.fixture()
def docs_of(spark):
    def make(rows, extra=False, parts=3):
        rows = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        df = spark.createDataFrame([r + (len(r[1]) if r[1] is not None else None,) for r in rows], DOC).repartition(parts)
        for name in CLASHING if extra else ():
            df = df.withColumn(name, F.lit("x"))
        return df
    return make


# -------------------------------------------------------------- collocations
def phrases(rows, least, top, percent=50):
    """(doc_id, text, lang) -> the ranked phrases of each language."""
    counts, n = {}, Counter()
    for _, text, lang in rows:
        c = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", brute.lower_ascii(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            c.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= percent * a for q, b in found.items()):
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, r[2].decode(), -r[1], r[3], r[4], n[lang], -r[0]) for i, r in enumerate(sorted(rows)[:top])]
    return sorted(out)


def chatter(seed, n, vocabulary=12):
    rng = random.Random(seed)
    ends = [" ", " ", " ", " ", ", ", ". ", "\n", "\t", ";", "  "]
    return [(i, "".join(rng.choice(["Foo", "bar", "é", "ß", "A\x01", "a", "漢字"]) + str(rng.randrange(vocabulary)) + rng.choice(ends)
                        for _ in range(rng.choice([0, 1, 5, 60, 300]))), rng.choice(["en", "de", None])) for i in range(n)]


@pytest.mark.parametrize("head, range_paths", [(7, 21), (4096, 1_000_000)])
def test_collocations_against_plain_python(docs_of, head, range_paths):
    """Ranges of a few paths cut words and word pairs; the result is the same."""
    rows = chatter(3, 80) + [(1, None, "en"), (2, "", "en"), (None, "the the the the " * 40, "und"), (7, "x y z", "fr"), (7, "x y z", "fr"),
                             (8, "one two three four, " * 3000, "en"), (9, "...\n;!", "xx")]
    got = collocations.collocations(docs_of(rows, extra=True), least=4, top=40, range_paths=range_paths, head=head)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == phrases(rows, 4, 40)


def test_long_text_is_cut_between_pieces(docs_of, monkeypatch):
    rows = [(1, "alpha beta gamma. " * 400 + "delta " * 900, "en"), (2, "alpha beta", None)]
    monkeypatch.setattr(collocations, "SHARD_BYTES", 500)
    parts = list(collocations._segments(*[x for i, j, *x in collocations.C.text_passes(
        collocations.pa.array([rows[0][1]]), 500)][0]))
    assert len(parts) > 10 and sum(len(p[0]) for p in parts) == len(rows[0][1])
    assert sorted(tuple(r) for r in collocations.collocations(docs_of(rows), least=2).collect()) == phrases(rows, 2, 2000)


def test_scores_pass_64_bits(spark):
    big = 3_000_000_000
    candidates = spark.createDataFrame([("en", "a b", big)], "lang string, phrase string, a long")
    counts = spark.createDataFrame([("en", "a", 1, big + 7), ("en", "b", 1, 2 * big + 1)], "lang string, phrase string, size int, n long")
    row = collocations.composed(candidates, counts).first()
    assert row.score == 1_000_000 * big * big // ((big + 7) * (2 * big + 1))


def test_collocations_of_nothing(docs_of):
    assert collocations.collocations(docs_of([])).count() == 0
    assert collocations.collocations(docs_of([(1, None), (2, "a b")])).count() == 0


def test_transducer_keeps_paths_and_sums_unions():
    rng = random.Random(5)

    def paths(n):
        words = [bytes([97 + rng.randrange(9)]) * rng.randrange(1, 3) for _ in range(n)]
        w, c = collocations.coded(collocations.pa.array(words, collocations.pa.binary()))
        z = collocations.np.concatenate([c, [0, 0]])
        return collocations.summed(w, c, z[1:-1], z[2:])

    a, b = paths(500), paths(300)
    said = lambda p: {tuple(p.head(i)): int(p.n[i]) for i in range(len(p))}
    ma, mb = collocations.built(a), collocations.built(b)
    assert len(ma["out"]) < len(ma["two"])  # equal last states are kept once
    assert Counter(said(collocations.united([ma, mb]))) == Counter(said(a)) + Counter(said(b))
    ordered = [a.head(i) for i in range(len(a))]
    assert ordered == sorted(ordered)
    for probe in ([b"a"], [b"a", b"zz"], [b"0"], [b"zzz"], ordered[7], [b"bb", b"c", b"a0"]):
        assert a.find(probe) == sum(x < probe for x in ordered)


# ------------------------------------------------------------------ manifest
def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def steps(tree, i):
    out = []
    for nodes in tree[:-1]:
        run = nodes[i // 3 * 3:i // 3 * 3 + 3]
        out.append((i % 3, [x for k, x in enumerate(run) if k != i % 3]))
        i //= 3
    return out


def manifest_of(rows):
    """(doc_id, source, lang, n_chars, text) -> [(doc_id, source, leaf, subroot, root, path)]"""
    leaves = {}
    for r in rows:
        leaves.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, H("".join(map(encoded, r))), r[0]))
    names = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        leaves[s].sort(key=lambda x: x[:3])
        trees[s] = levels([x[2] for x in leaves[s]])
    top = levels([trees[s][-1][0] for s in names]) if names else [[]]
    return [(x[3], s, x[2], trees[s][-1][0], top[-1][0], steps(trees[s], i) + steps(top, k))
            for k, s in enumerate(names) for i, x in enumerate(leaves[s])]


def _got(df):
    return [(r.doc_id, r.source, r.leaf, r.subroot, r.root, [(p.place, list(p.siblings)) for p in r.path]) for r in df.collect()]


_key = lambda r: (str(r[1]), str(r[0]), r[2], str(r[5]))


@pytest.mark.parametrize("block_levels", [1, 2, 5])
def test_manifest_against_plain_python(docs_of, monkeypatch, block_levels):
    """Small blocks make several rounds and trees whose last subtree is cut short."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    rows = [(i, f"text {i}\n", "en", "hot") for i in range(59)] + [(i, "x", None, f"s{i % 7}") for i in range(100, 117)]
    rows += [(None, None, None, None), (None, "", "é", None), (3, "twice", "en", "hot"), (3, "twice", "en", "hot"), (1, "a", "en", ""),
             (2, "漢" * 70_000, "zh", "ß"), (-5, "minus", "en", "hot")]
    docs = docs_of(rows, extra=True)
    exp = manifest_of([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()])
    got = merkle.manifest(docs)
    assert sorted(_got(got), key=_key) == sorted(exp, key=_key)
    assert got.filter(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


def test_manifest_tells_a_changed_row(docs_of):
    rows = [(i, f"line {i}\nmore", "en", f"s{i % 3}") for i in range(40)]
    changed = merkle.leaf_of([F.regexp_replace("text", "\n", "") if f == "text" else F.col(f) for f in merkle.FIELDS])
    kept = merkle.manifest(docs_of(rows), carry={"seen": F.when(F.col("doc_id") % 4 == 0, changed).otherwise(
        merkle.leaf_of([F.col(f) for f in merkle.FIELDS]))})
    bad = {r.doc_id for r in kept.filter(merkle.folded(F.col("seen"), F.col("path")) != F.col("root")).collect()}
    assert bad == {i for i in range(40) if i % 4 == 0}


def test_manifest_of_one_row_and_none(docs_of):
    row = merkle.manifest(docs_of([(1, "a", "en", "s")])).first()
    assert row.leaf == row.subroot == row.root and row.path == []
    assert merkle.manifest(docs_of([])).count() == 0


# ----------------------------------------------------------- decontamination
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def found(docs, items, size=10):
    """(doc_id, text), (item_id, text) -> [(doc_id, n_words, n_hit, n_items, items)]"""
    windows = {}
    for item, text in items:
        w = WORD.findall(brute.lower_ascii(text or ""))
        k = min(len(w), size)
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add("" if item is None else str(item))
    out = []
    for d, text in docs:
        w = WORD.findall(brute.lower_ascii(text or ""))
        hit, named = set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit |= set(range(i, i + k))
                    named |= windows[tuple(w[i:i + k])]
        out.append((d, len(w), len(hit), len(named), ",".join(sorted(named)), bool(hit)))
    return sorted(out, key=str)


def leaky(seed=2):
    rng = random.Random(seed)
    say = lambda n: [rng.choice(["Aa", "b", "é", "ÉÈ", "x9", "漢字", "Q"]) + str(rng.randrange(30)) for _ in range(n)]
    items = [(i, " ".join(say(rng.choice([3, 10, 25])))) for i in range(12)]
    items += [(3, items[3][1]), (50, items[4][1]), (None, "null item of some words here"), (60, ""), (61, None), (62, "!!")]
    docs = []
    for i in range(60):
        w = say(rng.choice([0, 5, 40]))
        if i % 4 == 0:
            w[len(w) // 2:len(w) // 2] = items[i % 12][1].upper().split() if i % 8 else items[i % 12][1].split()
        docs.append((i, rng.choice([" ", ", ", "\n-- "]).join(w)))
    long = say(4000)
    docs += [(100, " ".join(long + items[2][1].split() * 3 + long)), (101, None), (102, ""), (103, "... !"), (5, docs[5][1]),
             (None, items[2][1]), (104, "  (" + items[2][1] + ") tail"), (105, "Null item of some words, here")]
    return docs, items


@pytest.mark.parametrize("set_rows", [1 << 20, 17])
def test_decontamination_report(spark, docs_of, set_rows):
    """A set of 17 hashes makes several passes with the same result."""
    docs, items = leaky()
    bench = spark.createDataFrame(items, ITEM).withColumn("hash", F.lit("x"))
    got = decontaminate.report(docs_of(docs, extra=True), bench, set_rows=set_rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == found(docs, items)


def test_decontaminated_documents(spark, docs_of):
    docs, items = leaky()
    bench = spark.createDataFrame(items, ITEM)
    source = docs_of(docs, extra=True)
    bad = Counter(r[0] for r in found(docs, items) if r[5])
    whole = decontaminate.decontaminate(source, bench, remove="documents")
    assert whole.columns == source.columns
    assert Counter(r.doc_id for r in whole.collect()) == Counter(d for d, _ in docs) - bad
    cut = decontaminate.decontaminate(source, bench)
    assert cut.columns == source.columns
    texts = sorted(((r.doc_id, r.text) for r in cut.collect()), key=str)
    before = {d: (n, hit) for d, n, hit, *_ in found(docs, items)}
    for d, text in texts:
        assert len(WORD.findall(brute.lower_ascii(text or ""))) == before[d][0] - before[d][1]
    untouched = {(d, t) for d, t in docs if d not in bad}
    assert untouched <= set(texts)
    assert dict(texts)[104] == "  () tail" and dict(texts)[None] == ""


def test_empty_benchmark_and_documents(spark, docs_of):
    docs, items = leaky()
    none = spark.createDataFrame([], ITEM)
    got = decontaminate.report(docs_of(docs), none).collect()
    assert len(got) == len(docs) and not any(r.contaminated or r.n_items for r in got)
    assert decontaminate.decontaminate(docs_of(docs), none).count() == len(docs)
    assert decontaminate.report(docs_of([]), spark.createDataFrame(items, ITEM)).count() == 0
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs_of(docs), none, remove="words")
