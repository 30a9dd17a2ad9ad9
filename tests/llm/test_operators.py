"""Every corpus operator against plain Python, with nulls, empty and very long
texts, ties, repeated rows, empty tables and columns with clashing names."""
import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm import (bpe, common, exact_dedup, fingerprint, html_extract, jaccard_join, language_id, license_scan,
                          mixing, substring_dedup, toxicity)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def docs_of(spark):
    """Documents of (doc_id, text[, lang[, source]]), over a few partitions; ``extra`` adds
    columns whose names the operators also use."""
    def make(rows, extra=False, parts=3):
        rows = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        df = spark.createDataFrame([r + (len(r[1]) if r[1] is not None else None,) for r in rows], DOC).repartition(parts)
        if extra:
            for name in ("score", "kept", "size", "rank", "n", "gid", "sig", "ids", "path", "component", "_tl_rid"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return make


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def corpus(seed=1, n=60):
    """Texts with copies, near copies, shared passages, odd white space and odd rows."""
    rng = random.Random(seed)
    rows, base = [], [words(rng, rng.choice([3, 8, 40, 120])) for _ in range(n)]
    passage = words(rng, 50)
    for i, w in enumerate(base):
        rows.append((i, " ".join(w)))
        if i % 7 == 0:
            rows.append((100 + i, "\t".join(w) + "\n"))
        if i % 5 == 0 and len(w) > 20:
            v = list(w)
            v[rng.randrange(len(v))] = "changed"
            rows.append((200 + i, " ".join(v)))
        if i % 6 == 0:
            rows.append((300 + i, " ".join(w + passage + words(rng, 9))))
    rows += [(900, None), (901, ""), (902, "  \n "), (None, "a b c"), (903, "a b c"), (904, "A  b\tc"), (5, " ".join(base[5])),
             (905, "é ü 漢字 ½  x"), (906, " ".join(words(rng, 6000, 90))), (907, "x" * 70_000), (908, "one two"), (908, "one two")]
    return rows


def test_exact_dedup(docs_of):
    rows = corpus()
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    size, low = Counter(norm), {}
    for (d, _), t in zip(rows, norm):
        if d is not None:
            low[t] = min(low.get(t, d), d)
    got = exact_dedup.exact_dedup(docs_of(rows, extra=True)).collect()
    exp = Counter((d, low.get(t), size[t], hashlib.sha256(t.encode()).hexdigest()) for (d, _), t in zip(rows, norm))
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == exp
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(size)  # one row of each group, ties included
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_copies_keeps_columns(docs_of):
    df = docs_of(corpus(), extra=True)
    out = exact_dedup.drop_copies(df)
    assert [c for c in out.columns if not c.startswith("_tl")] == [c for c in df.columns if not c.startswith("_tl")]
    assert out.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in corpus()})


def test_near_duplicates(docs_of):
    rows = corpus()
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs_of(rows, extra=True)).collect())
    assert got == Counter(brute.near_components(rows))


def test_near_duplicates_on_a_family_of_copies(docs_of):
    """A large family round one text, a chain, and pairs at the threshold."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(90)]
    rows = [(i, " ".join("z%d" % i if j == rng.randrange(90) else w for j, w in enumerate(base))) for i in range(120)]
    chain = [f"c{i}" for i in range(60)]
    for i in range(25):
        rows.append((1000 + i, " ".join(chain)))
        chain = chain[1:] + [f"d{i}"]
    for n in range(5, 30):  # sizes n-4 and below, at and round 0.8
        w = [f"t{n}_{i}" for i in range(n)]
        rows += [(2000 + 10 * n, " ".join(w)), (2001 + 10 * n, " ".join(w[:-1])), (2002 + 10 * n, " ".join(w[: n * 4 // 5]))]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs_of(rows)).collect())
    assert got == Counter(brute.near_components(rows))


def test_sketch_never_misses_a_link():
    """Two sets that link share at least ``need`` lane signatures, whatever their sizes."""
    rng = np.random.default_rng(5)
    table = jaccard_join.bands(4096)
    for _ in range(300):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        drop = int(rng.integers(0, len(a) // 9 + 1))
        b = np.unique(np.concatenate((a[drop:], rng.integers(0, 2**64, int(rng.integers(0, len(a) // 9 + 1)), dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        if both * 100 < 80 * (len(a) + len(b) - both) or not len(b):
            continue
        sa, na = jaccard_join.lane_signatures(a, table)
        sb, nb = jaccard_join.lane_signatures(b, table)
        shared = len(np.intersect1d(np.concatenate(sa), np.concatenate(sb)))
        assert shared >= max(na, nb)


def test_drop_near_duplicates(docs_of):
    rows = corpus()
    out = [r.doc_id for r in jaccard_join.drop_near_duplicates(docs_of(rows, extra=True)).collect()]
    exp = brute.near_components(rows)
    assert len(out) == len({c for _, _, c in exp if c is not None}) + sum(c is None for _, _, c in exp) + sum(
        n == 0 and Counter(e[0] for e in exp)[d] > 1 for d, n, _ in exp)


def test_substring_dedup(docs_of):
    rows = corpus()
    got = substring_dedup.substring_dedup(docs_of(rows, extra=True), kept_as=lambda t: F.sha2(t.cast("binary"), 256)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == Counter(brute.repeated_cover(rows))


@pytest.mark.parametrize("window", [1, 2, 7, 20])
def test_substring_dedup_other_windows(docs_of, window):
    rows = [r for r in corpus(2, 20) if r[0] != 906]
    got = substring_dedup.substring_dedup(docs_of(rows), window, kept_as=lambda t: F.sha2(t.cast("binary"), 256)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == Counter(brute.repeated_cover(rows, window))


def test_substring_dedup_returns_texts_and_spans(docs_of):
    p = " ".join(f"p{i}" for i in range(40))
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(docs_of([(1, "a b " + p + " c"), (2, p), (3, "x  y")])).collect()}
    assert got[1].kept == "a b c" and [tuple(s) for s in got[1].removed] == [(2, 42)]
    assert got[2].kept == "" and got[2].n_removed == 40 and got[3].kept == "x y" and got[3].removed == []


def test_bpe_equals_tiktoken(docs_of):
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = corpus() + [(950, "I'll  don't  we've\r\n\r\n <|endoftext|> 😀🇩🇪 ſK 12½ ..."), (951, "ab" * 40_000), (952, " " * 3000 + "x"),
                       (953, "naïvé ümläut\x85\x1c end  "), (954, "日本語のテキスト" * 50)]
    out = bpe.encode(docs_of(rows, extra=True), RANKS, public_tokenizers.PATTERN, ["doc_id", "text"], with_bytes=True).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.ids == enc.encode_ordinary(r.text or ""), r.doc_id
        assert bytes(r.decoded) == (r.text or "").encode()
    tokens = bpe.encode(docs_of(rows), RANKS, public_tokenizers.PATTERN, ["doc_id", "text"])
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in bpe.decode(tokens, RANKS, ["doc_id", "text"]).collect())


def test_bpe_rejects_unknown_ids(spark):
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([([50_300],)], "ids array<int>"), RANKS, []).collect()


def test_mixing(docs_of):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, rng.choice([0, 1, 5, 50, 400]))), "en", rng.choice(["a", "b", "c", "d", None, "hot", "hot", "hot"]))
            for i in range(700)] + [(None, "x y", "en", "a"), (5, None, "en", "none"), (7, "same row", "en", "b"), (7, "same row", "en", "b")]
    rep = [r.asDict() for r in mixing.mix_report(docs_of(rows, extra=True)).collect()]
    assert rep.__len__() == len(rows)
    per = Counter()
    for _, t, _, s in rows:
        per[s] += len((t or "").split())
    names = sorted((s for s in per if s is not None)) + [None]
    target, w = {}, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free = 1.5 * sum(per.values()), set(names)
    while True:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if w[s] * level >= 2 * per[s]}
        if not full:
            break
        for s in full:
            target[s] = 2.0 * per[s]
            left -= target[s]
        free -= full
    target |= {s: w[s] * level for s in free}
    taken = Counter()
    for r in rep:
        assert r["source_size"] == per[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= 400
    again = Counter((r.doc_id, r.size, r.taken) for r in mixing.mix_report(docs_of(rows, parts=5)).collect())
    assert again == Counter((r["doc_id"], r["size"], r["taken"]) for r in rep)
    assert mixing.mix(docs_of(rows)).count() == sum(r["copies"] for r in rep)


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_html_extraction(spark):
    def page(body):
        return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x='</p>';</script></head><body>{body}"
    rows = [
        (1, "http://h.org/a", page('<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy</div><article><h1>Head &amp; tail</h1>'
                                   '<p>One\n  two&nbsp;three<p><b>Four<br>five</b></p><aside class="sidebar">S</aside><form><p>F</p></form>'
                                   '<section class="comments"><p>C</p></section><!-- x --></article><footer>&copy;</footer></body></html>')),
        (2, "http://h.org/b", page("<article><h1>Second</h1><p>Text cut off in the mid")),
        (3, "http://h.org/c", page('<div class="content-17"><p>' + "no article here " * 20 + "</p></div>")),
        (4, None, None), (5, "", ""), (6, "not a url", "plain <i>text</i> only"),
        (7, "http://other.net/", page('<header>Top</header><div id="menu">M</div><div class="post-9"><p>Alpha</p><p>Beta</p></div><div class="cookie-notice">N</div>')),
        (7, "http://other.net/", page('<div class="post-8"><p>Gamma &lt;b&gt;</p></div></div></div>')),
        (8, "http://long.net/", page("<article>" + "<p>" + "long " * 30_000 + "</p></article>")),
    ]
    got = sorted(((r.page_id, r.text, r.n_chars) for r in html_extract.extract(_pages(spark, rows).withColumn("path", F.lit(1)).withColumn("host", F.lit(2))).collect()))
    text = {}
    for i, t, n in got:
        assert n == len(t)
        text.setdefault(i, []).append(t)
    assert text[1] == ["Head & tail\n\nOne two three\n\nFour five"]
    assert text[2] == ["Second\n\nText cut off in the mid"]
    assert text[3] == [("no article here " * 20).strip()]
    assert text[4] == text[5] == [""] and text[6] == ["plain text only"]
    assert sorted(text[7]) == ["Alpha\n\nBeta", "Gamma <b>"]
    assert text[8] == [("long " * 30_000).strip()]


def test_host_consensus_overrules_one_page(spark):
    """On one page a teaser list is longer than the article; its host knows better."""
    usual = '<div class="wrap"><div class="left">{}</div><div class="text{}"><p>{}</p></div></div>'
    rows = [(i, "http://h.org/%d" % i, "<body>" + usual.format("teaser", i, "long article text " * 20)) for i in range(5)]
    rows.append((9, "http://h.org/9", "<body>" + usual.format("teaser words " * 80, 9, "short article")))
    got = {r.page_id: r.text for r in html_extract.extract(_pages(spark, rows)).collect()}
    assert got[9] == "short article"


@pytest.mark.parametrize("html, text", [
    ('<body><article class="comment-policy"><p>All of it</p></article>', "All of it"),
    ('<main><p>One</p><div class="share-price-analysis"><p>Two</p></div></main>', "One\n\nTwo"),
    ("<main><p>a <math><mi>x</mi><annotation>\\tex</annotation></math> b</p></main>", "a x b"),
    ('<body><div class="banner"><p>The only text</p></div><nav>n</nav><footer>f</footer>', "The only text"),
    ('<article><p>T</p><article class="comment">c</article><div class="share-buttons">s</div><div class="user-comments">u</div></article>', "T"),
])
def test_html_noise_words_do_not_take_articles(html, text):
    assert html_extract.main_text(html_extract.blocks(html), None)[0] == text


def test_html_equal_votes_go_to_the_first_path(spark):
    html = '<body><div class="post bbb"><p>second</p></div><div class="post aaa"><p>firsts</p></div>'
    assert html_extract.first_choice(html_extract.blocks(html))[0] == "/body/div.aaa.post"  # equal scores on a page
    rows = [(1, "http://h.org/1", '<body><div class="bbb"><p>one of two</p></div>'), (2, "http://h.org/2", '<body><div class="aaa"><p>two of two</p></div>')]
    got = {r.page_id: (r.text, r.path) for r in html_extract.extract(_pages(spark, rows)).collect()}
    assert got == {1: ("one of two", "/body/div.bbb"), 2: ("two of two", "/body/div.aaa")}
    votes = html_extract.host_paths(_pages(spark, rows).withColumn("host", F.lit("h.org"))).collect()
    assert [(r.path, r.pages) for r in votes] == [("/body/div.aaa", 1)]


def test_fingerprints(docs_of):
    rows = [r for r in corpus() if r[0] is not None and r[0] not in (5, 908)] + [(990, "line one\nline two\nline three\nline four"), (991, "line one\nline two\nline x")]
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs_of(rows, extra=True)).collect()}
    rows.sort()
    prints = {}
    for k, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(t) // 4
        edited = t[:len(t) - q] + nxt[:q]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())

        def pieces(x):
            return set(re.findall(r"(?:\S+[^\S\n]+){0,23}\S+", x, re.A))

        for near, other in ((r.near_edited, edited), (r.near_next, nxt)):
            a, b = pieces(t), pieces(other)
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0), d
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) >= len({frozenset(pieces(t)) for t in prints})


def test_fingerprint_odd_rows(docs_of):
    assert fingerprint.fingerprints(docs_of([(1, "only one")])).first().near_next == 1.0
    rows = [(None, "a\nb"), (None, "a\nb"), (3, "a\nc"), (3, "a\nc"), (4, None)]
    got = fingerprint.fingerprints(docs_of(rows)).collect()
    assert len(got) == 5 and all(0 <= r.near_edited <= 1 for r in got)


def test_fingerprint_recovers_differences(spark):
    """Peeling returns just the differing digests, also when the first size fails."""
    rng = random.Random(8)
    rows, exp = [], {}
    for i, (common_, left, right) in enumerate([(50, 3, 2), (0, 40, 0), (500, 200, 300), (0, 0, 0), (9, 0, 0)]):
        ids = [rng.randrange(-2**63, 2**63) for _ in range(common_ + left + right)]
        a, o = ids[:common_ + left], ids[:common_] + ids[common_ + left:]
        rows.append((i, 0, a, o))
        exp[i] = ({*a} - {*o}, {*o} - {*a})
    df = spark.createDataFrame(rows, f"{common.RID} long, pair int, a array<long>, o array<long>")
    got = fingerprint.differences(df, with_digests=True).collect()
    assert len(got) == len(rows)
    for r in got:
        assert ({d.digest for d in r.digests if d.side == 1}, {d.digest for d in r.digests if d.side == -1}) == exp[r[common.RID]]
        assert r.differing == len(r.digests)


def test_license_scan(docs_of):
    rows = corpus() + [
        (951, "Licensed under the Apache License, Version 2.0."), (952, "GNU General Public License; gnu general public license version 3"),
        (953, "CC-BY-NC 4.0 cc by CC BY"), (954, "the mit. license mit license"), (955, "gnu general public licence, apache, mit"),
        (956, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
        (957, "ApacheLicense apache license éapache license"), (958, "MIT LICENSE"), (958, "MIT LICENSE")]
    got = license_scan.scan(docs_of(rows, extra=True)).collect()
    assert len(got) == len(rows)
    exp = Counter()
    for d, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower_ascii(t or ""))
        at = [(i, label) for label, p in license_scan.BASE for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        exp[(d, len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at})))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == exp
    by = {r.doc_id: r for r in got}
    assert by[952].labels == "gpl,gpl-3.0" and by[953].labels == "cc-by,cc-by-nc" and by[956].labels == "mit" and by[956].base_labels == ""
    assert by[955].labels == "" and by[955].score == 0 and by[958].score == 1
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


LANGS = {"xx": "ka ri mo ten lu", "yy": "schu brö fle gra zwi", "zz": "ção nha lhe ões quei"}


def _language_rows(n=240):
    rng, rows = random.Random(6), []
    for i in range(n):
        lang = sorted(LANGS)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(LANGS[lang].split()) for _ in range(rng.randrange(1, 4))) for _ in range(rng.choice([4, 30, 200]))), lang))
    return rows


def test_language_id_held_out(docs_of):
    rows = _language_rows()
    odd = [(1000, None, "xx"), (1001, "", "yy"), (1002, "123 ... 😀", "zz"), (None, rows[0][1], "xx"), (1003, rows[1][1], None), (1003, rows[1][1], None),
           (1004, " ".join(rows[4 * 3][1].split()[:60] * 3 + rows[4 * 3 + 1][1].split()[:60] * 3) + " " + " ".join(r[1] for r in rows[30:42]), None),
           (1005, "ß", "yy")]
    got = language_id.identify(docs_of(rows + odd, extra=True)).collect()
    by = {r.doc_id: r for r in got}
    held = [(d, lang) for d, _, lang in rows if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(by[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, _, _ in rows) and not by[None].held_out
    assert sum(by[d].lang_pred == lang for d, lang in held) >= 0.98 * len(held)
    assert all(by[d].lang_pred == "und" and by[d].score == 0 for d in (1000, 1001, 1002))
    assert by[1005].lang_pred in LANGS and all(0 <= r.score <= 1 for r in got)
    assert len(by[1004].languages) > 1  # a mixture


def test_language_id_ignores_the_held_out_labels(docs_of):
    rows = _language_rows(90)
    wrong = [(d, t, "q" if zlib.crc32(str(d).encode()) % 4 == 2 else lang) for d, t, lang in rows]
    one, two = ({(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(docs_of(x)).collect()} for x in (rows, wrong))
    assert one == two


def _toxic_rows(n=600):
    rng, rows, labels = random.Random(9), [], []
    for i in range(n):
        w, bad = words(rng, rng.choice([10, 60, 150])), i % 8 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["Idiot", "scum,", "moron!"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_held_out(spark, docs_of):
    rows, labels = _toxic_rows()
    odd = [(1000, None), (1001, ""), (None, "idiot scum"), (1002, "idiot scum moron idiot"), (1003, "nice"), (1003, "nice")]
    lab = spark.createDataFrame(labels + [(1, 1, None), (None, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs_of(rows + odd, extra=True), lab).collect()
    assert len(got) == len(rows + odd)
    by = {r.doc_id: r for r in got}
    for d, _, y in labels:
        r = by[d]
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) == y
    assert by[1002].predicted == 1 and by[1003].predicted == 0 and by[1000].score == by[1001].score < 0.2
    assert by[1002].evidence[0].toxic == 1 and not by[None].held_out


def test_toxicity_without_labels(spark, docs_of):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity(docs_of([(1, "a"), (2, None)]), lab).collect()} == {0.5}
    assert toxicity.drop_toxic(docs_of([(1, "a"), (2, None)]), lab).count() == 2


def test_block_max_index_is_exact():
    rng = np.random.default_rng(2)
    vectors = []
    for _ in range(700):
        ids = np.sort(rng.choice(30, rng.integers(0, 6), replace=False))
        vectors.append(toxicity.weigh(ids, rng.integers(1, 4, len(ids)), np.linspace(1, 3, 30)))
    index = toxicity.BlockMaxIndex(vectors, 30)
    dense = np.zeros((700, 30))
    for e, (t, w) in enumerate(vectors):
        dense[e, t] = w
    for q in range(0, 700, 7):
        cos = np.round(dense @ dense[q], 12)
        cos[q] = 0
        order = [e for e in np.lexsort((np.arange(700), -cos)) if cos[e] > 0][:15]
        e, c = index.nearest(*vectors[q], 15, without=q)
        assert np.allclose(c, np.minimum(cos[order], 1)) and list(e) == order


def test_empty_tables(spark, docs_of):
    none = docs_of([])
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (exact_dedup.exact_dedup(none), exact_dedup.drop_copies(none), jaccard_join.near_duplicates(none),
                jaccard_join.drop_near_duplicates(none), substring_dedup.substring_dedup(none), language_id.identify(none),
                toxicity.toxicity(none, lab), mixing.mix_report(none), mixing.mix(none), fingerprint.fingerprints(none), license_scan.scan(none),
                bpe.encode(none, RANKS, public_tokenizers.PATTERN, ["doc_id"]), html_extract.extract(_pages(spark, []))):
        assert out.count() == 0


def test_components_reach_across_a_long_chain(spark):
    n = 300
    ids = list(range(n))
    random.Random(1).shuffle(ids)
    edges = spark.createDataFrame([(ids[i], ids[i + 1]) for i in range(n - 1) if i != 150], "a long, b long")
    got = {r.node: r.component for r in common.components(edges).collect()}
    assert {got[ids[i]] for i in range(151)} == {min(ids[:151])} and {got[ids[i]] for i in range(151, n)} == {min(ids[151:])}


def test_toxicity_weak_terms_are_evidence(spark, docs_of):
    """A term twice as likely under one label finds neighbours too."""
    name = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    rows = [(i, ("often " if i // 2 % 3 < 1 + i % 2 else "") + f"x{name(i)}") for i in range(1200)]
    lab = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs_of(rows + [(5000, "often")]), lab).filter("doc_id = 5000").collect()
    assert len(got[0].evidence) == 3


def test_toxicity_keeps_every_term_of_the_examples(spark, docs_of):
    """Words that have nothing to do with the label lead to examples, too."""
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, 40))) for i in range(300)]
    held = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 3 == 1)
    seen = next(i for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1)
    lab = spark.createDataFrame([(i, 1, int(i == seen)) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs_of(rows + [(held, rows[seen][1])]), lab).collect()}
    assert all(len(r.evidence) == 3 for r in got.values())
    assert got[held].evidence[0].doc_id == seen and got[held].evidence[0].cosine == 1.0 and got[held].evidence[0].toxic == 1


def test_jaccard_join_lists_every_link(spark, docs_of):
    """All pairs by brute force, in families whose members differ a little or a lot."""
    rng, rows = random.Random(21), []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(rng.choice([30, 90, 200]))]
        for _ in range(25):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                w[rng.randrange(len(w))] = rng.choice(["alpha", "beta", f"n{rng.randrange(10**6)}"])
            rows.append((len(rows), " ".join(w)))
    rows += [(900, ""), (901, None), (902, "one two"), (903, "One  two")]
    docs, links = jaccard_join.near_duplicate_links(docs_of(rows))
    sets, first = {}, {}
    for d, text in rows:
        w = (text or "").lower().split()
        sets[d] = frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))
        first.setdefault(sets[d], d)
    docs = docs.collect()
    alike = {}
    for r in docs:
        alike.setdefault(r.class_id, set()).add(r.doc_id)
    assert alike.pop(None) == {900, 901}
    assert sorted(map(sorted, alike.values())) == sorted(sorted(d for d in sets if sets[d] == s) for s in first if s)
    name = {c: min(members) for c, members in alike.items()}
    got = sorted(tuple(sorted((name[r.class_a], name[r.class_b]))) for r in links.collect())
    reps = sorted(d for s, d in first.items() if s)
    want = [(a, b) for i, a in enumerate(reps) for b in reps[i + 1:] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert len(want) > 300 and got == want
