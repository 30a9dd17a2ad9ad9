"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (bpe, collocations, decontaminate, exact_dedup, fingerprint, html_extract, jaccard_join, language_id,
                          license_scan, merkle, mixing, substring_dedup, toxicity)
from tideline.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark, sf):
    scored = toxicity.toxicity(read(spark, sf, "documents"), read(spark, sf, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "evidence")


def op2_exact_dedup(spark, sf):
    return exact_dedup.exact_dedup(read(spark, sf, "documents"))


def op3_html_extraction(spark, sf):
    return html_extract.extract(read(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


def op4_fingerprints(spark, sf):
    return fingerprint.fingerprints(read(spark, sf, "documents"))


def op5_ngram_jaccard_join(spark, sf):
    return jaccard_join.near_duplicates(read(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_byte_bpe(spark, sf):
    tokens = bpe.encode(read(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN, ["doc_id"], with_bytes=True)
    return tokens.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_source_mixing(spark, sf):
    return mixing.mix_report(read(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_license_scan(spark, sf):
    return license_scan.scan(read(spark, sf, "documents"))


def op9_substring_dedup(spark, sf):
    cut = substring_dedup.substring_dedup(read(spark, sf, "documents"), kept_as=lambda t: F.sha2(t.cast("binary"), 256))
    return cut.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op10_language_id(spark, sf):
    return language_id.identify(read(spark, sf, "documents"))


def op11_collocations(spark, sf):
    return collocations.collocations(read(spark, sf, "documents"))


def op12_merkle_manifest(spark, sf):
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    fields = [text if f == "text" else F.col(f) for f in merkle.FIELDS]
    rows = merkle.manifest(read(spark, sf, "documents"), carry={"seen": merkle.leaf_of(fields)})
    back = merkle.folded(F.col("seen"), F.col("path"))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"),
                       back.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_decontamination(spark, sf):
    found = decontaminate.report(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.col("items").cast("binary"), 256).alias("items_sha256"),
                        "contaminated")


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_fingerprints": op4_fingerprints,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_source_mixing": op7_source_mixing,
    "op8_license_scan": op8_license_scan,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language_id": op10_language_id,
    "op11_collocations": op11_collocations,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_decontamination": op13_decontamination,
}

ORACLE_SQL = {
    "op2_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
""",
    "op5_ngram_jaccard_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT id, count(*) AS n FROM s GROUP BY id
), pairs AS (
  SELECT x, y FROM (SELECT a.id AS x, b.id AS y, count(*) AS same FROM s a JOIN s b ON b.g = a.g AND a.id < b.id GROUP BY ALL)
  JOIN n na ON na.id = x JOIN n nb ON nb.id = y WHERE 100 * same >= 80 * (na.n + nb.n - same)
), links AS (
  SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs
), reach AS (
  SELECT id, id AS other FROM d UNION SELECT reach.id, links.y FROM reach JOIN links ON links.x = reach.other
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM d JOIN reach ON reach.id = d.id JOIN d o ON o.id = reach.other LEFT JOIN n ON n.id = d.id GROUP BY d.id, d.doc_id
""",
    "op9_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT id, i, array_to_string(w[i:i + 34], ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - 33)) AS i FROM d)
), repeated AS (
  SELECT id, i FROM windows JOIN (SELECT g FROM windows GROUP BY g HAVING count(*) > 1) USING (g)
), gone AS (
  SELECT DISTINCT id, unnest(range(i, i + 35)) AS p FROM repeated
), places AS (
  SELECT id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT id, string_agg(word, ' ' ORDER BY p) AS text FROM places ANTI JOIN gone USING (id, p) GROUP BY id
), removed AS (
  SELECT id, count(*) AS n FROM gone GROUP BY id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(removed.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (id) LEFT JOIN removed USING (id)
""",
    "op7_source_mixing": r"""
WITH d AS (
  SELECT doc_id, source, md5('mix|' || doc_id) AS spread,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM d GROUP BY source
), o AS (
  SELECT source, source_size, w, source_size * 2.0::DOUBLE AS lim,
         row_number() OVER (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST) AS k FROM s
), p AS (
  SELECT *, (SELECT sum(source_size) FROM s) * 1.5::DOUBLE AS want,
         coalesce(sum(lim) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM o
), lv AS (
  SELECT (want - held) / free AS level FROM p WHERE w * ((want - held) / free) < lim ORDER BY k LIMIT 1
), t AS (
  SELECT source, source_size, least(w * coalesce((SELECT level FROM lv), 1e300), lim) AS target FROM o
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         CAST(row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.spread, d.doc_id) - 1 AS DOUBLE) AS pos,
         CAST(('0x' || substr(md5('mix|' || coalesce(d.source, '')), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0::DOUBLE AS off
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(floor((pos + 1) * rate + off) - floor(pos * rate + off) AS BIGINT) * size AS taken
FROM r
""",
    "op11_collocations": r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), spot AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3)) AS ks(k)
), g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM spot GROUP BY ALL
), total AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:], ' ') AS tail FROM (
    SELECT *, unnest(range(1, k)) AS c FROM cand)
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, c, h.f AS l, t.f AS r,
         CAST((1000000::HUGEINT * a * a) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM cuts JOIN g h ON h.lang = cuts.lang AND h.phrase = head JOIN g t ON t.lang = cuts.lang AND t.phrase = tail
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), around AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE k = 3) GROUP BY ALL
), ranked AS (
  SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""",
    "op12_merkle_manifest": r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS t
), d AS (
  SELECT *, row_number() OVER () AS id,
         CASE WHEN xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 2 = 0
              THEN replace(text, chr(10), '') ELSE text END AS seen_text
  FROM documents, crc
), e AS (
  SELECT id, doc_id, source,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS fields,
         coalesce(strlen(text) || ':' || text, '-') AS own, coalesce(strlen(seen_text) || ':' || seen_text, '-') AS seen
  FROM d
), leaves AS (
  SELECT id, doc_id, source, sha256(fields || own) AS leaf, sha256(fields || seen) AS seen_leaf FROM e
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), tree AS (
  SELECT source, 0 AS lvl, pos, leaf AS node, count(*) OVER (PARTITION BY source) AS n FROM placed
  UNION ALL
  SELECT source, lvl + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
  FROM tree WHERE n > 1 GROUP BY source, lvl, pos // 3, n
), subs AS (
  SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS lvl, pos, subroot AS node, (SELECT count(*) FROM subs) AS n FROM subs
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
  FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n
), siblings AS (
  SELECT p.id, t.lvl, t.pos < p.pos // CAST(pow(3, t.lvl) AS BIGINT) AS before, t.pos, t.node
  FROM placed p JOIN tree t ON t.source IS NOT DISTINCT FROM p.source AND t.n > 1
   AND t.pos // 3 = p.pos // CAST(pow(3, t.lvl + 1) AS BIGINT) AND t.pos <> p.pos // CAST(pow(3, t.lvl) AS BIGINT)
  UNION ALL
  SELECT p.id, 1000 + t.lvl, t.pos < s.pos // CAST(pow(3, t.lvl) AS BIGINT), t.pos, t.node
  FROM placed p JOIN subs s ON s.source IS NOT DISTINCT FROM p.source JOIN top t ON t.n > 1
   AND t.pos // 3 = s.pos // CAST(pow(3, t.lvl + 1) AS BIGINT) AND t.pos <> s.pos // CAST(pow(3, t.lvl) AS BIGINT)
), levels AS (
  SELECT p.id, t.lvl FROM placed p JOIN (SELECT DISTINCT source, lvl FROM tree WHERE n > 1) t ON t.source IS NOT DISTINCT FROM p.source
  UNION ALL SELECT p.id, 1000 + t.lvl FROM placed p, (SELECT DISTINCT lvl FROM top WHERE n > 1) t
), steps AS (
  SELECT l.id, row_number() OVER (PARTITION BY l.id ORDER BY l.lvl) AS step, b, a FROM levels l LEFT JOIN (
    SELECT id, lvl, coalesce(string_agg(node, '' ORDER BY pos) FILTER (before), '') AS b,
           coalesce(string_agg(node, '' ORDER BY pos) FILTER (NOT before), '') AS a FROM siblings GROUP BY id, lvl) x
    ON x.id = l.id AND x.lvl = l.lvl
), fold AS (
  SELECT id, 0 AS step, seen_leaf AS node FROM placed
  UNION ALL
  SELECT fold.id, fold.step + 1, sha256(coalesce(b, '') || node || coalesce(a, '')) FROM fold JOIN steps ON steps.id = fold.id AND steps.step = fold.step + 1
), ends AS (
  SELECT id, arg_max(node, step) AS folded_root FROM fold GROUP BY id
), proofs AS (
  SELECT id, sha256(string_agg(node, '' ORDER BY lvl, pos)) AS proof_sha256 FROM siblings GROUP BY id
)
SELECT p.doc_id, p.leaf, s.subroot, r.node AS root, coalesce(proofs.proof_sha256, sha256('')) AS proof_sha256,
       ends.folded_root, ends.folded_root = r.node AS verified
FROM placed p JOIN subs s ON s.source IS NOT DISTINCT FROM p.source JOIN ends ON ends.id = p.id
LEFT JOIN proofs ON proofs.id = p.id, (SELECT node FROM top WHERE n = 1) r
""",
    "op13_decontamination": r"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), starts AS (
  SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0
), wins AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM starts
), d AS (
  SELECT doc_id, row_number() OVER () AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), places AS (
  SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM wins) ks
), hits AS (
  SELECT id, i, p.k, item FROM places p JOIN wins ON wins.k = p.k AND wins.g = array_to_string(w[i:i + p.k - 1], ' ')
), covered AS (
  SELECT id, count(*) AS n_hit FROM (SELECT DISTINCT id, unnest(range(i, i + k)) AS word FROM hits) GROUP BY id
), found AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM hits) GROUP BY id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (id) LEFT JOIN found USING (id)
""",
}
