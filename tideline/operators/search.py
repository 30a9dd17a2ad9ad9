"""Document match (S9, S10, O2): word-token match on a text field, ordered by a
numeric score.  Whole texts are matched; the only limit is the requested
top-k, computed per partition before one merge (TakeOrderedAndProject)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.columns import c

# A Han character is a token of its own; other tokens are runs of letters and digits.
_EDGE = r"[^\p{L}\p{N}]|\p{IsHan}"


def _terms(query: str) -> list[str]:
    import regex
    return sorted(set(regex.findall(r"\p{Han}|[[\p{L}\p{N}]--\p{Han}]+", query.lower(), flags=regex.V1)))


def matches_any_term(text, query: str) -> F.Column:
    """True when the lower-cased text holds any query word as a whole token.

    Terms are letters/digits only, so an anchored regex over the text equals
    token-set overlap without building a token array per document.
    """
    terms = _terms(query)
    if not terms:
        return F.lit(False)
    import regex
    han = "".join(t for t in terms if regex.fullmatch(r"\p{Han}", t))
    words = "|".join(t for t in terms if t not in han)
    pattern = "|".join(p for p in (f"[{han}]" if han else "", f"(^|{_EDGE})({words})({_EDGE}|$)" if words else "") if p)
    low = F.lower(c(text))
    # A plain substring test first (cheap byte search); the regex confirms
    # whole-word matches only on texts that contain some term.
    has_any = F.lit(False)
    for t in terms:
        has_any = has_any | low.contains(t)
    return has_any & low.rlike(pattern)


def term_match_search(docs: DataFrame, query: str, text_col: str = "name",
                      score_col: str = "score", id_col: str = "id", limit: int = 10) -> DataFrame:
    """Documents matching ``query`` on ``text_col``, ascending by score
    (ties by id, null scores last), top ``limit``."""
    hits = docs.where(matches_any_term(text_col, query))
    return hits.orderBy(F.col(score_col).asc_nulls_last(), F.col(id_col).asc()).limit(limit)


# ------------------------------------------------------------------ postings
#: Partitions of a postings table; a search reads those of its tokens only.
POSTING_PARTS = 64
#: Files of a partition: a token that a third of all documents hold is written by several tasks.
POSTING_FILES = 4
_TOKEN = r"\p{IsHan}|[\p{L}\p{N}&&[^\p{IsHan}]]+"


def _part(token, parts: int) -> F.Column:
    return F.pmod(F.xxhash64(token), F.lit(parts)).cast("int")


def token_postings(docs: DataFrame, text_col: str = "name", score_col: str = "score", id_col: str = "id",
                   parts: int = POSTING_PARTS) -> DataFrame:
    """(token, id, score, part): each document once for each of its lower-cased tokens."""
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(c(text_col)), F.lit(_TOKEN), F.lit(0)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(score_col).alias("score"), F.explode(tokens).alias("token"))
    return rows.withColumn("part", _part("token", parts))


def write_postings(postings: DataFrame, path: str) -> None:
    """The postings as a table partitioned by token hash, sorted by token inside."""
    (postings.repartition("part", F.pmod(F.xxhash64("id"), F.lit(POSTING_FILES))).sortWithinPartitions("part", "token")
     .write.partitionBy("part").parquet(path))


def postings_search(postings: DataFrame, query: str, limit: int = 10, parts: int = POSTING_PARTS) -> DataFrame:
    """S9 over a postings table: (id, score) of the documents that hold any query word,
    ascending by score, top ``limit``.  The query's partitions are constants, so the scan
    reads no others, and the token filter is pushed to the files."""
    terms = _terms(query)
    if not terms:
        return postings.where(F.lit(False)).select("id", "score")
    wanted = F.lit(False)
    for t in terms:
        wanted = wanted | ((F.col("part") == _part(F.lit(t), parts)) & (F.col("token") == t))
    hits = postings.where(wanted).groupBy("id").agg(F.min("score").alias("score"))
    return hits.orderBy(F.col("score").asc_nulls_last(), F.col("id").asc()).limit(limit)


def nested_match(array_col, field: str, query: str) -> F.Column:
    """S10 on a nested array column: any element's ``field`` matches."""
    return F.exists(c(array_col), lambda e: matches_any_term(e[field], query))


def nested_match_search(turns: DataFrame, query: str, parent: str = "conv_id",
                        text_col: str = "text") -> DataFrame:
    """S10 over the flat (one row per nested element) form: parents with at
    least one matching element.  Counting per element and then aggregating
    per parent never gathers a parent's elements into one row."""
    m = turns.select(parent, matches_any_term(text_col, query).cast("int").alias("_m"))
    agg = m.groupBy(parent).agg(F.count(F.lit(1)).alias("n_turns"), F.sum("_m").alias("n_matching"))
    return agg.where(F.col("n_matching") > 0)
