"""Main-text extraction by consensus host paths.

Every page scores its containers by the text they hold outside boilerplate and
links, under a generalised path of tags and classes (digits dropped).  Spark
counts the pages' first choices per host, and each page is extracted again along
the path that its host agrees on; a page on which that path holds no text uses
its own first choice, or all of its body.

Defined results: null or empty html gives the empty text; a null url, or one
without a host, belongs to the host ''; unclosed and stray tags are read as
browsers do in the common cases (a block closes an open paragraph, a stray end tag
is ignored, the end of the page closes everything); equal votes go to the first
path in order; repeated rows vote and are extracted alike; an empty table gives an
empty result; columns other than page_id, url and html are never read.

Scale: two scans of the pages.  The votes are counted map-side, so a hot host is a
few rows per task.  The winners are a saved table of one row per host; Spark
broadcasts it only when it is small, else it joins by host and splits hot hosts.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import saved
from tideline.llm.ship import ship

# Vocabulary of markup: fixed values of HTML and of common class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object annotation annotation-xml".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul""".split())
CONTAINER = frozenset("article body div main section td".split())
KEEP_OPEN = frozenset(BLOCK | {"td", "th", "button", "select", "label"})
NOISE_TAG = frozenset("nav footer aside form button select menu dialog head label".split())
NOISE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
NOISE_CLASS = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies
consent gdpr notice notices alert newsletter subscribe subscription signup sidebar sidebars aside menu menus nav navbar navigation
breadcrumb breadcrumbs footer header masthead comment comments disqus replies respond social share sharing related recommended
popup modal overlay widget widgets toolbar pagination pager""".split())
ALWAYS_NOISE = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo comments disqus replies respond".split())
#: Words that say where or how, not what: beside them a word of NOISE_CLASS names boilerplate
#: (``share-buttons``), beside any other it may name a subject (``share-price-analysis``).
PLACE_CLASS = frozenset("""a the site page main global top bottom left right upper lower side inner outer primary secondary first last
small large mobile desktop sticky fixed header footer content post posts article articles story stories entry entries blog news user reader
readers box block area bar list item items row col column columns cell wrap wrapper container holder section panel pane group slot unit
region zone module component element body button buttons link links icon icons text title heading form field input img image images thumb
js is has no on in by id ui md sm lg xs xl bg count more read toggle open close active hidden show hide container""".split())
MAIN_CLASS = frozenset("article body content entry main post story text".split())
SELF_CLOSING = {"p": BLOCK, "li": {"li"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)>|<[/!?a-zA-Z][^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


class _Open:
    __slots__ = ("tag", "noise", "path")

    def __init__(self, tag, noise, path):
        self.tag, self.noise, self.path = tag, noise, path


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTR.finditer(raw)} if raw else {}


def _is_noise(tag: str, attrs: dict[str, str], inside_main: bool) -> bool:
    if tag in ("html", "body"):
        return False
    if tag in NOISE_TAG or attrs.get("role") in NOISE_ROLE or (tag == "header" and not inside_main):
        return True
    names = [frozenset(_NAME.findall(c)) for c in f"{attrs.get('class', '')} {attrs.get('id', '')}".split()]
    whole = [parts for parts in names if parts & NOISE_CLASS and parts <= NOISE_CLASS | PLACE_CLASS]
    if tag in ("article", "main"):  # only one that is nothing else
        return any(parts & (ALWAYS_NOISE | {"comment"}) for parts in whole)
    return any(parts & ALWAYS_NOISE for parts in names) or bool(whole) and not any(parts & MAIN_CLASS for parts in names)


def blocks(html: str) -> list[tuple[str, int, tuple[str, ...]]]:
    """(text, characters in links, paths of the open containers) of each block of the
    page outside boilerplate, in page order.  Where boilerplate by name is all there is,
    only navigation, footers and scripts are left out."""
    return _blocks(html, _is_noise) or _blocks(html, lambda tag, attrs, inside_main: tag in ("nav", "footer", "head"))


def _blocks(html: str, is_noise) -> list[tuple[str, int, tuple[str, ...]]]:
    out, stack, words = [], [], []
    noise = linked = 0
    link = False
    at, n = 0, len(html)

    def flush():
        nonlocal linked, link
        if words:
            text = " ".join(entities.unescape("".join(words)).split())
            if text:
                out.append((text, linked, tuple(o.path for o in stack if o.path)))
            words.clear()
        linked, link = 0, False

    def close(count):
        nonlocal noise
        for o in stack[count:]:
            noise -= o.noise
        del stack[count:]

    while at < n:
        m = _TAG.search(html, at)
        text = html[at:m.start()] if m else html[at:]
        if text and not noise:
            words.append(text)
            if link:
                linked += len(text)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:  # an end tag
            if tag == "a":
                link = False
            elif tag in KEEP_OPEN:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == tag:
                        flush()
                        close(k)
                        break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if tag == "a":
            link = True
            continue
        if tag == "br" or tag in ("td", "th") and not noise:
            words.append(" ")
        if tag not in KEEP_OPEN or tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in BLOCK:
            flush()
        for k in range(len(stack) - 1, -1, -1):
            if tag in SELF_CLOSING.get(stack[k].tag, ()):
                close(k)
                break
            if stack[k].tag in CONTAINER or stack[k].tag in ("table", "ul", "ol", "dl"):
                break
        attrs = _attributes(m[3])
        bad = is_noise(tag, attrs, any(o.tag in ("article", "main") for o in stack))
        if bad:
            flush()
        path = None
        if tag in CONTAINER:
            above = next((o.path for o in reversed(stack) if o.path), "")
            step = ".".join([tag, *sorted(_DIGITS.sub("", c) for c in attrs.get("class", "").split())])
            path = f"{above}/{step}"
        stack.append(_Open(tag, int(bad), path))
        noise += bad
    flush()
    return out


def _weight(path: str) -> float:
    step = path.rsplit("/", 1)[1]
    tag, *classes = step.split(".")
    base = 1.5 if tag in ("article", "main") else 0.6 if tag == "body" else \
        1.3 if MAIN_CLASS & set(_NAME.findall(" ".join(classes))) else 1.0
    return base * (1 + 0.01 * path.count("/"))


def first_choice(found) -> tuple[str, float]:
    """The page's best path and its score."""
    held: dict[str, int] = {}
    for text, linked, paths in found:
        for p in set(paths):
            held[p] = held.get(p, 0) + max(0, len(text) - linked)
    score, path = min(((-c * _weight(p), p) for p, c in held.items() if c), default=(0.0, ""))
    return path, -score


def main_text(found, path: str | None) -> tuple[str, str]:
    """(text, the path that gave it)"""
    for p in (path, first_choice(found)[0]):
        kept = [text for text, _, paths in found if p and p in paths]
        if kept:
            return "\n\n".join(kept), p
    return "\n\n".join(text for text, _, _ in found), ""


def _votes(batches):
    for batch in batches:
        got = [first_choice(blocks(h or ""))[0] for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(got, pa.string())], names=["host", "path"])


def _extract(batches):
    for batch in batches:
        got = [main_text(blocks(h or ""), p) for h, p in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array([t for t, _ in got], pa.string()),
             pa.array([len(t) for t, _ in got], pa.int64()), pa.array([p for _, p in got], pa.string())],
            names=["page_id", "url", "text", "n_chars", "path"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, pages): the path that most pages of a host chose first."""
    votes = pages.select("host", "html").mapInArrow(_votes, "host string, path string") \
        .filter("path <> ''").groupBy("host", "path").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("path").alias("p")))
    return votes.groupBy("host").agg(best.alias("best")).select("host", F.col("best.p").alias("path"), (-F.col("best.less")).alias("pages"))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, path."""
    ship(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    winners = saved(host_paths(rows).select("host", "path"))
    return rows.join(winners, "host", "left").select("page_id", "url", "html", "path") \
        .mapInArrow(_extract, "page_id long, url string, text string, n_chars long, path string")
