"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page becomes a row of tokens: its words and its tags. Words score positive, tags negative, and the best contiguous
region is found in one linear scan; of equal regions the longest, then the first, is taken. Text blocks touched by the
region belong to the article. Weights come from labelled pages: pages whose markup has exactly one <article> or <main>
label their own tokens as inside or outside, and a token kind weighs by its smoothed share inside (words) or outside
(tags); kinds that no label shows keep their prior. Elements that never hold article text (scripts, menus, footers,
sidebars, forms, and elements whose class, id or role names a menu, notice, advert, comment section and the like)
count as tags as a whole and are never part of the text, even inside the region.

Character references are decoded, white space inside a block becomes one space, blocks are joined by one space.
A null page and one without article words give an empty text. Unclosed and stray tags are tolerated. Repeated rows
are extracted each; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, table

#: Labelled pages that the weights are fitted on: those with the smallest hash of their markup.
LABELLED_PAGES = 2000
TAG_SCALE, LINK_WORD, SKIPPED_WORD = 8.0, 0.02, -0.5

# Element names of HTML, by what they mean here.
RAW = frozenset("script style textarea title xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("script style head title noscript template nav footer aside form menu iframe object svg math canvas select button textarea input dialog audio video map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
BODY = frozenset("article main".split())
CONTENT = frozenset("p br h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption hr".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
#: Words of class and id names that mark what is no article text.
SKIP_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "submenu breadcrumb breadcrumbs pagination pager sidebar aside footer masthead header topbar toolbar cookie cookies "
    "consent notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations comment comments discussion replies disqus respond widget skip hidden copyright legal".split()
)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
SPACE = re.compile(r"\s+")


def _skips(tag: str, attributes: str, inside_body: bool) -> bool:
    if tag in SKIP or (tag == "header" and not inside_body):
        return True
    if tag in BODY or tag in ("body", "html") or not attributes:
        return tag in BODY and "comment" in attributes.lower()
    for name, value in NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in SKIP_ROLES):
            return True
        if name in ("class", "id") and not SKIP_NAMES.isdisjoint(re.split(r"[^a-z]+", value)):
            return True
    return False


def tokens(page: str) -> tuple[list[tuple[str, int, int]], list[str], list[bool]]:
    """(token runs (kind, count, block or -1), text of each block, whether the block lies in <article> or <main>).

    Runs are in page order; kinds are "word", "link word", "skipped word" and tag names, with / for end tags.
    """
    runs: list[tuple[str, int, int]] = []
    blocks: list[list[str]] = []
    inside: list[bool] = []
    stack: list[str] = []
    skip_from, links, bodies, fresh, at = -1, 0, 0, True, 0
    size = len(page)
    while at < size:
        found = TOKEN.match(page, at)
        at = found.end()
        tag = found.group(2)
        if tag is None:
            piece = found.group()
            if piece.startswith("<") and len(piece) > 1:
                continue  # comment, doctype or instruction
            text = html.unescape(piece)
            n = len(text.split())
            if skip_from >= 0:
                if n:
                    runs.append(("skipped word", n, -1))
                continue
            if fresh and not n:
                continue
            if fresh:
                blocks.append([])
                inside.append(bodies > 0)
                fresh = False
            blocks[-1].append(text)
            if n:
                runs.append(("link word" if links else "word", n, len(blocks) - 1))
            continue
        tag, closing = tag.lower(), bool(found.group(1))
        if tag not in INLINE:
            fresh = True
        if closing:
            if tag in stack:
                while stack:
                    gone = stack.pop()
                    links -= gone == "a"
                    bodies -= gone in BODY
                    if skip_from >= len(stack):
                        skip_from = -1
                    if gone == tag:
                        break
            if skip_from < 0:
                runs.append((f"/{tag}", 1, -1))
            continue
        if tag in BODY and skip_from >= 0 and "comment" not in found.group(3).lower() and stack[skip_from] not in ("head", "template", "noscript", "#comments"):
            while len(stack) > skip_from:  # an article ends a menu or notice that nobody closed
                links -= stack.pop() == "a"
            skip_from = -1
        skips = skip_from < 0 and _skips(tag, found.group(3), bodies > 0)
        if tag == "body" and skip_from >= 0:
            skip_from = -1
        if skip_from < 0 and not skips:
            runs.append((tag, 1, -1))
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in VOID or found.group(3).endswith("/") and tag not in BODY:
            continue
        if skips:
            skip_from = len(stack)
        stack.append(tag)
        links += tag == "a"
        bodies += tag in BODY
    return runs, [SPACE.sub(" ", "".join(b)).strip() for b in blocks], inside


def prior(kind: str) -> float:
    """Weight of a token kind that no label shows."""
    if kind in ("word", "link word", "skipped word"):
        return {"word": 1.0, "link word": LINK_WORD, "skipped word": SKIPPED_WORD}[kind]
    tag = kind.lstrip("/")
    return -0.05 if tag in INLINE or tag in CONTENT else -0.5 if tag in ("div", "section", "center", "header") else -TAG_SCALE


def fit(labelled: DataFrame) -> dict[str, float]:
    """Weights by token kind from pages that label themselves; counts are summed by Spark, one row per kind."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                depth = 0
                for kind, n, _ in tokens(page)[0]:
                    tag = kind.lstrip("/")
                    if tag in BODY:
                        depth += -1 if kind[0] == "/" else 1
                        seen[kind, False] += n
                    else:
                        seen[kind, depth > 0] += n
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen]), pa.array([i for _, i in seen]), pa.array(seen.values(), pa.int64())], names=["kind", "inside", "n"])

    rows = labelled.mapInArrow(count, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()
    counts = {(r.kind, r.inside): r.n for r in rows}
    weights = {}
    for kind in {k for k, _ in counts}:
        a, b = counts.get((kind, True), 0) + 1, counts.get((kind, False), 0) + 1
        if kind == "word":
            weights[kind] = max(0.5, a / (a + b))
        elif kind not in ("link word", "skipped word") and kind.lstrip("/") not in ("div", "section"):
            weights[kind] = -max(0.01, min(TAG_SCALE * b / (a + b), -prior(kind)))
    return weights


def article(page: str | None, weights: dict[str, float]) -> str:
    """The blocks that the best region touches, in page order."""
    if not page:
        return ""
    runs, blocks, _ = tokens(page)
    best, span, score, start, words, most = 0.0, None, 0.0, 0, 0, 0
    for i, (kind, n, _) in enumerate(runs):
        if score < 0 or not words:
            score, start, words = 0.0, i, 0
        score += n * weights.get(kind, prior(kind))
        words += n if kind in ("word", "link word") else 0
        if words and (score > best or (score == best and words > most)):
            best, most, span = score, words, (start, i)
    if span is None:
        return ""
    touched = sorted({b for _, _, b in runs[span[0] : span[1] + 1] if b >= 0})
    return " ".join(blocks[b] for b in touched if blocks[b])


def labelled_pages(pages: DataFrame, most: int = LABELLED_PAGES) -> DataFrame:
    """Pages with exactly one <article> or <main>; a bounded sample by the hash of the markup."""
    opened = F.regexp_count(F.lower("html"), F.lit(r"<(article|main)[\s>]"))
    labelled = pages.select(F.col("html").cast("string").alias("html")).where(opened == 1).withColumn("hash", F.xxhash64("html"))
    chosen = labelled.select("hash").distinct().orderBy("hash").limit(most)  # hashes alone are gathered
    return labelled.join(F.broadcast(chosen), "hash", "left_semi").select("html")


def extract(pages: DataFrame, most: int = LABELLED_PAGES) -> DataFrame:
    """page_id, url, text and its number of characters for every page."""
    weights = fit(labelled_pages(pages, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            texts = pa.array([article(x, weights) for x in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts, pc.utf8_length(texts).cast(pa.int64())], names=["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_best_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op2_best_region": op2_best_region}
ORACLES: dict[str, str] = {}
