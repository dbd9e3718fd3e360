"""Main text of web pages by maximum-scoring subsequence.

A page is read as a row of tags and stretches of words.  Words score positive
and tags negative, with weights from labelled pages: the log odds that a word
of its kind (the block it stands in, in a link or not) or a tag of its name
lies in the content.  One linear scan finds the contiguous region with the
highest sum.  Inside the region, elements that are never main text (menus,
forms, scripts, adverts, comments and so on) are left out.

A page's own mark around its content is a label too: no kind of word or tag
counts against the content there, and a region that ends inside marked content
is drawn out to its ends.  Where the page marks nothing the learnt weights
alone decide, and a tag that no labelled page has in its content is unknown
there, not proof against it.

Labelled pages are those that mark their content themselves (``article``,
``main`` or ``itemprop=articleBody``); a bounded sample of them is enough,
since only a weight per HTML element name is learnt.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names and words used in class, id and role values.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
             "strong sub sup time tt u var wbr".split())
RAW = "script style noscript template textarea title xmp iframe noembed noframes svg math".split()
NEVER = set("aside button canvas dialog footer form head menu nav object select".split())
CONTENT = ("article", "main")
HEADER = {"header", "masthead"}
COMMENT_WORDS = set("comment comments commentlist disqus discussion replies reply respond".split())
NEVER_WORDS = set("ad ads adv advert advertisement advertising advertorial adsense alert aside banner breadcrumb breadcrumbs complementary "
                  "consent contentinfo cookie cookies copyright dialog footer gdpr hidden login menu modal nav navbar navigation "
                  "newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related search share "
                  "sharebar sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar widget".split())
# Words beside those in a hyphenated name ("related-links", "visually-hidden"), and words that tell a state ("has-sidebar").
PART_WORDS = set("area bar bars block body bottom box boxes btn button buttons card cards container content group header heading "
                 "icon icons inner is item items left link links list main module outer page pane panel post posts primary right row "
                 "screen section secondary site slot strip text thread title top u unit visually wrap wrapper".split())
STATE_WORDS = set("closed disabled enabled has no not open overflow with without".split())
# Ids of these are mostly slugs of the text: they tell nothing, a section's only if it is one of comments.
SLUGGED = INLINE | set("blockquote caption dd dt figcaption figure h1 h2 h3 h4 h5 h6 li p pre section td th".split())
COMMENT_IDS = COMMENT_WORDS - {"comment", "discussion", "reply"}
TITLE_WORDS = set("article content entry post story".split())
KNOWN = VOID | INLINE | NEVER | set(RAW) | set(CONTENT) | set(
    "address blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup html "
    "legend li ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())

_RAW = "|".join(RAW)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>(?:.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?a-z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)", re.I | re.S)
_ATTR = re.compile(r"""([^\s/>="'][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
_WORDS = re.compile(r"[a-z]+")
SAMPLE_PAGES = 1000
# Scores where no labelled page has the kind: a word, a word in a link, a tag, a left-out element.
DEFAULT = {"word": 0.5, "link": -1.0, "tag": -0.05, "gap": -1.0}
# Lowest weight of a tag that no labelled page has in its content.
UNSEEN = -0.25
# What a content mark says: a main element may hold more than the article in it.
MAIN, ARTICLE = 1, 2


class Gap:
    """An element that is left out.  ``sure``: by its name, or as a form or
    comments that come after content; otherwise a content mark inside it shows
    that it is a wrapper.  ``kind`` is "form", "comments" or ""."""

    def __init__(self, sure: bool, kind: str = ""):
        self.sure, self.kind, self.on = sure, kind, True


def attributes(attrs: str) -> dict[str, str]:
    """Names and values in lower case, "" for a name without a value.  The
    first of a repeated name counts, as in browsers."""
    values: dict[str, str] = {}
    for name, *value in _ATTR.findall(attrs):
        values.setdefault(name.lower(), html.unescape("".join(value)).lower())
    return values


def names(marks: list[str], words: set[str], whole: bool) -> bool:
    """Whether a class, id or role token is one of ``words`` or, hyphenated,
    has one in it.  Its other words must be such words or ``PART_WORDS`` too if
    ``whole``, or beside "hidden"."""
    for mark in marks:
        parts = set(_WORDS.findall(mark))
        found = parts & words
        if found and not parts & STATE_WORDS and (parts - found <= PART_WORDS or not whole and found != {"hidden"}):
            return True
    return False


def gap_of(name: str, attrs: str, in_content: bool, found: bool = False, story: bool = False) -> Gap | None:
    """``found``: marked content with text came before; ``story``: that, or a
    paragraph below a headline."""
    if name == "form":
        return Gap(found, "form")
    if name in NEVER:
        return Gap(True)
    if name == "header" and not in_content:
        return Gap(False)
    if not attrs or name in ("html", "body"):
        return None
    values = attributes(attrs)
    marks = [t for k in ("class", "role") for t in values.get(k, "").split()]
    section = name == "section" or "section" in marks
    slug = values.get("id", "").strip()
    if slug and (name not in SLUGGED or name == "section" and slug in COMMENT_IDS):
        marks.append(slug)
    # a section of the content may be its discussion, an article an opinion piece
    lone = {"comment", "discussion"} if section else {"comment", "discussion"} & {slug} if in_content else set()
    if names([t for t in marks if t not in lone], COMMENT_WORDS, in_content):
        if name not in CONTENT and name != "h1":
            return Gap(story, "comments")
        if story:
            return Gap(True, "comments")
    if name in CONTENT or name == "h1":
        return None
    if "hidden" in values or values.get("aria-hidden") == "true" or names(marks, NEVER_WORDS, in_content):
        return Gap(False)
    words = set(_WORDS.findall(" ".join(marks)))
    return Gap(False) if words & HEADER and not in_content and not words & TITLE_WORDS else None


def tokens(page: str) -> Iterator[tuple]:
    """("tag", name, level, gaps) and ("text", kind, level, gaps, text, block
    number) in page order.  The level is ``ARTICLE``, ``MAIN`` or 0, outside of
    marked content.  Unclosed and stray tags are allowed."""
    stack: list[tuple[str, Gap | None, int]] = []
    gaps: tuple[Gap, ...] = ()
    block = links = 0                         # block number, open links
    depth = [0, 0, 0]                         # open elements without a mark, main elements, articles
    found = story = headed = False            # text of marked content, of any content, a headline

    def pop(to: int) -> None:
        nonlocal gaps, links
        while len(stack) > to:
            name, gap, mark = stack.pop()
            gaps = gaps[:-1] if gap else gaps
            depth[mark] -= 1
            links -= name == "a"

    def level() -> int:
        return ARTICLE if depth[ARTICLE] else MAIN if depth[MAIN] else 0

    for m in _TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            kind = next((n for n, _, _ in reversed(stack) if n not in INLINE), "body")
            yield "text", (kind if kind in KNOWN else "other") + ("+a" if links > 0 else ""), level(), gaps, text, block
            continue
        if m["raw"]:
            block += m["raw"].lower() not in INLINE
            continue
        if m["name"] is None:
            continue
        name = m["name"].lower()
        block += name not in INLINE
        if m["close"]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                pop(at)
        elif name not in VOID:
            attrs = m["attrs"] or ""
            if name not in INLINE:             # a block ends an open paragraph
                at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), None)
                if at is not None and (stack[at][0] == "p" or stack[at][0] == name == "li"):
                    pop(at)
            if name == "a" and links > 0:
                at = max(i for i in range(len(stack)) if stack[i][0] == "a")
                pop(at)
            attrs = m["attrs"] or ""
            mark = ARTICLE if name == "article" or "articlebody" in attrs.lower() else MAIN if name == "main" else 0
            gap = gap_of(name, attrs, level() > 0, found, story)
            if mark or name == "h1":
                # an article of a comment does not show that comments wrap content
                said = name != "main" and names(attributes(attrs).get("class", "").split(), COMMENT_WORDS, False)
                for g in gaps:
                    g.on = g.on and (g.sure or said and g.kind == "comments")
            stack.append((name, gap, mark))
            gaps = (*gaps, gap) if gap else gaps
            depth[mark] += 1
            links += name == "a"
            if (mark or name in ("h1", "p")) and not any(g.on for g in gaps):
                headed |= name == "h1"
                found |= mark > 0 and name != "main" or name == "p" and level() > 0
                story |= found or name == "p" and headed and not any(n in ("header", "hgroup") for n, _, _ in stack)
        yield "tag", name if name in KNOWN else "other", level(), gaps


def page_tokens(page: str) -> list[tuple]:
    """All tokens.  A form that opens before any marked content and holds most
    words of the page is its wrapper."""
    row = list(tokens(page))
    forms, outside = Counter(), 0
    for t in row:
        on = [g for g in t[3] if g.on] if t[0] == "text" else []
        if t[0] == "text" and all(g.kind == "form" and not g.sure for g in on):
            n = len(t[4].split())
            outside += 0 if on else n
            forms.update({g: n for g in on})
    for form, n in forms.items():
        form.on = n <= outside
    return row


def kind_counts(page: str) -> Counter:
    """(kind, in content) counts over a labelled page; empty for other pages."""
    found, marked = Counter(), False
    for t in page_tokens(page):
        if any(g.on for g in t[3]):
            continue
        inside = t[2] > 0
        marked |= inside
        if t[0] == "tag":
            found[f"<{t[1]}>", inside] += 1
        else:
            found[t[1], inside] += len(t[4].split())
    return found if marked else Counter()


def learn(pages: DataFrame, html_column: str = "html", sample: int = SAMPLE_PAGES, seed: int = 3) -> dict[str, float]:
    """Weight of each kind, from about ``sample`` of the pages that mark their
    content (a seeded draw).  At most a few hundred kinds exist."""
    marked = pages.filter(F.lower(html_column).rlike(r"<(article|main)[\s>]|articlebody")).select(F.col(html_column).alias("html"))
    n = marked.count()
    if n == 0:
        return {}
    share = F.lit(min(1.0, sample / n) * 2.0 - 1.0)
    drawn = marked.filter(F.xxhash64(F.lit(seed), "html").cast("double") / F.lit(2.0 ** 63) <= share).limit(2 * sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                total.update(kind_counts(page))
        yield pa.RecordBatch.from_pylist([{"kind": k, "inside": i, "n": v} for (k, i), v in total.items()],
                                         pa.schema([("kind", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())]))

    sums = (drawn.mapInArrow(count, "kind string, inside boolean, n long").groupBy("kind")
            .agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("i"),
                 F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("o")).collect())
    odds = {r["kind"]: max(-3.0 if r["i"] or r["kind"][0] != "<" else UNSEEN, min(3.0, math.log((r["i"] + 1) / (r["o"] + 1)))) for r in sums}
    # tags never score positive, and a plain word's weight stays above a tag's
    return {k: min(v, DEFAULT["tag"] / 4) if k[0] == "<" else v for k, v in odds.items()}


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run with the highest positive sum, the
    longest of equals; (0, 0) without any."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += s
        if total > best or total == best > 0 and i + 1 - start > at[1] - at[0]:
            best, at = total, (start, i + 1)
    return at


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The page's main text: blocks in page order joined by one space.

    Articles with words are the marked content; without any, main elements are.
    In it a word scores no less than an unknown one and a tag no less than an
    unknown tag.  All of an article that the best region reaches is kept, but
    for left-out elements."""
    if not page:
        return ""
    row, scores, open_gaps = page_tokens(page), [], set()
    marked = max((t[2] for t in row if t[0] == "text" and t[4].strip() and not any(g.on for g in t[3])), default=0) or MAIN
    for t in row:
        on = [g for g in t[3] if g.on]
        if on:
            scores.append(DEFAULT["gap"] if id(on[0]) not in open_gaps else 0.0)
            open_gaps.add(id(on[0]))
        elif t[0] == "tag":
            w = weights.get(f"<{t[1]}>", DEFAULT["tag"])
            scores.append(max(w, DEFAULT["tag"]) if t[2] >= marked else w)
        else:
            w = weights.get(t[1], DEFAULT["link"] if t[1].endswith("+a") else DEFAULT["word"])
            scores.append((max(w, DEFAULT["word"]) if t[2] >= marked else w) * len(t[4].split()))
    start, end = best_region(scores)
    while start < end < len(row) and row[end - 1][2] >= marked and row[end][2] >= marked:
        end += 1
    while 0 < start < end and row[start][2] >= marked and row[start - 1][2] >= marked:
        start -= 1
    blocks: dict[int, list[str]] = {}
    for t in row[start:end]:
        if t[0] == "text" and not any(g.on for g in t[3]):
            blocks.setdefault(t[5], []).append(t[4])
    parts = (" ".join(html.unescape("".join(b)).split()) for b in blocks.values())
    return " ".join(p for p in parts if p)


def extract(pages: DataFrame, weights: dict[str, float], html_column: str = "html", carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``carry`` columns of every row with ``text`` and ``n_chars`` (its
    code points).  A null or empty page, or one without content, has an empty
    text.  Rows are independent; other columns are not read."""
    rows = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)], F.col(html_column).alias("html"))
    kept = [f"c{i}" for i in range(len(carry))]
    schema = ", ".join([f"{c} {t}" for c, t in rows.dtypes if c != "html"] + ["text string", "n_chars long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(p, weights) for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], [*kept, "text", "n_chars"])

    return rows.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "text", "n_chars")
