"""Main text of HTML pages by two-pass block rules.

A page is cut into blocks at block-level tags. First pass: a block that is
structurally not content (menu, footer, sidebar, advert, notice, comment section),
mostly link text, or marked by a copyright sign is boilerplate; a long block dense
in stop words is content; a long block without them is boilerplate outside an
article and undecided inside one, but content where no block of the page has them
(another language); short blocks are undecided. Class and id names and forms are
evidence only: a name counts by its head word ("related-work" is work) and not
after a negation ("no-sidebar"), and an element that holds most of the page's text
outside links, with no article beside it, is not boilerplate for its name. Second
pass: an undecided block takes the label of the nearest decided block of its own
section, else of the page (nearest in blocks; a tie goes to content inside an
article, to the block that follows for a heading, else to boilerplate); with no decided block there, undecided
blocks are content.

Character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined by an empty line in page order.

Defined cases: null or empty html gives the empty string; markup cut off at the
end is dropped; unclosed elements end with their parent; repeated pages give
equal rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# fixed values: frequent function words of four languages
STOP_WORDS = frozenset((
    "the of and a to in is that it was for on are as with he be at from this have or by one had not but what all were "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er hat aus bei sie nach "
    "le la les et un une du en est que qui dans pour pas sur au par il ne ce sont avec plus se son cette "
    "el los las y una del por con para no se su al lo como más pero sus"
).split())

DROPPED = ("script", "style", "noscript", "template", "textarea", "select", "button", "svg", "iframe", "object", "title", "head")
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
).split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE_TAGS = frozenset("nav footer aside menu dialog".split())
FORM_TAGS = frozenset(("form", "fieldset"))
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
# parts of class and id names
BOILERPLATE_NAMES = frozenset((
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup "
    "modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus respond replies sidebar side menu nav navbar "
    "navigation breadcrumb breadcrumbs footer share sharing social related recommended widget toolbar pagination pager copyright disclaimer legal"
).split())
HEADER_NAMES = frozenset("header masthead topbar".split())
COMMENT_NAMES = frozenset("comment comments commentlist disqus respond replies".split())
NEGATIONS = frozenset("no not non has with without is if hide toggle".split())
# words behind the head word of a name
TAIL_WORDS = frozenset("left right top bottom inner outer wrapper wrap container box section area list block holder content item items bar main primary secondary posts articles links stories".split())
SECTIONS = BOILERPLATE_TAGS | FORM_TAGS | {"article", "main", "section", "header", "body"}
ARTICLE = frozenset(("article", "main"))

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<drop>" + "|".join(x for x in DROPPED if x != "head") + r")\b(?=[\s/>])[^>]*?(?:(?<=/)>|>.*?(?:</(?P=drop)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[/a-zA-Z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
NAME_PARTS = re.compile(r"[a-z]+")
WORD = re.compile(r"[^\W\d_]+")

CONTENT, UNDECIDED, BOILERPLATE = 1, 0, -1
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
HARD, SOFT, COMMENTS = 3, 1, 2      # boilerplate whatever it holds; unless it holds most text; or nearly all
MOST = {SOFT: 0.5, COMMENTS: 0.9}


def _named(value: str, in_article: bool) -> int:
    """What a class or id value says: SOFT, COMMENTS or 0. Of each name the head
    word counts (the last one but for words of place), unless it is negated."""
    worst = 0
    for name in value.split():
        words = NAME_PARTS.findall(name)
        while len(words) > 1 and words[-1] in TAIL_WORDS:
            words.pop()
        if not words or NEGATIONS & set(words[:-1]):
            continue
        if words[-1] in COMMENT_NAMES:
            worst = max(worst, COMMENTS)
        elif words[-1] in BOILERPLATE_NAMES or (not in_article and words[-1] in HEADER_NAMES):
            worst = max(worst, SOFT)
    return worst


def _boilerplate(tag: str, attributes: str, in_article: bool) -> int:
    """HARD, SOFT, COMMENTS or 0 for an element."""
    if tag in BOILERPLATE_TAGS or (tag == "header" and not in_article):
        return HARD
    worst = SOFT if tag in FORM_TAGS else 0
    if not attributes or tag in ("html", "body", "article", "main"):
        return worst
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            if value in BOILERPLATE_ROLES:
                return HARD if value != "form" else max(worst, SOFT)
        else:
            worst = max(worst, _named(value, in_article))
    return HARD if HIDDEN.search(attributes) else worst


def _settle(found: list[tuple[str, int, bool, int, bool, int, bool]], marked: list[tuple[int, int]]) -> list[tuple[str, int, bool, bool, int, bool]]:
    """Blocks with the verdict on the elements they are in. ``marked``: (parent,
    kind) of every element that is boilerplate by evidence, parents first."""
    size, articles = [0] * len(marked), [0] * len(marked)
    for text, linked, hard, mark, article, *_ in found:
        if not hard:
            size[mark] += max(len(text) - text.count(" ") - linked, 0)
            articles[mark] += article
    for i in range(len(marked) - 1, 0, -1):
        size[marked[i][0]] += size[i]
        articles[marked[i][0]] += articles[i]
    junk = [False] * len(marked)
    for i in range(1, len(marked)):
        parent, kind = marked[i]
        holds_most = size[i] >= MOST[kind] * size[0] and articles[i] == articles[0]
        junk[i] = junk[parent] or not holds_most
    return [(text, linked, hard or junk[mark], *rest) for text, linked, hard, mark, *rest in found]


def blocks(html: str) -> list[tuple[str, int, bool, bool, int, bool]]:
    """(text, characters in links, structurally boilerplate, in an article, section, heading) in page order."""
    out: list[tuple[str, int, bool, int, bool, int, bool]] = []
    stack: list[tuple[str, bool, int, bool, int]] = [("", False, 0, False, 0)]  # tag, boilerplate, mark, article, section
    marked: list[tuple[int, int]] = [(0, 0)]
    open_tags: Counter[str] = Counter()
    parts: list[str] = []
    linked, links, sections, at = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append((text, linked, *stack[-1][1:], any(open_tags[h] for h in HEADINGS)))
        parts.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            raw = unescape(raw)
            parts.append(raw)
            if links:
                linked += len("".join(raw.split()))

    for m in TOKEN.finditer(html):
        say(html[at: m.start()])
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag == "br":
            parts.append(" ")
            continue
        block = tag in BLOCKS
        if block:
            flush()
        if m["end"]:
            if open_tags[tag]:
                while True:
                    last = stack.pop()[0]
                    open_tags[last] -= 1
                    links -= last == "a"
                    if last == tag:
                        break
        elif tag not in VOID:
            if block and stack[-1][0] != "":  # an open paragraph, and what is open in it, ends here
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p" or (stack[i][0] == tag and tag in ("li", "dt", "dd", "td", "th", "tr")):
                        links -= sum(x[0] == "a" for x in stack[i:])
                        open_tags.subtract(x[0] for x in stack[i:])
                        del stack[i:]
                        break
                    if stack[i][0] in BLOCKS:
                        break
            if m["attributes"].endswith("/"):
                continue
            _, junk, mark, article, section = stack[-1]
            own = _boilerplate(tag, m["attributes"], article)
            if tag in SECTIONS or own:
                sections += 1
                section = sections
            if own in MOST:
                marked.append((mark, own))
                mark = len(marked) - 1
            links += tag == "a"
            open_tags[tag] += 1
            stack.append((tag, junk or own == HARD, mark, (article or tag in ARTICLE) and own != HARD, section))
    say(html[at:])
    flush()
    return _settle(out, marked)


def classify(found: list[tuple[str, int, bool, bool, int, bool]], short: int = 70, max_links: float = 0.3, min_stops: float = 0.1) -> list[int]:
    """Both passes: CONTENT or BOILERPLATE for every block."""
    first, without = [], []
    for i, (text, linked, junk, article, *_) in enumerate(found):
        size = len(text) - text.count(" ")
        if junk or linked > max_links * size or (text.startswith("©") or (not article and "©" in text)):
            first.append(BOILERPLATE)
        elif len(text) < short:
            first.append(UNDECIDED)
        else:
            words = WORD.findall(text.lower())
            stops = sum(w in STOP_WORDS for w in words)
            if stops >= min_stops * max(len(words), 1):
                first.append(CONTENT)
            else:
                first.append(UNDECIDED)
                without.append(i)
    if CONTENT not in first:     # no stop words of the four languages anywhere: length and links alone decide
        for i in without:
            first[i] = CONTENT
    else:
        for i in without:
            first[i] = UNDECIDED if found[i][3] else BOILERPLATE
    by_section: dict[int, list[int]] = {}
    for i, block in enumerate(found):
        by_section.setdefault(block[4], []).append(i)
    article, heading = [block[3] for block in found], [block[5] for block in found]
    labels = list(first)
    for members in by_section.values():
        _inherit(members, first, article, heading, labels)
    everywhere = list(first)
    _inherit(range(len(found)), first, article, heading, everywhere)
    return [x or (CONTENT if article[i] else everywhere[i] or CONTENT) for i, x in enumerate(labels)]


def _inherit(members, first: list[int], article: list[bool], heading: list[bool], labels: list[int]) -> None:
    """Give each undecided block of ``members`` the label of the nearest decided one
    (a tie goes to content inside an article, to what follows for a heading, else to
    boilerplate), in two sweeps."""
    before, last = [], None
    for at, i in enumerate(members):
        if first[i]:
            last = (at, first[i])
        before.append(last)
    after = None
    for at in range(len(members) - 1, -1, -1):
        i = members[at]
        if first[i]:
            after = (at, first[i])
        elif before[at] and after and before[at][1] != after[1] and at - before[at][0] == after[0] - at:
            labels[i] = CONTENT if article[i] else after[1] if heading[i] else BOILERPLATE
        elif before[at] and (not after or at - before[at][0] <= after[0] - at):
            labels[i] = before[at][1]
        elif after:
            labels[i] = after[1]


def main_text(html: str | None) -> str:
    found = blocks(html or "")
    return "\n\n".join(b[0] for b, label in zip(found, classify(found)) if label == CONTENT)


def extract(pages: DataFrame, id_columns: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Per row of ``pages`` (``id_columns``, html): the id columns, text, n_chars."""
    fields = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in id_columns)
    k = len(id_columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [main_text(v.as_py()) for v in batch.column(k)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(k)] + [pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())],
                                             [*id_columns, "text", "n_chars"])

    return pages.select(*id_columns, "html").mapInArrow(run, f"{fields}, text string, n_chars long")
