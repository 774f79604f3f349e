"""Main text of web pages by line-block distribution.

Markup is stripped to one line per block; elements that are never main text
(scripts, menus, headers, footers, sidebars, notices, adverts, forms, reader
comments) leave a gap, and so does everything outside an ``article`` or
``main`` element if a page has one.  A line weighs its text outside links.
Text lengths are summed over windows of ``WINDOW`` lines.  The curve surges
where a window reaches ``SHARE`` of the page's greatest window; from a surge
the kept text reaches back to the last dive and on to the next, where a whole
window weighs nothing.

Null and empty pages give the empty text.  Unclosed elements end with their
parent or the page, a tag cut off at the end is dropped, and broken character
references stay as they are.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from broadsheet.llm.common import map_text

WINDOW = 3
SHARE = 0.25
RAW = "script style noscript template svg math iframe object canvas select textarea title".split()
SKIPPED = "nav footer aside form button menu dialog noscript label fieldset audio video".split()
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot "
    "th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class, id or role that mark what is not main text.
MARKED = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr "
    "masthead menu menubar modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion related replies "
    "respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets complementary "
    "contentinfo search alert advertorial paywall recommended".split()
)
HAVING = {"has", "with", "without", "no", "not", "is"}
COMMENTS = {"comment", "comments", "reply", "replies", "respond"}
MAIN = {"article", "main"}
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
DROP = re.compile(r"<(" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
PART = re.compile(r"[^a-z0-9]+")
CLOSES_P = BLOCKS - {"br"}


def _marked(element: str, attributes: str) -> bool:
    """Whether attributes mark an element as no main text; an article only as a comment."""
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name in ("class", "id", "role"):
            # "has-sidebar" and the like say what an element has, not what it is.
            for word in value.split():
                parts = PART.split(word)
                if parts[0] not in HAVING and not MARKED.isdisjoint(parts):
                    return element != "article" or parts[0] in COMMENTS
    return False


def _lines(page: str) -> list[tuple[str, int, bool] | None]:
    """(text, length outside links, in main element) of each block; None for a gap."""
    page = DROP.sub(" ", COMMENT.sub("", page))
    out: list[tuple[str, int, bool] | None] = []
    text, outside = [], 0
    skip, depth, link = "", 0, 0
    inner: Counter[str] = Counter()
    stack: list[str] = []
    main = 0

    def end() -> None:
        nonlocal text, outside
        line = " ".join(html.unescape("".join(text)).split())
        if line:
            out.append((line, outside, main > 0))
        text, outside = [], 0

    def add(piece: str) -> None:
        nonlocal outside
        text.append(piece)
        if not link:
            outside += len(piece.strip())

    at = 0
    for tag in TAG.finditer(page):
        if not skip and tag.start() > at:
            add(page[at : tag.start()])
        at = tag.end()
        closing, name, attributes = tag[1] == "/", tag[2].lower(), tag[3]
        if skip:
            if skip == "p" and name in CLOSES_P and not (closing and name == "p"):
                skip = ""
            elif name == skip and name not in VOID and not attributes.rstrip().endswith("/"):
                depth += -1 if closing else 1
                if depth == 0:
                    skip = ""
                    continue
            elif closing and name in stack and not inner[name]:
                skip = ""  # the element was not closed before its parent
            elif name not in VOID:
                inner[name] += -1 if closing else 1
            if skip:
                continue
        if name in BLOCKS:
            end()
        if closing:
            if name in stack:
                while stack.pop() != name:
                    pass
                main = sum(x in MAIN for x in stack)
            link -= name == "a" and link > 0
            continue
        header = name == "header" and not main
        if name not in VOID and (name in SKIPPED or header or (name not in ("html", "body", "main") and _marked(name, attributes))):
            if attributes.rstrip().endswith("/"):
                continue
            end()
            out.append(None)
            skip, depth, inner = name, 1, Counter()
            continue
        if name in VOID:
            continue
        if name in BLOCKS:
            link = 0
            if name != "p":
                stack.append(name)
        main += name in MAIN
        link += name == "a"
    if not skip:
        add(re.sub(r"<[/!?a-zA-Z][^>]*\Z", "", page[at:]))
    end()
    return out


def main_text(page: str | None, share: float = SHARE) -> str:
    """The kept blocks of a page, joined by newlines.

    A block weighs its text outside links; a gap weighs nothing.  The curve of
    window sums falls to zero only where ``WINDOW`` blocks in a row weigh
    nothing: those places cut the page into runs.  A run is kept if its curve
    surges to ``share`` of the page's greatest window; it reaches back to the
    dive before it and on to the next.  Blocks of link text only at the edges
    of a kept run are left out.
    """
    lines = _lines(page or "")
    if any(x is not None and x[2] for x in lines):
        # A page that names its main element has gaps everywhere else.
        lines = [x if x is not None and x[2] else None for x in lines]
    weight = [0 if x is None else x[1] for x in lines]
    sums = [sum(weight[i : i + WINDOW]) for i in range(len(weight))]
    top = max(sums, default=0)
    if top <= 0:
        return ""
    kept, at = [], 0
    while at < len(lines):
        if not weight[at]:
            at += 1
            continue
        # From here the curve stays above zero until a whole window is empty.
        end = at
        while end < len(lines) and sums[end] > 0:
            end += 1
        if any(sums[i] >= share * top for i in range(at, end)):
            last = max(i for i in range(at, end) if weight[i])
            kept += [lines[i][0] for i in range(at, last + 1) if lines[i] is not None]
        at = end
    return "\n".join(kept)


def extract(pages: DataFrame, page: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each and its length in code points."""

    def start() -> Callable:
        def run(batch: list) -> list:
            texts = [main_text(p) for p in batch]
            return [texts, [len(t) for t in texts]]

        return run

    return map_text(pages, page, start, [(out, T.StringType()), ("n_chars", T.LongType())])
