"""Main text of web pages by tag-path ratios.

A text node belongs to the path of block tags (with class and id) from the root to it. For each path of a page the text length and
the punctuation are summed and divided by its nodes; the two ratios are smoothed over neighbours in page order and fused by their
product. A path is content if its mean reaches a share of the page's mean, or of LEAST where that is less. Marks in the page are only priors, which
multiply the fused value: MAIN_WEIGHT under article or main, CHROME_WEIGHT under an element with a word of CHROME_WORD in its class, id or
role. Elements whose tag holds no text of an article (CHROME, RAW) are no nodes. A heading is kept with the block after it.

Null, empty and broken html never fails: what cannot be read as a tag is text, open elements end with the page. Null or empty html gives
an empty text; very long pages are read whole; repeated rows give equal rows; an empty table gives no rows; ids may be null; columns but
page_id, url and html are not read.
"""

import html as entities
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, in_batches

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
CHROME = {"head", "nav", "header", "footer", "aside", "form", "button", "menu", "dialog"}
#: A word of a class, id or role that speaks against article text.
CHROME_WORD = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner\w*|sidebar\w*|side|nav|navbar|navigation|menu\w*|breadcrumbs?|header|masthead|footer|foot|cookie\w*|consent|notice\w*|alert\w*|popup|modal|overlay|newsletter|subscribe|signup|login|share\w*|social|related|recommend\w*|widget|comments?|commentlist|disqus|replies|reply|respond|form|search|pagination|pager|complementary|contentinfo)(?:$|[\s_-]|list|box|\d)",
    re.I,
)
MAIN = {"article", "main"}
PUNCTUATION = re.compile(r"[.,;:!?。、，；：！？…]")
SMOOTHING, SHARE, LEAST, MAIN_WEIGHT, CHROME_WEIGHT = (0.25, 0.5, 0.25), 0.5, 16.0, 20.0, 0.01
SCHEMA = "page_id long, url string, text string, n_chars long"


def blocks(page: str) -> list[tuple[str, float, str]]:
    """(path, prior, text) of each text block outside of left-out elements, in page order."""
    out, stack, held, at, skipped = [], [], [], 0, 0

    def flush():
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            prior = (MAIN_WEIGHT if any(x[0] in MAIN for x in stack) else 1.0) * (CHROME_WEIGHT if any(x[3] for x in stack) else 1.0)
            out.append(("/".join(x[1] for x in stack), prior, text))

    def pop():
        nonlocal skipped
        skipped -= stack.pop()[2]

    while m := TOKEN.search(page, at):
        if not skipped:
            held.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = (m[1], m[3]) if m[2] else (m[4], m[6])
        if tag in RAW and not closing:
            end = re.compile(rf"</{re.escape(tag)}\s*+[^>]*+>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        names = " ".join(a or b or c for a, b, c in NAMED.findall(attributes)) if attributes and not closing else ""
        if tag in INLINE and not (names and CHROME_WORD.search(names)) and not any(x[0] == tag for x in stack[-1:] if closing):
            continue
        if not skipped:
            flush()
        if tag in VOID:
            continue
        if closing:
            if any(x[0] == tag for x in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in {"p", "li", "dt", "dd", "tr", "td", "th", "option"} and stack and (stack[-1][0] == tag or {stack[-1][0], tag} <= {"dt", "dd"} or {stack[-1][0], tag} <= {"td", "th"}):
            pop()
        elif tag not in INLINE and stack and stack[-1][0] == "p":
            pop()
        if attributes.endswith("/") and tag not in {"p", "div", "article"} and tag in INLINE:
            continue
        against = bool(names and tag not in {"html", "body"} | MAIN and CHROME_WORD.search(names))
        stack.append((tag, f"{tag}.{names}" if names else tag, tag in CHROME, against))
        skipped += tag in CHROME
    if not skipped:
        held.append(page[at:])
        flush()
    return out


def main_text(page: str | None, share: float = SHARE) -> str:
    """The main text of a page."""
    found = blocks(page) if isinstance(page, str) and page else []
    if not found:
        return ""
    nodes: dict[str, list[float]] = {}
    for path, _, text in found:
        n = nodes.setdefault(path, [0, 0, 0])
        n[0] += 1
        n[1] += len(text)
        n[2] += len(PUNCTUATION.findall(text))
    order = [nodes[path] for path, _, _ in found]
    near = [[order[max(0, i - 1)], order[i], order[min(len(order) - 1, i + 1)]] for i in range(len(order))]
    fused = [sum(w * n[1] / n[0] for w, n in zip(SMOOTHING, x)) * (0.5 + sum(w * n[2] / n[0] for w, n in zip(SMOOTHING, x))) for x in near]
    fused = [f * prior for f, (_, prior, _) in zip(fused, found)]
    least = share * max(sum(fused) / len(fused), LEAST)
    total: dict[str, float] = {}
    for (path, _, _), f in zip(found, fused):
        total[path] = total.get(path, 0.0) + f
    kept = {path for path, f in total.items() if f / nodes[path][0] >= least}
    chosen = [path in kept for path, _, _ in found]
    for i in range(len(found) - 2, -1, -1):  # a heading goes with the block after it
        chosen[i] = chosen[i] or chosen[i + 1] and re.search(r"(?:^|/)h[1-6][^/]*$", found[i][0]) is not None
    return " ".join(text for keep, (_, _, text) in zip(chosen, found) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """The main text of every row of pages(page_id, url, html) (SCHEMA)."""

    def texts(batches: Iterator) -> Iterator:
        for batch in batches:
            text = [main_text(h) for h in batch.column("html").to_pylist()]
            yield arrow_rows([(t, len(t)) for t in text], SCHEMA, page_id=batch.column("page_id"), url=batch.column("url"))

    return in_batches(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), texts, SCHEMA)
