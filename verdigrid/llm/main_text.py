"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from verdigrid.llm.common import map_batches

#: Elements whose content is no text of the page; read up to their end tag.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "canvas", "object", "select", "video", "audio",
       "annotation", "annotation-xml"}
#: Elements that are no part of an article.
APART = {"head", "title", "nav", "footer", "aside", "form", "button", "menu", "dialog", "label", "fieldset", "datalist", "option"}
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"html", "body", "main", "article", "section", "div", "header", "hgroup", "h1", "h2", "h3", "h4", "h5", "h6", "p", "ul", "ol", "li", "dl", "dt", "dd",
          "table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "blockquote", "pre", "figure", "figcaption", "address", "details", "summary",
          "center", *APART}
#: What an opening tag closes if it is the innermost block.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words in class, id or role that mark what surrounds an article, and what holds one. A name counts as a whole: all its words are
#: such, or say what form or place the thing has, so that 'with-sidebar' and 'search-results' mark nothing.
_REMARK = r"comments?|commentlist|disqus|repl(?:y|ies)|responses?|discussion"
_AROUND = (r"ads?|advert\w*|adv|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|sidebar|side|menu|nav|"
           rf"navbar|navigation|breadcrumbs?|{_REMARK}|share|sharing|social|related|recommend\w*|"
           r"newsletter|subscri\w*|signup|login|search|footer|header|masthead|topbar|toolbar|widget|pagination|pager|copyright|legal|tags|contentinfo|"
           r"complementary|outbrain|taboola")
_FORM = (r"list|items?|box|block|bar|buttons?|links?|icons?|wrap|wrapper|container|inner|area|section|form|posts|articles|stories|site|main|global|primary|"
         r"secondary|mobile|top|bottom|[0-9]+")
AROUND, REMARK = (re.compile(rf"(?:^|\s)(?:(?:{_FORM})[_-]+)*(?:{words})(?:[_-]+(?:{_AROUND}|{_FORM}))*(?:$|\s)", re.I) for words in (_AROUND, _REMARK))
WITHIN = re.compile(r"(?:^|[\s_-])(?:article|articlebody|post|entry|story|content|main|text|body)(?:$|[\s_-])", re.I)
#: Elements that no class word marks as apart; the last two take an article back out of a block that a class word, or a form, set apart.
WHOLE, RESETS = {"html", "body", "article", "main"}, {"article", "main"}
#: How far a block stands apart: by a class word or a form around it, or for good.
BY_NAME, FOR_GOOD = 1, 2
#: Smoothing over neighbouring blocks, and the share of the spread of scores that a path must reach on a page without an article element.
SMOOTH = np.array([0.1, 0.2, 0.4, 0.2, 0.1])
#: Blocks that links may fill without making them a menu, if a container holds them.
LISTED = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "ul", "ol", "li", "dl", "dt", "dd", "p", "blockquote", "pre", "td", "th", "caption", "figcaption"}
SPREAD = 0.5
MAX_LINKS = 0.6
PUNCTUATION = re.compile(r"[.,;:!?…。、؟¿¡]")

_MARKUP = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|$)", re.S)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class Element(NamedTuple):
    tag: str
    path: int  # number of the path of block elements and their class names
    apart: int  # 0, BY_NAME or FOR_GOOD
    article: int  # number of the container around it: above 0 for an article or main element, below for a class name, 0 for none
    block: int  # number of the block that its text goes to
    link: bool
    inner: int  # place on the stack of the innermost block, itself included
    listed: bool  # lies in one of ``LISTED``


class Block:
    __slots__ = ("path", "apart", "article", "listed", "parts", "linked")

    def __init__(self, at: Element) -> None:
        self.path, self.apart, self.article, self.listed, self.parts, self.linked = at.path, at.apart, at.article, at.listed, [], 0


def parse(page: str) -> list[tuple[Block, str]]:
    """Text blocks of a page in order: each with the number of its root-to-leaf path of block elements and their class names.

    End tags that close nothing are passed over; elements left open end with the one around them. A run of text belongs to
    the innermost open block; text after an inner block begins a new one. Time grows with the page, not with its depth.
    """
    blocks: list[Block] = []
    stack = [Element("", 0, 0, 0, -1, False, 0, False)]
    paths: dict[tuple[int, str], int] = {}
    opened: Counter[str] = Counter()  # tags on the stack
    numbers = {"article": 0, "block": 0}
    current: list = [None, -1]  # the block that text goes to now, and its number

    def text(raw: str) -> None:
        if not raw:
            return
        top = stack[-1]
        if current[0] is None or current[1] != top.block:
            if raw.isspace():
                return
            current[0], current[1] = Block(top), top.block
            blocks.append(current[0])
        current[0].parts.append(raw)
        if top.link:
            current[0].linked += len(raw.strip())

    def close(down_to: int) -> None:
        opened.subtract(e.tag for e in stack[down_to:])
        del stack[down_to:]

    at = 0
    while True:
        found = _MARKUP.search(page, at)
        if found is None:
            text(page[at:])
            break
        text(page[at:found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    if tag in BLOCKS:
                        current[0] = None
                    break
                # an inline end tag never reaches out of its block
                if tag not in BLOCKS and stack[i].tag in BLOCKS:
                    break
            continue
        if tag in RAW:
            if not found[3].endswith("/") or tag in ("script", "style"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            text(" ")
        if tag in EMPTY:
            if tag == "hr":
                current[0] = None
            continue
        block = tag in BLOCKS
        if block:
            inner = stack[-1].inner
            if stack[inner].tag == "p" or stack[inner].tag in CLOSES.get(tag, ()):
                close(inner)
                while stack[-1].tag in CLOSES.get(tag, ()):
                    close(len(stack) - 1)
            current[0] = None
            numbers["block"] += 1
        above = stack[-1]
        named = " ".join(a or b or c for a, b, c in _NAMED.findall(found[3])) if found[3] else ""
        apart = above.apart
        if apart == BY_NAME and tag in RESETS and not above.article:
            apart = 0
        if tag == "form" or named and block and tag not in WHOLE and AROUND.search(named):
            apart = max(apart, BY_NAME)
        # an article that bears a remark's name is one only inside the article that it is about
        remark = bool(named and block and REMARK.search(named)) and (tag not in WHOLE or tag == "article" and opened[tag] > 0)
        if tag in APART and tag != "form" or tag == "header" and not above.article or remark:
            apart = FOR_GOOD
        article = above.article
        marked = tag in RESETS
        if not article and not apart and (marked or tag in ("div", "section") and named and WITHIN.search(named)):
            numbers["article"] += 1
            article = numbers["article"] if marked else -numbers["article"]
        path = paths.setdefault((above.path, f"{tag}.{re.sub('[0-9]+', '0', named)}"), len(paths) + 1) if block else above.path
        stack.append(Element(tag, path, apart, article, numbers["block"] if block else above.block, above.link or tag == "a",
                             len(stack) if block else above.inner, above.listed or tag in LISTED))
        opened[tag] += 1
    out = []
    for b in blocks:
        joined = " ".join(html.unescape("".join(b.parts)).split())
        if joined:
            out.append((b, joined))
    return out


def path_ratios(blocks: list[tuple[Block, str]]) -> np.ndarray:
    """A score for each block: text length and punctuation of its path for each node of it, smoothed over the neighbours, and fused.

    Links and what stands apart from articles weigh nothing.
    """
    sums: dict[int, np.ndarray] = {}
    for b, t in blocks:
        own = np.array([1, 0 if b.apart else len(t), 0 if b.apart else len(PUNCTUATION.findall(t)), b.linked])
        sums[b.path] = sums.get(b.path, 0) + own
    of = np.array([sums[b.path] for b, _ in blocks], float)
    links = of[:, 3] / np.maximum(of[:, 1], 1)
    ratios = of[:, 1:3] / of[:, :1] * np.where(links > MAX_LINKS, 0, 1 - np.minimum(links, 1))[:, None]
    wide = np.pad(ratios, ((2, 2), (0, 0)), mode="edge")
    smooth = np.column_stack([np.convolve(wide[:, i], SMOOTH, "valid") for i in range(2)])
    fused = smooth[:, 0] * (1 + np.log1p(smooth[:, 1]))
    mean = {p: fused[[i for i in at]].mean() for p, at in _places(blocks).items()}
    own = ratios[:, 0] > 0
    return np.array([mean[b.path] for b, _ in blocks]) * own


def _places(blocks: list[tuple[Block, str]]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, (b, _) in enumerate(blocks):
        out.setdefault(b.path, []).append(i)
    return out


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in order, joined by an empty line.

    Paths are scored as a whole, so that a short paragraph stays with the long ones of its path; those above a share of the
    spread pass. If the page marks containers, all stay that have a passing path, and the best one; of these all blocks
    stay but paths of links that are no headings, lists, paragraphs or table cells. A class name alone does not shut out what passes elsewhere.
    """
    blocks = parse(page or "")
    if not blocks:
        return ""
    score = path_ratios(blocks)
    article = np.array([b.article for b, _ in blocks])
    passing = (score > 0) & (score >= SPREAD * score.std())
    if score[article != 0].sum() > 0:
        sums: dict[int, float] = {}
        for k, own in zip(article.tolist(), score.tolist()):
            sums[k] = sums.get(k, 0) + own
        chosen = {k for k in article[passing].tolist() if k} | {max((k for k in sums if k), key=lambda k: (sums[k], -abs(k)))}
        inside = np.array([k in chosen for k in article.tolist()])
        listed = np.array([not b.apart and b.listed for b, _ in blocks])
        elements = any(k > 0 and v > 0 for k, v in sums.items())
        kept = inside & ((score > 0) | listed) | passing & (article == 0) & (not elements)
    else:
        kept = passing
    return "\n\n".join(t for (_, t), k in zip(blocks, kept) if k)


def extract_pages(pages: DataFrame, source: str = "html") -> DataFrame:
    """Add ``text`` and ``n_chars`` (code points) to ``pages``.

    A null or empty page and one without an article have an empty text. Columns of these names are replaced; repeated
    pages are read each. Whole pages; one pass, no shuffle.
    """
    others = pages.select(*[c for c in pages.columns if c not in ("text", "n_chars")])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others.schema.fields if f.name != source)
    names = [c for c in others.columns if c != source]

    def run(batch: dict) -> dict:
        found = [main_text(p) for p in batch[source]]
        return {**{c: batch[c] for c in names}, "text": found, "n_chars": list(map(len, found))}

    return map_batches(others, run, f"{fields}, text string, n_chars bigint", rows=256)
