"""Main text of web pages by consensus of their host.

Every page's containers are scored by the text that lies in them (links and
boilerplate count against it). Each page votes, with its best containers' scores,
for generalised tag-class paths; Spark sums the votes of a host, and the path
that wins, widened to the containers around it as long as what they add is text and
not mostly links, is read from all of the host's pages. A page without the winning path
falls back to its own best container. Votes are summed in the tasks first, so a
host with a third of all pages is one small row for each task.

In the container menus, headers and footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are left out, by tag, role or class. Blocks
keep page order; white space in a block is one space.

Defined cases: a null or empty page, or one without text, gives an empty text;
a null or unreadable url is a host of its own for each page; unclosed and stray
tags are closed or skipped; a tag that never ends is markup up to the next ``>``, else to the page's
end; elements nested deeper than DEEP are read as if they stood at that depth; a form that
holds parts of a page (its article, header or menu) is layout, and its text is read; repeated rows vote and are read each; extra columns
are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import broadcast_if_small, map_frames, materialise

#: HTML's elements by kind, and words of class, id or role that mark what is no article. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe object select title annotation annotation-xml".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img br "
                   "math semantics mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mtable mtr mtd svg g text tspan".split())
SKIPPED = frozenset("nav aside footer button dialog menu head".split())
#: A form that holds one of these is a page's layout. Fixed values.
PAGE_PARTS = frozenset("article main header footer nav".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
SKIPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer disqus "
    "footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination popup promo promoted "
    "replies respond sidebar signup sponsor sponsored subscribe subscription topbar".split())
#: Boxes that are no article only where their text is mostly links. Fixed values.
LINKED_WORDS = frozenset("recommended related share sharing social toolbar widget".split())
#: A class with one of these tells of what is there or not (``has-sidebar``), and is no sidebar. Fixed values.
TELLING_WORDS = frozenset("has have no non none not with without".split())
PAGE_WORDS = frozenset("header site page global main top".split())
CONTAINERS = frozenset("article main section div td body".split())
#: An open element of the first kind ends when one of the second begins. Fixed values.
CLOSES = {"p": frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
          "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
          "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}

#: Levels of nesting that are told apart.
DEEP = 200

_START = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>""")  # quotes count after an equals sign
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")  # whole ones, one after the other
_WORD = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    at: int  # the innermost path
    linked: int  # characters in links
    top: int  # the innermost path that is an article's, if the block is not
    skipped: bool


class Page(NamedTuple):
    """Paths of generalised elements, each the number of its parent (before it) and its last step, and the blocks in order."""

    parents: list[int]
    steps: list[str]
    found: list[Block]


class _Open(NamedTuple):
    tag: str
    at: int  # path of the innermost block element
    top: int  # the innermost path outside of what is skipped
    skipped: bool
    linked_box: bool
    form: int  # number of the form around, from 1; 0: none


def _tokens(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, tag, attributes) of tags, comments and declarations (no tag); send() moves to the place to go on from.

    Every character is looked at a bounded number of times: once a tag's quotes run to the end of
    the page, quotes are no longer heeded, and after the last ``>`` there is no tag.
    """
    at, quotes, last = 0, True, page.rfind(">")
    while m := _START.search(page, at):
        if m[0] == "<!--":
            end = page.find("-->", m.end())
            end = end + 3 if end >= 0 else len(page)
        elif m.start() > last:  # never ends
            end = len(page)
        else:
            closed = _REST.match(page, m.end()) if quotes and m[2] else None
            quotes &= closed is not None or not m[2]
            end = closed.end() if closed else page.index(">", m.start()) + 1
        moved = yield m.start(), end, m[1] or "", (m[2] or "").lower(), page[m.end() : end - 1] if m[2] else ""
        at = moved or end


def _element(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """Generalised name (class words without numbers), whether it is no article, and whether it is none where it is mostly links."""
    skip, box = tag in SKIPPED, False
    words: list[str] = []
    seen: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key not in ("class", "id", "role", "hidden", "aria-hidden") or key in seen:  # the first one counts
            continue
        seen.add(key)
        if key == "role":
            skip |= value in SKIPPED_ROLES
        elif key in ("hidden", "aria-hidden"):
            skip |= key == "hidden" or value == "true"
        else:
            found = _WORD.findall(value)
            names = [_WORD.findall(name) for name in value.split()]
            told = [name for name in names if TELLING_WORDS.isdisjoint(name)]
            skip |= any(not SKIPPED_WORDS.isdisjoint(name) for name in told)
            box |= any(not LINKED_WORDS.isdisjoint(name) for name in told)
            skip |= "header" in found and PAGE_WORDS.issuperset(found)  # not an article's own
            if key == "class":
                words += found
    article = tag in ("html", "body", "article", "main")
    return ".".join([tag, *sorted(set(words))]), skip and not article, box and not article


def blocks(page: str) -> Page:
    """Blocks of text in page order, in time and memory in proportion to the page."""
    parents, steps, depths = [-1], [""], [0]
    known: dict[tuple[int, str], int] = {}
    out: list[tuple[Block, int, int]] = []  # with the form around, and the innermost path outside of it
    layout: set[int] = set()  # forms that hold parts of the page
    tops: list[int] = [0]  # of each form: the innermost path outside of it
    stack = [_Open("", 0, 0, False, False, 0)]
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            o = stack[-1]
            links = o.linked_box and 2 * linked >= len(joined)
            out.append((Block(joined, o.at, linked, o.top if o.skipped else parents[o.at] if links else o.at, o.skipped or links), o.form, tops[o.form]))
        text.clear()
        linked = 0

    def close() -> None:
        opened[stack.pop().tag] -= 1

    def read(piece: str) -> None:
        nonlocal linked
        text.append(piece)
        if opened["a"]:
            linked += len(piece.strip())

    def enter(tag: str, attributes: str, inline: bool) -> None:
        name, skip, box = _element(tag, attributes)
        up = stack[-1]
        at, form = up.at, up.form
        if tag in PAGE_PARTS and form:
            layout.add(form)
        if tag == "header" and not opened["article"] and not opened["main"]:
            skip = True
        if not inline:
            under = parents[at] if depths[at] >= DEEP else at
            at = known.setdefault((under, name), len(parents))
            if at == len(parents):
                parents.append(under)
                steps.append(name)
                depths.append(depths[under] + 1)
        if tag == "form" and not form:
            tops.append(up.top if up.skipped else up.at)
            form = len(tops) - 1
        top = up.top if up.skipped else up.at if skip and not inline else max(0, parents[at]) if skip else at
        stack.append(_Open(tag, at, top, up.skipped or skip, up.linked_box or box, form))
        opened[tag] += 1

    at, tokens = 0, _tokens(page)
    token = next(tokens, None)
    while token is not None:
        start, end, slash, tag, attributes = token
        read(page[at:start])
        at, moved = end, None
        if slash:
            if opened[tag]:
                if tag not in INLINE:
                    flush()
                while stack[-1].tag != tag:
                    close()
                close()
            elif tag == "br":
                text.append(" ")
        elif tag in RAW:  # its content is no text
            if not attributes.rstrip().endswith("/"):
                closed = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = moved = closed.end() if closed else len(page)
        elif tag in INLINE:
            if tag == "br":
                text.append(" ")
            elif tag not in VOID and not attributes.rstrip().endswith("/"):
                enter(tag, attributes, inline=True)
        elif tag:
            flush()
            while stack[-1].tag in INLINE:  # a block ends inline elements left open
                close()
            while tag in CLOSES.get(stack[-1].tag, ()):
                close()
            if tag not in VOID and not attributes.rstrip().endswith("/"):
                enter(tag, attributes, inline=False)
        try:
            token = tokens.send(moved)
        except StopIteration:
            token = None
    read(page[at:])
    flush()
    found = [b._replace(top=min(b.top, top), skipped=True) if form and form not in layout else b for b, form, top in out]
    return Page(parents, steps, found)


def _tag(step: str) -> str:
    return step.partition(".")[0]


def _names(page: Page, wanted: Iterable[int]) -> dict[int, str]:
    """The paths as text, of some of the numbers."""
    out = {}
    for at in wanted:
        parts, up = [], at
        while up > 0:
            parts.append(page.steps[up])
            up = page.parents[up]
        out[at] = "/".join(reversed(parts))
    return out


def containers(page: Page) -> dict[str, float]:
    """Score of each container path: characters of its blocks that are text and no links, nearer blocks more.

    A container around the best one holds the same text at a greater distance, so the
    innermost one that holds nearly all of it wins; semantic elements weigh more. One sum
    for each path is handed on to the path around it.
    """
    n = len(page.parents)
    own, met = [0.0] * n, [False] * n
    for b in page.found:
        own[b.top] += -0.2 * len(b.text) if b.skipped else len(b.text) - 2 * min(b.linked, len(b.text))
        met[b.top] = True
    out: dict[int, float] = {}
    for at in range(n - 1, 0, -1):  # a path comes after the one around it
        if not met[at]:
            continue
        tag, hand = _tag(page.steps[at]), own[at]
        if tag in CONTAINERS:
            out[at] = (1.5 if tag in ("article", "main") else 1.0) * hand
            hand *= 0.7
        own[page.parents[at]] += hand
        met[page.parents[at]] = True
    names = _names(page, out)
    return {names[at]: s for at, s in out.items()}


def amounts(page: Page) -> dict[str, tuple[int, int]]:
    """Characters of text that is not skipped in each container path, and those of them in links."""
    n = len(page.parents)
    chars, links = [0] * n, [0] * n
    for b in page.found:
        if not b.skipped:
            chars[b.at] += len(b.text)
            links[b.at] += min(b.linked, len(b.text))
    for at in range(n - 1, 0, -1):
        chars[page.parents[at]] += chars[at]
        links[page.parents[at]] += links[at]
    names = _names(page, [at for at in range(1, n) if chars[at] and _tag(page.steps[at]) in CONTAINERS])
    return {name: (chars[at], links[at]) for at, name in names.items()}


def widened(path: str, held: dict[str, tuple[int, int]]) -> str:
    """The highest container around the path, below the body, up to which all that is added is not mostly links."""
    steps = path.split("/")
    n, linked = held.get(path, (0, 0))
    for depth in range(len(steps) - 1, 0, -1):
        around = "/".join(steps[:depth])
        if _tag(steps[depth - 1]) == "body":
            break
        if around not in held:  # no container
            continue
        more, more_linked = held[around][0] - n, held[around][1] - linked
        if more and 2 * more_linked >= more:
            break
        if more:
            path = around
            n, linked = held[around]
    return path


def main_text(page: Page, path: str | None) -> str:
    """The blocks of the container (None: of the page), without what is skipped inside of it."""
    inside = [path is None] * len(page.parents)
    steps = path.split("/") if path else []
    matched = [0] + [-1] * (len(page.parents) - 1)  # steps of the path that a number has gone along
    for at in range(1, len(page.parents)):
        up = page.parents[at]
        if inside[up]:
            inside[at] = True
        elif matched[up] >= 0 and matched[up] < len(steps) and page.steps[at] == steps[matched[up]]:
            matched[at] = matched[up] + 1
            inside[at] = matched[at] == len(steps)
    return "\n".join(b.text for b in page.found if inside[b.at] and not b.skipped)


def _best(scored: dict[str, float]) -> str | None:
    good = [(s, p) for p, s in scored.items() if s > 0]
    return max(good)[1] if good else None


def _vote(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        sums: dict[tuple[str, str], list[float]] = {}
        for host, page in zip(f["host"], f["html"], strict=True):
            if host is None or not page:
                continue
            found = blocks(page)
            scored, held = containers(found), amounts(found)
            whole = sum(s for s in scored.values() if s > 0)
            for path, s in scored.items():
                v = sums.setdefault((host, path), [0.0, 0, 0, 0])
                if s > 0:  # a page's votes sum up to one
                    v[0] += s / whole
                    v[1] += 1
                n, linked = held.get(path, (0, 0))
                v[2] += n
                v[3] += linked
        yield pd.DataFrame([(*k, *v) for k, v in sums.items()], columns=["host", "path", "votes", "n_pages", "chars", "linked"])


def _widen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        held = [dict(zip(p, zip(n, k, strict=True), strict=True)) for p, n, k in zip(f["paths"], f["chars"], f["linked"], strict=True)]
        yield f[["host", "votes", "n_pages"]].assign(path=[widened(p, h) for p, h in zip(f["path"], held, strict=True)])[["host", "path", "votes", "n_pages"]]


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        texts, paths = [], []
        for path, page in zip(f["path"], f["html"], strict=True):
            found = blocks(page or "")
            text = main_text(found, path) if path else ""
            if not text:  # not laid out like its host's other pages
                path = _best(containers(found))
                path = path and widened(path, amounts(found))
                text = main_text(found, path)
            texts.append(text)
            paths.append(path)
        yield pd.DataFrame({"page_id": f["page_id"].astype("Int64").array, "url": f["url"], "text": texts, "path": paths, "n_chars": [len(t) for t in texts]})


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes, n_pages): the winning path of each host, widened; ties to the first path in order."""
    votes = pages.transform(map_frames, _vote, "host string, path string, votes double, n_pages long, chars long, linked long")
    summed = materialise(votes.groupBy("host", "path").agg(*[F.sum(c).alias(c) for c in ("votes", "n_pages", "chars", "linked")]), "host-votes")
    best = F.max_by(F.struct("path", "votes", "n_pages"), F.struct(F.round("votes", 6), "path"))
    won = summed.where("votes > 0").groupBy("host").agg(best.alias("b")).select("host", "b.*")
    around = summed.select("host", F.col("path").alias("outer"), "chars", "linked")
    # the winner and what is around it: as many rows as a path has steps
    held = won.join(around, "host").where(F.col("outer").eqNullSafe(F.col("path")) | F.expr("startswith(path, concat(outer, '/'))"))
    lists = held.groupBy("host").agg(*[F.first(c).alias(c) for c in ("path", "votes", "n_pages")], F.collect_list(F.struct("outer", "chars", "linked")).alias("x"))
    return lists.select("host", "path", "votes", "n_pages", F.col("x.outer").alias("paths"), F.col("x.chars").alias("chars"), F.col("x.linked").alias("linked")).transform(
        map_frames, _widen, "host string, path string, votes double, n_pages long")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, path, n_chars) of every page; path is the container that was read."""
    host = F.lower(F.expr("try_parse_url(url, 'HOST')"))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    won = materialise(host_paths(pages).select("host", "path"), "host-paths")
    joined = pages.join(broadcast_if_small(won, won.count(), 200), "host", "left")
    return joined.select("page_id", "url", "html", "path").transform(map_frames, _read, "page_id long, url string, text string, path string, n_chars long")
