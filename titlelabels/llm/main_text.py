"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. A line weighs its letters outside
links; lines of menus, adverts, forms and other parts that their element, role or class
names as such are taken out, and the borders of page parts leave empty lines. A part is not
taken out by its name where all article or main text, or most of a page without any, is inside. The sum of
weights over a window of ``WINDOW`` lines then surges where running text begins and dives
to zero where it ends: the lines between a surge that reaches ``SURGE`` and its dive are
kept. Inside an article or main element every line counts, and only such regions do, unless a
surge outside has more weight than all of them, or they have no surge: then all surges count. A short
region joins them where it lies between surges of its parent, or beside one with only parts taken
out between. A page in which no window reaches ``SURGE`` keeps the region of the highest one.

Null and empty pages give the empty text, and so do pages without text outside the parts
taken out. Unclosed and stray tags end at their enclosing block; an unclosed script or comment
goes to the end of the page, an unclosed tag to the next one.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

from pyspark.sql import DataFrame

from titlelabels.llm.common import map_rows

WINDOW = 3
SURGE = 80

_TAG = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
    |<(?P<raw>script|style|noscript|template|svg|math|iframe|object|select|textarea|title|canvas|audio|video|button)
      (?=[\s/>])(?:{_TAG}>|[^<>]*+>).*?(?:</(?P=raw)\s*>|\Z)
    |<(?P<close>/?)(?P<name>[a-z][^\s/<>]*+)(?:(?P<rest>{_TAG})>|(?P<loose>[^<>]*+)(?:>|(?=<)|\Z))
    |<[!?/][^>]*+(?:>|\Z)
    |(?P<text>[^<]+|<)""",
    re.I | re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([a-z_:-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are never main text; a header counts only outside the article.
DROPPED = frozenset("nav aside footer form dialog menu".split())
MAIN = frozenset(("article", "main"))
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of a class or id that name a part as something else than main text.
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside footer cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login "
    "comment comments disqus respond reply replies share sharing social related recommended recommendations widget pagination pager "
    "copyright legal masthead toolbar search skip hidden banner".split()
)
#: Words that say nothing beside such a word: ``ad-box`` is an ``ad``; ``has-sidebar`` and ``comments-open`` are no parts.
NEUTRAL_NAMES = frozenset("box wrapper wrap container section area block list item inner left right top bottom".split())
#: Elements that no class or id takes out.
WHOLE = frozenset("html body main article".split())
#: Such words beside a header's name say that the element is the page's content.
KEPT_NAMES = frozenset("article content main body post entry story text".split())
HEADER_NAMES = frozenset(("header", "topbar", "head"))


def _named(value: str) -> bool:
    """Whether a whole word of a class or id says that the part is no main text."""
    for token in value.split():
        parts = {p.lower() for p in NAME_PART.findall(token)} - NEUTRAL_NAMES
        if parts and parts <= DROPPED_NAMES:
            return True
    return False


def _dropped(name: str, rest: str, inside_main: bool) -> tuple[bool, bool]:
    """Whether an element is taken out whatever it holds (hidden, role), and whether its name asks for it."""
    named = name in DROPPED or (name == "header" and not inside_main)
    if not rest:
        return False, named
    parts: set[str] = set()
    for m in ATTRIBUTE.finditer(rest):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "role" and value.strip().lower() in DROPPED_ROLES:
            return True, named
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True, named
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, named
        if key in ("class", "id"):
            named |= name not in WHOLE and _named(value)
            parts |= {p.lower() for p in value.split()}
    return False, named or name not in WHOLE and bool(parts & HEADER_NAMES) and not inside_main and not parts & KEPT_NAMES


class Line(NamedTuple):
    text: str
    weight: int
    main: bool
    #: The block that holds the line and the one around it.
    blocks: tuple[int, int] = (-1, -1)
    #: The innermost part around the line whose name asks to take it out, or -1.
    part: int = -1


GAP = [Line("", 0, False)] * WINDOW


def lines(html: str) -> list[Line]:
    """The lines outside the parts taken out; ``WINDOW`` empty lines at the borders of page parts."""
    out: list[Line] = []
    texts: list[str] = []
    open_names: list[tuple[str, bool, bool, int]] = []  # name, dropped, main, number of the named part or -1
    blocks: list[int] = [-1, -1]
    named: list[int] = [-1]
    around: list[int] = []  # of each named part the one around it, or -1
    holds: list[int] = []  # main elements in each named part
    count: Counter = Counter()
    dropped = main = links = opened = 0
    linked = 0

    def flush() -> None:
        nonlocal linked
        if texts:
            text = " ".join("".join(texts).split())
            if text:
                out.append(Line(text, max(len(text) - linked, 0), main > 0, (blocks[-1], blocks[-2]), named[-1]))
            texts.clear()
        linked = 0

    def leave(name: str) -> None:
        nonlocal dropped, main, links
        links = 0  # a link ends with the first block that ends in or around it
        while open_names:
            last, was_dropped, was_main, part = open_names.pop()
            blocks.pop()
            count[last] -= 1
            dropped -= was_dropped
            main -= was_main
            if part >= 0:
                named.pop()
            if was_dropped or was_main or part >= 0:
                out.extend(GAP)
            if last == name:
                return

    for m in TOKEN.finditer(html):
        if m["text"] is not None:
            if not dropped:
                text = unescape(m["text"])
                texts.append(text)
                if links:
                    linked += len(text.strip())
            continue
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        block = name in BLOCKS
        if block:
            flush()
        if m["close"]:
            if name == "a":
                links = 0
            elif count[name]:
                flush()
                leave(name)
            continue
        if name == "br":
            texts.append(" ")
            continue
        if name in ("td", "th"):
            texts.append(" ")
        if name == "a":
            links = 1
        if name in VOID:
            continue
        if block and open_names and open_names[-1][0] == "p":
            leave("p")
        if name == "li" and open_names and open_names[-1][0] == "li":
            leave("li")
        rest = m["rest"] if m["rest"] is not None else m["loose"] or ""
        if rest.endswith("/") and not block:
            continue
        drop, by_name = _dropped(name, rest, main > 0)
        by_name &= not drop and not dropped
        is_main = name in MAIN and not drop and not dropped
        if drop or by_name or block:
            if drop or by_name:
                flush()
            if name == "main" and is_main and named[-1] >= 0:
                holds[named[-1]] += 1
            if by_name:
                around.append(named[-1])
                named.append(len(holds))
                holds.append(0)
            open_names.append((name, drop, is_main, named[-1] if by_name else -1))
            blocks.append(opened)
            opened += 1
            count[name] += 1
            dropped += drop
            main += is_main
            if drop or by_name or is_main:
                out.extend(GAP)
    flush()
    return _without(out, holds, around)


def _without(found: list[Line], holds: list[int], around: list[int]) -> list[Line]:
    """The lines outside named parts, but for parts that hold the page's own text. ``around`` names each part's outer one, which opened before it."""
    weight, inside, holds = [0] * len(holds), [0] * len(holds), list(holds)
    for line in found:
        if line.part >= 0:
            weight[line.part] += line.weight
            inside[line.part] += line.weight * line.main
    for part in range(len(holds) - 1, -1, -1):
        if (outer := around[part]) >= 0:
            weight[outer] += weight[part]
            inside[outer] += inside[part]
            holds[outer] += holds[part]
    total, in_main = sum(line.weight for line in found), sum(line.weight for line in found if line.main)
    taken = set()
    for part, mains in enumerate(holds):
        alone = in_main - inside[part] < SURGE
        own = mains or alone and (0 < in_main == inside[part] or 2 * weight[part] > total)
        if not own or around[part] in taken:
            taken.add(part)
    return [line for line in found if line.part not in taken] if taken else found


def extract(html: str | None) -> str:
    """The main text: blocks in page order, one per line."""
    found = lines(html or "")
    inner, at, n = [], 0, len(found)
    while at < n:
        if not found[at].text:
            at += 1
            continue
        end = at
        while end < n and any(line.text for line in found[end : end + WINDOW]):
            end += 1
        if found[at].main:
            inner.append((at, end))
        at = end
    weights = [line.weight for line in found]
    high = max((sum(weights[i : i + WINDOW]) for a, b in inner for i in range(a, b)), default=0)
    within = sum(sum(weights[a:b]) for a, b in inner)
    # Outside an article, a line of links alone is an empty one: regions end there too.
    outer = _by_weight([0 if line.main else line.weight for line in found])
    larger = any(r[2] >= SURGE and (high < SURGE or sum(weights[r[0] : r[1]]) > within) for r in outer)
    if inner and not larger:
        kept = inner
    else:
        surges = [r for r in outer if r[2] >= SURGE] or sorted(outer, key=lambda r: -r[2])[:1]
        kept = _joined(found, outer, surges)
        if high >= SURGE:
            kept = sorted(kept + inner)
    return "\n".join(line.text for a, b in kept for line in found[a:b] if line.text)


def _joined(found: list[Line], regions: list[tuple[int, int, int]], surges: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The surges, with short regions of the same parent: between two of them, or beside one where only parts taken out lie between."""
    kept = [r in surges for r in regions]
    around = [{b for line in found[r[0] : r[1]] if line.weight for b in line.blocks if b >= 0} for r in regions]
    for order in (range(1, len(regions)), range(len(regions) - 2, -1, -1)):
        step = order.step
        for k in order:
            near = k - step
            a, b = sorted((k, near))
            if kept[near] and around[k] & around[near] and not any(line.text for line in found[regions[a][1] : regions[b][0]]):
                kept[k] = True
    last: dict[int, int] = {}  # of every block the last surge
    first: dict[int, int] = {}
    for k, r in enumerate(regions):
        if r in surges:
            for b in around[k]:
                first.setdefault(b, k)
                last[b] = k
    for k in range(len(regions)):
        kept[k] |= any(first.get(b, k) < k < last.get(b, k) for b in around[k])
    return [r[:2] for r, keep in zip(regions, kept, strict=True) if keep]


def _by_weight(weights: list[int]) -> list[tuple[int, int, int]]:
    """First line, end and highest window of every region."""
    out, at, n = [], 0, len(weights)
    while at < n:
        if not weights[at]:
            at += 1
            continue
        end = last = at
        high = 0
        while end < n and (total := sum(weights[end : end + WINDOW])):
            high = max(high, total)
            if weights[end]:
                last = end
            end += 1
        out.append((at, last + 1, high))
        at = end
    return out


def main_text(df: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, the main text and its code points of every page."""

    def row(html):
        text = extract(html)
        return text, len(text)

    return map_rows(df, [html_col], "text string, n_chars long", lambda: row, keep)
