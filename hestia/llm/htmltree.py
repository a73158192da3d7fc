"""Main text of web pages by scoring their element tree.

Every paragraph, and text of any other block that stands in no block inside
it, gives points, for its commas and its length, to its parent,
half of them to the next ancestor, a third to the one after, and so on; an
element's points are discounted by the share of its text that stands in links.
The best container and those of its siblings that look like it are kept. What
is named as a menu, header, footer, side bar, notice, advert, form or reader
comments (by element, role, class or id) takes no part. But where next to nothing is
left without it, a form or an element so named by role, class or id holds the
article, and is read as if it had no such name.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Element names by what they mean here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe xmp svg math".split())
DROPPED = set("head nav footer aside button select option iframe noscript script style template textarea title svg math menu dialog object video audio canvas".split())
BLOCKS = set(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"br"}
PARAGRAPHS = set("p pre blockquote td li dd".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Blocks whose own text gives its points to themselves; other blocks give them to their parent, as paragraphs do.
CONTAINERS = set("div section article main body center".split()) | {"#root"}
#: Start tags that end an open element of these names.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: An open element of these names isn't left by the start tags above.
BARRIERS = set("ul ol dl table article section div body main blockquote".split())
# Parts of class and id names, and roles, that name what isn't the article.
NAMES = set(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promotion banner banners cookie cookies consent gdpr notice notices alert "
    "newsletter subscribe subscription signup popup popups modal overlay sidebar sidebars aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs "
    "masthead footer comment comments commentlist disqus respond reply replies related recommended recommendations share sharing social pagination pager login search toolbar".split()
)
HEADER_NAMES = {"header"}
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NEGATIONS = {"with", "has", "no", "without", "hide", "show"}
#: Those of the names that mean reader comments and notices to the reader, which may be longer than the article.
LONG = set("comment comments commentlist disqus respond reply replies cookie cookies consent gdpr".split())
#: What is left outside an article or main element is next to nothing if it has less than this share of the text of an element left out.
LITTLE = 0.1

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_PART = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Element:
    __slots__ = ("name", "parent", "children", "points", "attrs", "length", "linked", "links", "chars", "commas")

    def __init__(self, name: str, parent: Element | None, attrs: dict[str, str]):
        self.name, self.parent, self.attrs = name, parent, attrs
        self.children: list[Element | str] = []
        self.points, self.length, self.linked = 0.0, 0, 0
        self.links, self.chars, self.commas = 0, 0, 0


def parsed(source: str) -> Element:
    """The element tree; elements left open end where their parent does, end tags of nothing open are skipped."""
    root = at = Element("#root", None, {})
    place, n = 0, len(source)
    opened: Counter[str] = Counter()  # so that nothing is looked for in vain on the way to the root

    def leave(up: Element) -> Element:
        """Closes all up to and with ``up``; what is open then."""
        x = at
        while x is not up.parent:
            opened[x.name] -= 1
            x = x.parent
        return x

    while place < n:
        m = _TAG.search(source, place)
        if not m:
            break
        if m.start() > place:
            at.children.append(source[place : m.start()])
        place = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if opened[name]:
                up = at
                while up.name != name:
                    up = up.parent
                at = leave(up)
            continue
        if name in CLOSES_P or name in ENDS:
            ends = ENDS.get(name, set()) | ({"p"} if name in CLOSES_P else set())
            if any(opened[x] for x in ends):
                up = at
                while up.parent is not None and up.name not in ends and up.name not in BARRIERS:
                    up = up.parent
                if up.parent is not None and up.name in ends:
                    at = leave(up)
        attrs = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTR.findall(m[3])} if m[3] else {}
        child = Element(name, at, attrs)
        at.children.append(child)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, place)
            place = end.end() if end else n
        elif name not in VOID and not m[3].endswith("/"):
            at = child
            opened[name] += 1
    if place < n:
        at.children.append(source[place:])
    return root


def named(attrs: dict[str, str], names: set[str]) -> bool:
    """Whether class or id says so: a token whose first or last part is one of ``names``."""
    for token in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        parts = [p.lower() for p in _PART.split(token) if p]
        if parts and (parts[0] in names or parts[-1] in names) and not NEGATIONS & set(parts):
            return True
    return False


def dropped(e: Element, within: bool) -> bool:
    """Whether the element takes no part, whatever it holds. ``within``: it is inside an article or main element."""
    if e.name in DROPPED or e.name == "header" and not within:
        return True
    a = e.attrs
    if not a or e.name in ("html", "body", "main"):
        return False
    return "hidden" in a or a.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(a.get("style", "")))


def suspect(e: Element, within: bool) -> bool:
    """Whether the element takes no part unless the article turns out to stand in it."""
    if e.name == "form":
        return True
    a = e.attrs
    if not a or e.name in ("html", "body", "main"):
        return False
    return a.get("role", "").lower() in ROLES or named(a, NAMES) or not within and named(a, HEADER_NAMES)


def prose(root: Element) -> dict[Element, int]:
    """Characters of each element's text outside links and what takes no part in any case."""
    order = [root]
    for x in order:
        order += [c for c in x.children if isinstance(c, Element) and c.name != "a" and not dropped(c, True)]
    found: dict[Element, int] = {}
    for x in reversed(order):
        found[x] = sum(len(c.strip()) if isinstance(c, str) else found.get(c, 0) for c in x.children)
    return found


def lifted(root: Element) -> set[Element]:
    """The suspect elements that are read all the same, since they hold the article.

    First none. Where then nothing is left, or too little outside any article
    or main element, that with the most text of the suspect elements is read
    (``LONG`` ones only where nothing is left; where an article or main element
    stands, only those in it), with the suspect elements in it weighed in the
    same way, and so on.
    """
    free: set[Element] = set()
    sizes = prose(root)
    at = (root, False)
    while True:
        left, inside, stands, out = 0, 0, False, []
        todo = [at]
        while todo:
            x, within = todo.pop()
            within = within or x.name in ("article", "main")
            stands = stands or within
            for c in x.children:
                if isinstance(c, str):
                    n = len(c.strip())
                    left += n
                    inside += n if within else 0
                elif dropped(c, within):
                    continue
                elif suspect(c, within):
                    out.append((c, within))
                else:
                    todo.append((c, within))
        if inside:
            return free
        held = [(x, within) for x, within in out if (within or not stands) and (not left or not named(x.attrs, LONG))]
        at = max(held, key=lambda x: sizes.get(x[0], 0), default=(root, False))
        if not held or left >= LITTLE * sizes.get(at[0], 0):
            return free
        free.add(at[0])


def pruned(e: Element) -> None:
    """Takes out what takes no part and counts text and linked text. Of a header inside the article, headings stay."""
    free = lifted(e)
    todo = [(e, False, False)]
    order: list[Element] = []
    while todo:  # without recursion: pages nest as deep as they like
        x, within, header = todo.pop()
        order.append(x)
        kept: list[Element | str] = []
        for c in x.children:
            if isinstance(c, str):
                if not header:
                    kept.append(html.unescape(c) if "&" in c else c)
            elif c in free or not dropped(c, within) and not suspect(c, within):
                kept.append(c)
                in_header = header or within and c not in free and (c.name == "header" or named(c.attrs, HEADER_NAMES))
                todo.append((c, within or c.name in ("article", "main"), in_header and c.name not in HEADINGS))
        x.children = kept
    for x in reversed(order):
        for c in x.children:
            if isinstance(c, str):
                x.length += len(c.strip())
                x.chars += len(c)
                x.commas += c.count(",")
            else:
                x.length += c.length
                x.linked += c.length if c.name == "a" else c.linked
                x.links += c.links + (c.name == "a")
                x.chars += c.chars
                x.commas += c.commas


def density(e: Element) -> float:
    """Share of the element's text that stands in links."""
    return e.linked / e.length if e.length else 0.0


def elements(e: Element) -> Iterator[Element]:
    todo = [e]
    while todo:
        x = todo.pop()
        yield x
        todo += [c for c in reversed(x.children) if isinstance(c, Element)]


def loose(e: Element) -> str:
    """The element's text that stands in no block inside it."""
    out: list[str] = []
    todo: list[Element | str] = list(reversed(e.children))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.name not in BLOCKS:
            todo += reversed(x.children)
        else:
            out.append(" ")
    return "".join(out)


def scored(root: Element) -> Element | None:
    """The best container; where nothing has points, the first article, main or body element with text, or else None."""
    for x in elements(root):
        if not x.length or x.name in HEADINGS or x.name not in BLOCKS and x.name != "#root":
            continue
        chars, commas = x.chars, x.commas
        if x.name not in PARAGRAPHS:
            text = loose(x)
            if not text.strip():
                continue
            chars, commas = len(text), text.count(",")
        plain = x.name in CONTAINERS
        points = (1 + commas + min(chars / 100, 3)) * (1 - density(x))
        up, level = (x if plain else x.parent), 1
        while up is not None and level < 6:
            up.points += points / level
            up, level = up.parent, level + 1
    best, top = None, 0.0
    for x in elements(root):
        if x.points * (1 - density(x)) > top:
            best, top = x, x.points * (1 - density(x))
    if best is None:
        for name in ("article", "main", "body"):
            for x in elements(root):
                if x.name == name and x.length:
                    return x
    return best


def chosen(best: Element) -> list[Element]:
    """The container, widened to the article or main element around it, or else with the siblings to keep."""
    up = best
    while up is not None:
        if up.name in ("article", "main") and up.length:
            best = up
            break
        up = up.parent
    else:
        # Wrappers that hold little beyond links would have been left out by now.
        while best.parent is not None and best.parent.name not in ("body", "html", "#root") and density(best.parent) < 0.25:
            best = best.parent
    if best.parent is None:
        return [best]
    least = 0.2 * best.points * (1 - density(best))

    def alike(x: Element) -> bool:
        if x is best:
            return True
        if not x.length or density(x) > 0.3:
            return False
        return x.points * (1 - density(x)) >= least or best.name not in ("article", "main") and (x.name in HEADINGS or x.name in PARAGRAPHS)

    return [x for x in best.parent.children if isinstance(x, Element) and alike(x)]


def blocks(roots: list[Element], best: Element | None = None) -> list[str]:
    """The text of each block, in page order, white space as one space.

    Lists of links are left out, but not inside an article or main element or the best container.
    """
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    todo: list[Element | str | None] = list(reversed(roots))
    inside = 0  # blocks left to end in which lists of links stay
    ends: list[int] = []
    while todo:
        x = todo.pop()
        while ends and len(todo) < ends[-1]:
            ends.pop()
            inside -= 1
        if x is None:
            flush()
        elif isinstance(x, str):
            held.append(x)
        elif not inside and not (x is best and x.name not in ("ul", "ol", "table", "dl")) and x.name in ("ul", "ol", "div", "table", "dl") and density(x) > 0.6 and x.links > 1:
            continue  # a list of links
        else:
            if x.name in BLOCKS:
                flush()
                todo.append(None)
            if x.name in ("article", "main") or x is best and x.name not in ("body", "html", "#root"):
                inside += 1
                ends.append(len(todo))
            todo += reversed(x.children)
    flush()
    return out


def main_text(source: str | None) -> str:
    """The main text of a page; empty for null, for an empty page and for one without text outside what is left out."""
    root = parsed(source or "")
    pruned(root)
    best = scored(root)
    return " ".join(blocks(chosen(best), best)) if best is not None else ""


def extract(pages: DataFrame, *, source: str = "html", keep: list[str]) -> DataFrame:
    """``keep``, ``text`` and ``n_chars`` for every row of ``pages``.

    A null page counts as empty and has the empty text; repeated rows are
    returned each; an empty table gives an empty one; other columns are not
    read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, pages_ = batch.columns
            texts = [main_text(t) for t in pages_.to_pylist()]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*rest, *made], names=[*batch.schema.names[:-1], "text", "n_chars"])

    rows = pages.select(*keep, F.col(source).alias("__source"))
    fields = StructType([*rows.schema.fields[:-1], *StructType.fromDDL("text string, n_chars long").fields])
    return rows.mapInArrow(run, fields)
