"""Column functions that read fields out of raw HTML text.

A page is a string column; these helpers are regular-expression
extractions that Spark evaluates per row inside codegen, so a table of
pages is processed like any other table (no parser object per row).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import lru_cache
from html.entities import name2codepoint

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hestia.functions.text import ColumnOrName, _c

#: Named character references of HTML 4 (the standard library's table).
ENTITIES = {name: chr(code) for name, code in sorted(name2codepoint.items())} | {"apos": "'"}
_REFERENCE = "&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _character(ref: Column) -> Column:
    """The character that a reference (without ``&`` and ``;``) stands for; unknown ones stay as they are."""
    digits = F.when(F.lower(F.left(ref, F.lit(2))) == "#x", F.conv(F.substr(ref, F.lit(3)), 16, 10)).when(
        F.left(ref, F.lit(1)) == "#", F.substr(ref, F.lit(2))
    )
    code = digits.try_cast("bigint")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    # One literal that Spark folds into a map.
    names = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in ENTITIES.items())), F.lit("\x01"), F.lit("\x02"))
    return F.coalesce(F.try_element_at(names, ref), numeric, F.concat(F.lit("&"), ref, F.lit(";")))


def unescape(col: ColumnOrName) -> Column:
    """Decode named, decimal and hexadecimal character references, each once.
    Text without ``&`` is passed through."""
    c = _c(col)

    def decoded(x: Column) -> Column:
        refs = F.transform(F.regexp_extract_all(x, F.lit(_REFERENCE), 1), _character)
        pieces = F.zip_with(F.split(x, _REFERENCE), refs, lambda p, r: F.concat(p, F.coalesce(r, F.lit(""))))
        return F.array_join(pieces, "")

    return F.when(c.contains("&"), _bound(c, decoded)).otherwise(c)


def empty_to_null(col: ColumnOrName) -> Column:
    """``''`` → null. (Spark 4 rewrites ``nullif`` with a shared common
    expression, so an expensive input is still evaluated once.)"""
    return F.nullif(_c(col), F.lit(""))


# Fixed value: the characters Python's ``str.strip()`` removes (every
# code point whose ``isspace()`` is true).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def py_strip(col: ColumnOrName) -> Column:
    """Strip leading/trailing Unicode whitespace (``str.strip`` semantics;
    Spark's one-argument ``trim`` removes only the space character).
    A character-set trim, no regular expression."""
    return F.btrim(_c(col), F.lit(PY_WHITESPACE))


def strip_tags(col: ColumnOrName, sep: str = "") -> Column:
    """Replace every tag by ``sep``; text without ``<`` skips the regex."""
    c = _c(col)
    return F.when(c.contains("<"), F.regexp_replace(c, "<[^>]*>", sep)).otherwise(c)


# Fixed value: an attribute's value, quoted either way or bare.
_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _unquoted(value: Column) -> Column:
    first = F.left(value, F.lit(1))
    return F.when((first == '"') | (first == "'"), F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def _open_tag(tag: str, cls: str | None = None, id_: str | None = None, having: str | None = None) -> str:
    """Opening-tag pattern without groups. Tag and attribute names ignore
    case; class values do not (HTML), and a class matches as a whole token."""
    attrs = ""
    if cls:
        token = re.escape(cls)
        attrs = (
            r"""[^>]*\s(?i:class)\s*=\s*(?:"(?:[^"]*\s)?%s(?:\s[^"]*)?"|'(?:[^']*\s)?%s(?:\s[^']*)?'|%s(?=[\s>]))"""
            % (token, token, token)
        )
    elif id_:
        token = re.escape(id_)
        attrs = r"""[^>]*\s(?i:id)\s*=\s*(?:"%s"|'%s'|%s(?=[\s>]))""" % (token, token, token)
    if having:
        attrs = r"(?=[^>]*\s(?i:%s)\s*=)" % re.escape(having) + attrs
    return r"(?i:<%s)(?=[\s/>])%s[^>]*>" % (tag, attrs)


def _to_own_end(rest: Column, marks: Column | str) -> Column:
    """``rest`` (what follows an opening tag) up to the closing tag that
    balances it; all of it where none does. ``marks`` is the pattern of the
    tags of that name, opening and closing."""
    pattern = F.lit(marks) if isinstance(marks, str) else marks
    found = F.regexp_extract_all(rest, pattern, F.lit(0))
    gaps = F.transform(F.split(rest, pattern), F.length)
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("end"))

    def step(acc: Column, x: Column) -> Column:
        depth = acc["depth"] + F.when(x["mark"].startswith("</"), -1).otherwise(1)
        at = acc["at"] + x["gap"]
        ends = (acc["end"] < 0) & (depth == 0)
        return F.struct(depth.alias("depth"), (at + F.length(x["mark"])).alias("at"), F.when(ends, at).otherwise(acc["end"]).alias("end"))

    pairs = _bound(found, lambda f: F.arrays_zip(F.slice(gaps, 1, F.size(f)).alias("gap"), f.alias("mark")))
    end = F.aggregate(pairs, start, step, lambda acc: acc["end"])
    return _bound(end, lambda e: F.when(e < 0, rest).otherwise(F.left(rest, e)))


def _first_close(tag: str) -> str:
    """Group of the text up to the first closing tag: one possessive, linear scan."""
    return r"([^<]*+(?:<(?!(?i:/%s\s*>))[^<]*+)*+)" % tag


def _holds(x: Column, tag: str) -> Column:
    """Whether an element of that name starts in ``x``."""
    return x.contains("<") & x.rlike(r"(?i)<%s[\s/>]" % tag)


def _marks(tag: str) -> str:
    return r"(?i)</?%s(?=[\s/>])[^>]*>" % tag


def element_html(col: ColumnOrName, tag: str, cls: str | None = None, id_: str | None = None) -> Column:
    """Inner HTML of the first ``<tag>`` (with class/id) up to its own closing
    tag (the page's end if it has none); null when absent or empty.

    One scan of the page finds the text up to the first closing tag; only
    where that holds another element of the same name are tags counted."""
    c = _c(col)
    opener = _open_tag(tag, cls, id_)
    first = F.regexp_extract(c, opener + _first_close(tag), 1)
    counted = _bound(F.regexp_extract(c, opener + "((?s:.*))", 1), lambda r: _to_own_end(r, _marks(tag)))
    found = _bound(first, lambda x: F.when(_holds(x, tag), counted).when(x != "", x))
    literal = cls or id_
    # A page without the class (or id) literal cannot hold the element:
    # a byte search skips the regex scan of the whole page.
    return F.when(c.contains(literal), found) if literal else found


# A tag (closing mark, name, attributes), any markup, a reference, and a class attribute.
_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)(?=[\s/>])([^>]*)>")
_MARKUP, _ANY_REFERENCE = re.compile("<[^>]*>"), re.compile(_REFERENCE)
_CLASS = re.compile(r"""\s(?i:class)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


#: Attributes up to this length are kept in a cache; pages of a site repeat their templates'.
_CACHED_LENGTH = 256
_NO_CLASS: frozenset[str] = frozenset()


def _classes(attributes: str) -> frozenset[str]:
    """The classes that an opening tag's attributes name."""
    return frozenset(x for c in _CLASS.findall(attributes) for x in (c[0] or c[1] or c[2]).split())


_cached_classes = lru_cache(maxsize=4096)(_classes)


def page_elements(html: str) -> list[list]:
    """Every element of a page in the order of their opening tags: name in lower case, classes, and where its content begins and ends.

    One scan: a closing tag ends the last open element of its name; one that
    none awaits is passed over, and an element left open runs to the page's end.
    """
    found: list[list] = []
    waiting: dict[str, list[int]] = {}
    size = len(html)
    for m in _TAG.finditer(html):
        closing, name, attributes = m.groups()
        name = name.lower()
        if closing:
            if stack := waiting.get(name):
                found[stack.pop()][3] = m.start()
            continue
        classes = (_cached_classes if len(attributes) <= _CACHED_LENGTH else _classes)(attributes) if attributes else _NO_CLASS
        if name in waiting:
            waiting[name].append(len(found))
        else:
            waiting[name] = [len(found)]
        found.append([name, classes, m.end(), size])
    return found


def _content(html: str, elements: list[list], path: Sequence[tuple[str | None, str | None]]) -> str | None:
    """Inner HTML of the first element of the path's last step within the first one of the steps before; null if there is none or it is empty."""
    begin, end = 0, len(html)
    for tag, cls in path:
        for name, classes, a, b in elements:
            if begin < a <= end and (tag is None or name == tag) and (cls is None or cls in classes):
                begin, end = a, min(b, end)
                break
        else:
            return None
    return html[begin:end] or None


def _decoded(m: re.Match) -> str:
    """What ``_character`` does, for one match of ``_REFERENCE``."""
    ref = m[1]
    if ref[0] != "#":
        return ENTITIES.get(ref, m[0])
    code = int(ref[2:], 16) if ref[1] in "xX" else int(ref[1:]) if len(ref) < 20 else 0
    return chr(code) if 1 <= code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else m[0]


def _finished(inner: str | None) -> str | None:
    """What ``finish_text`` does, for one value."""
    if inner and "<" in inner:
        inner = _MARKUP.sub("", inner)
    if inner and "&" in inner:
        inner = _ANY_REFERENCE.sub(_decoded, inner)
    return (inner.strip() or None) if inner else None


def element_fields(col: ColumnOrName, fields: Mapping[str, Sequence[tuple[str | None, str | None]]], text: bool = True) -> Column:
    """H2/H3 for many fields at once: a struct of each one's visible text (as ``finish_text`` gives it; or, without
    ``text``, its inner HTML), read from one scan of the page.

    A field is a path of (tag, class), each within the one before; a tag or
    class of ``None`` is any. Null where an element is absent or empty, and in
    all fields of a null page.
    """
    paths = {name: [(t.lower() if t else None, c) for t, c in path] for name, path in fields.items()}

    @F.arrow_udf(StructType([StructField(name, StringType()) for name in paths]))
    def read(pages: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([x.cast(pa.string()) for x in read_fields(pages, list(paths.values()), text)], list(paths))

    return read(_c(col))


def _tag_of(raw: str) -> tuple[int, str, frozenset[str]]:
    """Of the text from ``<`` to the next ``>``: 1 for an opening tag, -1 for a closing one, 0 for none; its name in lower case and its classes."""
    m = _TAG.fullmatch(raw)
    if not m:
        return 0, "", _NO_CLASS
    closing, name, attributes = m.groups()
    if closing or not attributes:
        return -1 if closing else 1, name.lower(), _NO_CLASS
    return 1, name.lower(), (_cached_classes if len(attributes) <= _CACHED_LENGTH else _classes)(attributes)


def _ranges(pages: pa.Array, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of a text array's buffer in ranges that follow one another, as an array of its type."""
    if not len(begin):
        return pa.array([], pages.type)
    width = np.int64 if pa.types.is_large_string(pages.type) else np.int32
    borders = np.stack([begin, end], 1).ravel().astype(width)  # each range, and the gap to the next
    both = pa.Array.from_buffers(pages.type, len(borders) - 1, [None, pa.py_buffer(borders), pages.buffers()[2]])
    return both.take(pa.array(np.arange(0, len(borders) - 1, 2)))


#: Tags of an element's name that are looked at for its end, before its page is read by itself.
_LOOK_AHEAD = 64


def read_fields(pages: pa.Array, paths: Sequence[Sequence[tuple[str | None, str | None]]], text: bool = True) -> list[pa.Array]:
    """What ``_content`` (and ``_finished``) read in each page, path by path, for a whole batch.

    The tags of all pages are found at once and each different tag is parsed
    once; where an element begins and ends is then arithmetic on their places.
    Pages in which a ``<`` is not followed by ``>`` before the next ``<``, or an
    element holds many others of its name, are read one by one.
    """
    if pages.null_count:
        pages = pages.fill_null("")
    n = len(pages)
    width = np.int64 if pa.types.is_large_string(pages.type) else np.int32
    at = np.frombuffer(pages.buffers()[1], width)[pages.offset : pages.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(pages.buffers()[2] or b"", np.uint8)[: at[-1]]
    lt = np.flatnonzero(data[at[0] :] == ord("<")) + at[0]
    gt = np.append(np.flatnonzero(data[at[0] :] == ord(">")) + at[0], at[-1])
    after = gt[np.searchsorted(gt, lt)] + 1  # where the tag ends, if it is one
    page = np.searchsorted(at, lt, "right") - 1
    alone = np.zeros(n, bool)
    alone[page[(after > at[page + 1]) | (after > np.append(lt[1:], at[-1] + 1))]] = True
    kept = ~alone[page]
    lt, after, page = lt[kept], after[kept], page[kept]

    tags = _ranges(pages, lt, after).dictionary_encode()
    which = tags.indices.to_numpy().astype(np.int64)
    parsed = [_tag_of(raw) for raw in tags.dictionary.to_pylist()]
    kinds = np.array([kind for kind, _, _ in parsed], np.int64)
    numbers: dict[str, int] = {}
    names = np.array([numbers.setdefault(name, len(numbers)) for _, name, _ in parsed], np.int64)
    real = kinds[which] != 0
    lt, after, page, which = lt[real], after[real], page[real], which[real]

    # The tags of each name one after the other, in the order of the pages, with the depth that each leads to.
    name = names[which]
    order = np.argsort(name, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    depth = np.cumsum(kinds[which][order])

    def ends(tag: np.ndarray) -> np.ndarray:
        """Where the elements that these tags open end: at the first tag of their name that leads to a lesser depth, or with the page."""
        end = at[page[tag] + 1].copy()
        todo, here = np.arange(len(tag)), place[tag]
        there = here + 1
        for _ in range(_LOOK_AHEAD):
            inside = there < len(order)
            inside[inside] = (name[order[there[inside]]] == name[tag[todo[inside]]]) & (page[order[there[inside]]] == page[tag[todo[inside]]])
            todo, here, there = todo[inside], here[inside], there[inside]
            deeper = depth[there] - depth[here]
            end[todo[deeper < 0]] = lt[order[there[deeper < 0]]]
            todo, here, there = todo[deeper >= 0], here[deeper >= 0], (there + deeper + 1)[deeper >= 0]
            if not len(todo):
                break
        alone[page[tag[todo]]] = True
        return end

    found = []
    for path in paths:
        begin, end, live = at[:-1].copy(), at[1:].copy(), np.arange(n)
        for tag, cls in path:
            fits = np.array([kind == 1 and (tag is None or x == tag) and (cls is None or cls in classes) for kind, x, classes in parsed], bool)
            opening = np.flatnonzero(fits[which])
            first = np.searchsorted(after[opening], begin[live], "right")
            live, first = live[first < len(opening)], opening[first[first < len(opening)]]
            live, first = live[after[first] <= end[live]], first[after[first] <= end[live]]
            begin[live], end[live] = after[first], np.minimum(ends(first), end[live])
        live = live[begin[live] < end[live]]
        rank = np.full(n, -1)
        rank[live] = np.arange(len(live))
        values = _ranges(pages, begin[live], end[live]).take(pa.array(rank, mask=rank < 0))
        found.append(_finished_all(values) if text else values)

    if alone.any():
        rows = []
        for html in pages.filter(pa.array(alone)).to_pylist():
            elements = page_elements(html)
            each = [_content(html, elements, path) if elements else None for path in paths]
            rows.append([_finished(x) for x in each] if text else each)
        found = [pc.replace_with_mask(x, pa.array(alone), pa.array(list(own), x.type)) for x, own in zip(found, zip(*rows))]
    return found


def _finished_all(values: pa.Array) -> pa.Array:
    """``_finished`` of each value."""
    if pc.any(pc.match_substring(values, "<")).as_py():
        values = pc.replace_substring_regex(values, "<[^>]*>", "")
    coded = pc.match_substring(values, "&").fill_null(False)
    if pc.any(coded).as_py():
        plain = [_ANY_REFERENCE.sub(_decoded, x) for x in values.filter(coded).to_pylist()]
        values = pc.replace_with_mask(values, coded, pa.array(plain, values.type))
    values = pc.utf8_trim(values, characters=PY_WHITESPACE)
    return pc.if_else(pc.equal(pc.binary_length(values), 0), pa.scalar(None, values.type), values)


def any_element_html(col: ColumnOrName, cls: str) -> Column:
    """Inner HTML of the first element with the class, whatever its tag."""
    c = _c(col)
    opener = _open_tag(r"(\w+)", cls)
    first = F.regexp_extract(c, opener + r"([^<]*+(?:<(?!(?i:/\1\s*>))[^<]*+)*+)", 2)
    rest = F.regexp_extract(c, opener + "((?s:.*))", 2)
    marks = F.concat(F.lit("(?i)</?"), F.regexp_extract(c, opener, 1), F.lit(r"(?=[\s/>])[^>]*>"))
    counted = _bound(rest, lambda r: _bound(marks, lambda m: _to_own_end(r, m)))
    return F.when(c.contains(cls), _bound(first, lambda x: F.when(x.contains("<"), counted).when(x != "", x)))


def finish_text(inner: ColumnOrName) -> Column:
    """Tags removed, entities decoded, stripped; empty → null."""
    return empty_to_null(py_strip(unescape(strip_tags(inner))))


def element_text(col: ColumnOrName, tag: str, cls: str | None = None, id_: str | None = None) -> Column:
    """H2: stripped visible text of the first matching element, null if
    absent or empty."""
    return finish_text(element_html(col, tag, cls, id_))


def nested_html(col: ColumnOrName, outer: tuple[str, str | None], inner: tuple[str, str | None]) -> Column:
    """Inner HTML of the first ``inner`` element inside the first ``outer`` one."""
    return _bound(element_html(col, *outer), lambda o: element_html(o, *inner))


def nested_text(col: ColumnOrName, outer: tuple[str, str | None], inner: tuple[str, str | None]) -> Column:
    """H3: text of an element inside another (``dpe-diagram`` → ``selected``)."""
    return finish_text(nested_html(col, outer, inner))


def page_text(col: ColumnOrName, sep: str = " | ") -> Column:
    """H4: visible text pieces, each stripped, empty ones dropped, joined
    with ``sep`` (``get_text(separator=sep, strip=True)`` semantics).

    Scripts, styles and comments are dropped; every tag becomes a one-
    character boundary; the pieces between boundaries are split without a
    regex (single-character separator), stripped, filtered and joined.
    """
    c = F.regexp_replace(_c(col), r"(?is)<script\b.*?</script\s*>", "\u0001")
    c = F.regexp_replace(c, r"(?is)<style\b.*?</style\s*>", "\u0001")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "\u0001")
    c = F.regexp_replace(c, r"<[^>]*>", "\u0001")
    pieces = F.transform(F.split(unescape(c), "\u0001"), lambda x: py_strip(x))
    return F.array_join(F.filter(pieces, lambda x: F.length(x) > 0), sep)


def attr(
    col: ColumnOrName, tag: str, name: str, default: str | None = None, cls: str | None = None, having: str | None = None
) -> Column:
    """H5: value of attribute ``name`` of the first ``<tag>`` (of class ``cls``,
    carrying the attribute ``having``); null, or ``default``, where that tag
    lacks it."""
    opening = F.regexp_extract(_c(col), _open_tag(tag, cls, having=having), 0)
    value = F.regexp_extract(opening, r"(?i)\s%s\s*=\s*%s" % (re.escape(name), _VALUE), 1)
    found = _bound(value, lambda v: F.when(v != "", unescape(_unquoted(v))))
    return F.coalesce(found, F.lit(default)) if default is not None else found


def hrefs(col: ColumnOrName, container: tuple[str, str | None] | None = None) -> Column:
    """All ``href`` values of ``<a>`` tags, in page order, of the whole page
    or of the first ``container`` element (tag, class)."""
    c = element_fields(col, {"list": [container]}, text=False)["list"] if container else _c(col)
    values = F.regexp_extract_all(c, F.lit(r"(?i)<a(?=\s)[^>]*\shref\s*=\s*" + _VALUE), 1)
    return F.transform(values, lambda v: unescape(_unquoted(v)))


def links_with_prefix(col: ColumnOrName, prefix: str) -> Column:
    """H6: hrefs that start with ``prefix``."""
    return F.filter(hrefs(col), lambda h: h.startswith(prefix))


def links_containing(col: ColumnOrName, needle: str, container: tuple[str, str | None] | None = None) -> Column:
    """H6: hrefs that hold ``needle``, of a container element if one is given."""
    return F.filter(hrefs(col, container), lambda h: h.contains(needle))


def first_nonempty(*cols: ColumnOrName) -> Column:
    """H7: first candidate that is neither null nor empty."""
    return F.coalesce(*[empty_to_null(F.trim(_c(c))) for c in cols])


def blocks(col: ColumnOrName, tag: str, cls: str | None = None, keep_open: bool = False) -> Column:
    """H1 (array form): one string per ``<tag>`` block, in page order.

    ``keep_open=False``: the inner HTML, from the opening tag to the next
    opening tag of the same kind or its closing tag, whichever is first, so
    unclosed ``<p>`` still yields one block per opening tag.

    ``keep_open=True`` (cards with nested elements): the block keeps its
    opening tag (and so its attributes) and runs to its own closing tag (or,
    unclosed, to the next opening tag of the same kind/class or the end of
    the page).

    Both are unrolled loops: non-``<`` runs are consumed possessively and
    the stop test only runs at ``<`` characters.
    """
    opener = _open_tag(tag, cls)
    if keep_open:
        pattern = "(%s[^<]*+(?:(?!%s)<[^<]*+)*+)" % (opener, opener)
        found = F.regexp_extract_all(_c(col), F.lit(pattern), 1)
        size = lambda x: F.length(F.regexp_extract(x, "^<[^>]*>", 0))
        cut = lambda x, n: F.concat(F.left(x, n), _bound(F.substr(x, n + 1), lambda r: _to_own_end(r, _marks(tag))))
        return F.transform(found, lambda x: _bound(size(x), lambda n: cut(x, n)))
    else:
        stop = r"(?i:%s\b|/%s>)" % (tag, tag)
        pattern = "%s([^<]*+(?:<(?!%s)[^<]*+)*+)" % (opener, stop)
    return F.regexp_extract_all(_c(col), F.lit(pattern), 1)
