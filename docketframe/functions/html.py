"""Reading markup: the elements that selectors ask for, with their attributes and text, as a column.

``select`` is the one function here that runs outside the JVM, in Arrow batches: it cuts a page into tags and text in one
scan, finds where elements end by the usual rules for omitted and misplaced end tags (``END_RULES``), and looks up what
it is asked for. What to ask is data, one value per row, so it can come from a joined table. What pages of a layout hold
is worked out from the elements by Spark expressions (``operators.layouts``).

Pages of which the same is asked are looked up together, the tags of all in arrays (``Tags``); pages that leave out or
misplace end tags are looked up one by one (``Page``). Both give the same.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html import unescape
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Parts the text nodes of an element; a noncharacter, never part of text.
GAP = "﷒"
#: What starts a name in any case, with the letters that fold to those of ASCII.
_LETTER = "a-zA-Z\u0130\u0131\u017f\u212a"
_UNSEEN = "|".join(rf"(?i:{name})(?=[\s/>])[^>]*>.*?(?:</(?i:{name})\s*>|\Z)" for name in "script style template rt rp".split())
# The one group is the inside of a tag with a name.
_TAG = re.compile(
    rf"""(?s)<(?:(?=[sStTrR\u017f])(?:{_UNSEEN})"""
    rf"""|(/?[{_LETTER}][^\s/>]*+[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)[^>=]*+)*+)>"""
    rf"""|!--.*?(?:-->|\Z)"""
    rf"""|[!?][^>]*>"""
    rf"""|(?=/?[{_LETTER}])[^<]*+\Z)"""  # a tag that the page breaks off in
)
_NAME = re.compile(rf"/?[{_LETTER}][^\s/>]*+")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_COMPOUND = re.compile(r"(?:[\w-]+|\*)?(?:[#.][\w-]+|\[[\w-]+(?:=(?:\"[^\"]*\"|'[^']*'|[\w-]+))?\])*")
_TEST = re.compile(r"([#.])([\w-]+)|\[([\w-]+)(?:=(\"[^\"]*\"|'[^']*'|[\w-]+))?\]")

# Fixed values of HTML: elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Fixed values of HTML: starts that end an open paragraph.
PARAGRAPH_ENDERS = (
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul"
).split()
# Fixed values of HTML: what the start of an element ends, each unless an element of the second group was opened since.
_CELLS, _SECTIONS = ("td", "th"), ("tbody", "thead", "tfoot")
END_RULES: dict[str, list[tuple[tuple[str, ...], tuple[str, ...]]]] = {
    "li": [(("li",), ("ul", "ol", "menu", "table"))],
    "dt": [(("dt", "dd"), ("dl", "table"))],
    "dd": [(("dt", "dd"), ("dl", "table"))],
    "td": [(_CELLS, ("tr", "table"))],
    "th": [(_CELLS, ("tr", "table"))],
    "tr": [(("tr",), ("table",)), (_CELLS, ("table",))],
    "tbody": [(_SECTIONS, ("table",)), (("tr",), ("table",)), (_CELLS, ("table",))],
    "thead": [(_SECTIONS, ("table",))],
    "tfoot": [(_SECTIONS, ("table",)), (("tr",), ("table",)), (_CELLS, ("table",))],
    "option": [(("option",), ("select",))],
}
for _name in PARAGRAPH_ENDERS:
    END_RULES.setdefault(_name, []).append((("p",), (*_CELLS, "table", "caption", "object", "button")))
# Fixed values of HTML: what an end tag does not reach over.
_BARS = ("table", *_CELLS, "caption", "object")
_OWN_BARS: dict[str, tuple[str, ...]] = {
    "html": (), "body": (), "table": (), "li": ("ul", "ol", "menu", *_BARS), "dt": ("dl", *_BARS), "dd": ("dl", *_BARS),
    **dict.fromkeys(("tr", "caption", *_CELLS, *_SECTIONS), ("table",)), "object": (*_CELLS, "table"),
}

#: A compound: a tag name ('' for any) and the marks it asks for. A chain: compounds from the outermost in.
Compound = tuple[str, list[str]]


def compile_selector(selector: str) -> list[list[Compound]]:
    """Tag, ``#id``, ``.class``, ``[attr]``, ``[attr=value]``, descendants and comma groups: one chain per group."""
    chains = []
    for group in selector.split(","):
        compounds = group.split()
        if not compounds or not all(_COMPOUND.fullmatch(compound) for compound in compounds):
            raise ValueError(f"unsupported selector {selector!r}")
        chains.append([_compound(compound) for compound in compounds])
    return chains


def _compound(text: str) -> Compound:
    marks = []
    for mark, name, attribute, value in _TEST.findall(text):
        if mark:
            marks.append(mark + name)
        else:
            marks.append(f"[{attribute.lower()}" + (f"={value.strip(chr(34) + chr(39))}" if value else ""))
    return re.match(r"[\w-]*", text).group().lower(), marks


#: The same without the element itself, which an end tag does reach.
_REACH = {own: tuple(bar for bar in bars if bar != own) for own, bars in _OWN_BARS.items()}


def element_stops(names: list[str]) -> list[int]:
    """For each tag of a page in order (``/name`` for end tags, '' for none), the place where its element ends.

    -1 for what starts no element; an element that cannot have content ends at its own place. One pass: the depths of
    open elements are kept by name.
    """
    stops = [-1] * len(names)
    opened_names: list[str] = []
    opened: list[int] = []
    depths: dict[str, list[int]] = defaultdict(list)

    def last(group: tuple[str, ...]) -> int:
        deepest = -1
        for name in group:
            if name in depths and (own := depths[name]) and own[-1] > deepest:
                deepest = own[-1]
        return deepest

    def close(depth: int, at: int) -> None:
        while len(opened) > depth:
            depths[opened_names.pop()].pop()
            stops[opened.pop()] = at

    for at, name in enumerate(names):
        if not name:
            continue
        if name[0] == "/":
            own = name[1:]
            if opened and opened_names[-1] == own:  # the usual case
                depths[opened_names.pop()].pop()
                stops[opened.pop()] = at
                continue
            depth = last((own,))
            if depth >= 0 and depth > last(_REACH.get(own, _BARS)):
                close(depth, at)
            continue
        if name in END_RULES:
            for group, shields in END_RULES[name]:
                depth = last(group)
                if depth >= 0 and depth > last(shields):
                    close(depth, at)
        if name in VOID:
            stops[at] = at
        else:
            depths[name].append(len(opened))
            opened_names.append(name)
            opened.append(at)
    close(0, len(names))
    return stops


@lru_cache(maxsize=4096)
def _attributes(raw: str) -> tuple[list[tuple[str, str]], frozenset[str]]:
    """Attributes as written in a tag, and the marks its element can be asked for."""
    values: dict[str, str] = {}
    for name, quoted, single, bare in _ATTRIBUTE.findall(raw) if raw else ():
        values.setdefault(name.lower(), unescape(quoted or single or bare))
    marks = {f"[{name}" for name in values} | {f"[{name}={value}" for name, value in values.items()}
    marks |= {f".{word}" for word in values.get("class", "").split()} | {f"#{value}" for value in [values.get("id")] if value}
    return list(values.items()), frozenset(marks)


#: Attributes longer than this are not remembered from tag to tag.
REMEMBERED = 256


@lru_cache(maxsize=4096)
def _named(tag: str | None) -> tuple[str, str]:
    """The name of a tag and its attributes as written; '' for what is no tag."""
    if not tag:
        return "", ""
    end = _NAME.match(tag).end()
    return tag[:end].lower(), tag[end:]


def _name(tag: str | None) -> tuple[str, str]:
    return _named(tag) if not tag or len(tag) <= REMEMBERED else _named.__wrapped__(tag)


def _own(raw: str) -> tuple[list[tuple[str, str]], frozenset[str]]:
    return _attributes(raw) if len(raw) <= REMEMBERED else _attributes.__wrapped__(raw)


class Page:
    """The tags of a page and the text behind each."""

    def __init__(self, texts: list[str], tags: list[str | None]):
        self.texts = texts
        named = [_name(tag) for tag in tags]
        self.names = ["", *[name for name, _ in named]]
        self.raw = ["", *[raw for _, raw in named]]
        self.stops = element_stops(self.names)
        #: Places of elements, of all under ''.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.places[""] = [at for at, stop in enumerate(self.stops) if stop >= 0]
        for at in self.places[""]:
            self.places[self.names[at]].append(at)

    def attributes(self, at: int) -> tuple[list[tuple[str, str]], frozenset[str]]:
        """The attributes of an element, and the marks it can be asked for."""
        return _own(self.raw[at])

    def find(self, chains: list[list[Compound]], first: int, stop: int) -> list[int]:
        """Places of the elements of a selector among the tags from ``first`` to before ``stop``, in page order."""
        found: list[int] = []
        for chain in chains:
            spans = [(first, stop)]
            for tag, marks in chain:
                places, hits, reached = self.places.get(tag), [], first
                if not places:
                    break
                for start, end in spans:
                    if start < reached:  # inside a span before it
                        continue
                    reached = max(start, end)
                    for at in places[bisect_left(places, start) : bisect_left(places, end)]:
                        if not marks or (self.raw[at] and self.attributes(at)[1].issuperset(marks)):
                            hits.append(at)
                spans = [(at + 1, self.stops[at]) for at in hits]
            else:
                found += hits
        return found if len(chains) == 1 else sorted(set(found))

    def text(self, at: int) -> str:
        """Text nodes of an element, parted by ``GAP``."""
        stop = self.stops[at]
        if stop == at + 1:  # the usual case
            return unescape(self.texts[at])
        return GAP.join([unescape(part) for part in self.texts[at:stop] if part])


def read_elements(html: str, asked: list) -> list[list[tuple]]:
    """For each (selector, selectors of parts): the elements with attributes, text (if no part is asked for) and parts."""
    pieces = _TAG.split(html)  # a text, then for each tag its inside and the text behind it
    return page_elements(Page(pieces[::2], pieces[1::2]), asked)


def page_elements(page: Page, asked: list) -> list[list[tuple]]:
    """:func:`read_elements` of a page that is cut."""
    whole, stops = len(page.names), page.stops
    found = []
    for chains, parts in asked:
        places = page.find(chains, 0, whole)
        # A part that is one compound is looked up in the page once; which of its places lie in an element is told by their order.
        known = [page.find(part, 0, whole) if places and all(len(chain) == 1 for chain in part) else None for part in parts]
        elements = []
        for at in places:
            first, stop, inner = at + 1, stops[at], []
            for part, everywhere in zip(parts, known):
                own = page.find(part, first, stop) if everywhere is None else everywhere[bisect_left(everywhere, first) : bisect_left(everywhere, stop)]
                inner.append([page.text(place) for place in own])
            elements.append((at, stop, page.attributes(at)[0], None if parts else page.text(at), inner))
        found.append(elements)
    return found


#: Elements within each other, from which on a page is looked up by itself.
DEEP = 256


class Tags:
    """The tags of several pages, one page after the other, for lookups in all of them at once.

    ``sound`` marks the pages whose every end tag ends what was opened last and where no start ends anything; there tags
    match like brackets. Others hold no elements here and are left to :class:`Page`.
    """

    def __init__(self, pages: list[str]):
        self.texts: list[str] = []
        self.tags: list[str | None] = []
        sizes = []
        for html in pages:
            pieces = _TAG.split(html)
            self.texts += pieces[::2]
            self.tags.append(None)  # stands before the first text
            self.tags += pieces[1::2]
            sizes.append(len(pieces) // 2 + 1)
        self.first = _starts(np.array(sizes, np.int64))
        self.page = np.repeat(np.arange(len(pages)), sizes)
        number = {tag: code for code, tag in enumerate(dict.fromkeys(self.tags))}
        self.codes = np.fromiter(map(number.__getitem__, self.tags), np.int64, len(self.tags))
        self.named = [_name(tag) for tag in number]
        self._match()

    def one(self, page: int) -> Page:
        start, stop = self.first[page], self.first[page + 1]
        return Page(self.texts[start:stop], self.tags[start + 1 : stop])

    def _match(self) -> None:
        names = {name: at for at, name in enumerate({name.removeprefix("/") for name, _ in self.named})}
        own = np.array([names[name.removeprefix("/")] for name, _ in self.named])[self.codes]
        kinds = [0 if not name or name in VOID else -1 if name[0] == "/" else 1 for name, _ in self.named]
        change, begin = np.array(kinds, np.int64)[self.codes], self.first[:-1]
        level = np.cumsum(change)
        base = level[begin]
        self.sound = (np.add.reduceat(change, begin) == 0) & (np.minimum.reduceat(level, begin) >= base) & (np.maximum.reduceat(level, begin) < base + DEEP)
        change = np.where(self.sound[self.page], change, 0)
        tags = np.flatnonzero(change)
        level = np.cumsum(change)[tags] + (change[tags] < 0)
        pairs = tags[np.argsort(level.astype(np.int16), kind="stable")]  # of a level, starts and ends take turns
        opened, closed = pairs[::2], pairs[1::2]
        self.sound[self.page[opened[own[opened] != own[closed]]]] = False
        change = np.where(self.sound[self.page], change, 0)
        for group, enders in self._rules().items():
            held = np.array([name.removeprefix("/") in group for name, _ in self.named])[self.codes] * change
            if held.any():
                ends = np.flatnonzero(np.array([name in enders for name, _ in self.named])[self.codes])
                self.sound[self.page[ends[(np.cumsum(held) - held)[ends] > 0]]] = False
        self.stops = np.full(len(self.codes), -1)
        self.stops[opened] = closed
        void = np.flatnonzero(np.array([name in VOID for name, _ in self.named])[self.codes])
        self.stops[void] = void
        self.stops[~self.sound[self.page]] = -1

    def _rules(self) -> dict[tuple[str, ...], set[str]]:
        """Names whose elements can be ended by a start, and the starts that are there and do so."""
        rules: dict[tuple[str, ...], set[str]] = defaultdict(set)
        for name, _ in self.named:
            for group, _ in END_RULES.get(name, ()):
                rules[group].add(name)
        return rules

    def find(self, chains: list[list[Compound]]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the elements of a selector, and for each the innermost place its chain can begin at."""
        found = []
        for chain in chains:
            hits = roots = None
            for tag, marks in chain:
                fits = [bool(name) and name[0] != "/" and (not tag or name == tag) and (not marks or (raw != "" and _own(raw)[1].issuperset(marks))) for name, raw in self.named]
                places = np.flatnonzero(np.array(fits)[self.codes] & (self.stops >= 0))
                if hits is None:
                    hits = roots = places
                else:
                    around = self._innermost(hits, places)
                    hits, roots = places[around >= 0], roots[around[around >= 0]]
            found.append((hits, roots))
        if len(found) == 1:
            return found[0]
        hits, roots = (np.concatenate(own) for own in zip(*found))
        order = np.lexsort((-roots, hits))
        hits, roots = hits[order], roots[order]
        new = np.append(True, hits[1:] != hits[:-1])[: len(hits)]
        return hits[new], roots[new]

    def _innermost(self, spans: np.ndarray, places: np.ndarray) -> np.ndarray:
        """For each place the number of the innermost of some elements that it lies in, or -1."""
        at, stops = np.searchsorted(spans, places) - 1, self.stops[spans]
        outer = None
        while (left := np.flatnonzero((at >= 0) & (stops[at] <= places) if len(spans) else at >= 0)).size:
            if outer is None:
                outer, around = [], []
                for number, (start, stop) in enumerate(zip(spans.tolist(), stops.tolist())):
                    while around and around[-1][1] <= start:
                        around.pop()
                    outer.append(around[-1][0] if around else -1)
                    around.append((number, stop))
                outer = np.array(outer)
            at[left] = outer[at[left]]
        return at

    def strings(self, places: np.ndarray) -> list[str]:
        """Text nodes of elements, parted by ``GAP``."""
        texts, stops = self.texts, self.stops[places]
        found = [unescape(text) if "&" in text else text for text in map(texts.__getitem__, places.tolist())]
        for at in np.flatnonzero(stops != places + 1).tolist():
            found[at] = GAP.join([unescape(part) for part in texts[places[at] : stops[at]] if part])
        return found


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Where runs of these sizes start, and where the last one ends."""
    return np.concatenate(([0], np.cumsum(sizes)))


def _ranges(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    return np.arange(sizes.sum()) + np.repeat(start - _starts(sizes)[:-1], sizes)


_ELEMENTS = T.ArrayType(T.ArrayType(T.StructType([
    T.StructField("at", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("text", T.StringType()), T.StructField("parts", T.ArrayType(T.ArrayType(T.StringType()))),
])))


@lru_cache(maxsize=1024)
def _asked(question_of: str) -> list:
    return json.loads(question_of)


_ARROW = to_arrow_type(_ELEMENTS)
#: Pages that are cut, and whose elements are held, at a time.
PAGES = 512
#: Characters of such pages, from which on fewer are held.
CHARACTERS = 1 << 20
#: Pages of which the same is asked, from which on they are looked up together.
TOGETHER = 8


def _offsets(sizes: Iterable[int]) -> pa.Array:
    return pa.array(accumulate(sizes, initial=0), pa.int32())


def _bounds(sizes: np.ndarray) -> pa.Array:
    return pa.array(_starts(sizes), pa.int32())


def _together(tags: Tags, asked: list) -> pa.Array:
    """The elements of the sound pages, as :func:`_columns` lays them out; of each other page none."""
    places, keys, element_parts, with_text = [], [], [], []
    sizes, owners, texts = [], [], []  # of the lists of texts: one an element and part
    most, before = max([len(parts) for _, parts in asked], default=0) or 1, 0
    for which, (chains, parts) in enumerate(asked):
        at, _ = tags.find(chains)
        places.append(at)
        keys.append(tags.page[at] * len(asked) + which)
        element_parts.append(np.full(len(at), len(parts)))
        with_text.append(np.full(len(at), not parts))
        for part, chains_of_part in enumerate(parts):
            hits, roots = tags.find(chains_of_part)
            low = np.searchsorted(hits, at + 1)
            size = np.maximum(np.searchsorted(hits, tags.stops[at]) - low, 0)
            inner = _ranges(low, size)
            if any(len(chain) > 1 for chain in chains_of_part):
                owner = np.repeat(np.arange(len(at)), size)
                inner, owner = (own[roots[inner] > at[owner]] for own in (inner, owner))
                size = np.bincount(owner, minlength=len(at))
            sizes.append(size)
            owners.append((before + np.arange(len(at))) * most + part)
            texts.append(hits[inner])
        before += len(at)
    at, key, n_parts, with_text = (np.concatenate(own) for own in (places, keys, element_parts, with_text))
    order = np.argsort(key, kind="stable")
    at, n_parts, with_text = at[order], n_parts[order], with_text[order]
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))

    element, list_of = _ARROW.value_type.value_type, pa.ListArray.from_arrays
    kinds = {field.name: field.type for field in element}
    if sizes:
        size, owner, inner = (np.concatenate(own) for own in (sizes, owners, texts))
        owner = rank[owner // most] * most + owner % most
        by_owner = np.argsort(owner, kind="stable")
        inner, size = inner[_ranges(_starts(size)[:-1][by_owner], size[by_owner])], size[by_owner]
    else:
        size = inner = np.empty(0, np.int64)
    of_parts = list_of(_bounds(n_parts), list_of(_bounds(size), pa.array(tags.strings(inner), pa.string()), type=kinds["parts"].value_type), type=kinds["parts"])
    text = np.full(len(at), None, object)
    text[with_text] = tags.strings(at[with_text])
    codes, code = np.unique(tags.codes[at], return_inverse=True)
    pairs = [_own(tags.named[own][1])[0] for own in codes]
    n_pairs = np.array([len(own) for own in pairs], np.int64)
    listed, of_each = list(chain(*pairs)), pa.array(_ranges(_starts(n_pairs)[:-1][code], n_pairs[code]))
    attributes = pa.MapArray.from_arrays(
        _bounds(n_pairs[code]), pa.array([name for name, _ in listed], pa.string()).take(of_each), pa.array([value for _, value in listed], pa.string()).take(of_each), type=kinds["attributes"]
    )
    start = tags.first[tags.page[at]]
    fields = [pa.array(at - start, kinds["at"]), pa.array(tags.stops[at] - start, kinds["stop"]), attributes, pa.array(text, kinds["text"]), of_parts]
    rows = pa.StructArray.from_arrays(fields, fields=list(element))
    pages = len(tags.sound)
    lists = list_of(_bounds(np.bincount(key, minlength=pages * len(asked))), rows, type=_ARROW.value_type)
    return list_of(_bounds(np.full(pages, len(asked))), lists, type=_ARROW)


def _read(html: list[str | None], asked: list[str | None]) -> pa.Array:
    """Elements of some pages: together where enough of them are asked the same, else one by one."""
    groups: dict[str, list[int]] = defaultdict(list)
    for at, (page, question_of) in enumerate(zip(html, asked, strict=True)):
        if page is not None and question_of is not None:
            groups[question_of].append(at)
    found, places, single = [], [], dict.fromkeys(range(len(html)))
    for question_of, members in groups.items():
        asks = _asked(question_of)
        if len(members) < TOGETHER or not asks:
            single |= {at: read_elements(html[at], asks) for at in members}
            continue
        tags = Tags([html[at] for at in members])
        for at, sound in zip(range(len(members)), tags.sound.tolist()):
            if sound:
                del single[members[at]]
            else:
                single[members[at]] = page_elements(tags.one(at), asks)
        if tags.sound.any():
            found.append(_together(tags, asks).filter(pa.array(tags.sound)))
            places += [at for at, sound in zip(members, tags.sound.tolist()) if sound]
    if single:
        found.append(_columns(list(single.values())))
        places += single
    if not found:
        return _columns([])
    place = np.empty(len(html), np.int64)
    place[places] = np.arange(len(html))
    return (pa.concat_arrays(found) if len(found) > 1 else found[0]).take(pa.array(place))


def _columns(pages: list[list[list[tuple]] | None]) -> pa.Array:
    """Elements of some pages as Arrow lays them out: a column per field, no object per element."""
    asked = [elements for page in pages if page for elements in page]
    at, stop, attributes, text, inner = zip(*chain(*asked)) if any(asked) else ((),) * 5
    pairs, parts = list(chain(*attributes)), list(chain(*inner))
    element, list_of = _ARROW.value_type.value_type, pa.ListArray.from_arrays
    kinds = {field.name: field.type for field in element}
    fields = [
        pa.array(at, kinds["at"]),
        pa.array(stop, kinds["stop"]),
        pa.MapArray.from_arrays(
            _offsets(map(len, attributes)), pa.array([name for name, _ in pairs], pa.string()), pa.array([value for _, value in pairs], pa.string()), type=kinds["attributes"]
        ),
        pa.array(text, kinds["text"]),
        list_of(
            _offsets(map(len, inner)), list_of(_offsets(map(len, parts)), pa.array(chain(*parts), pa.string()), type=kinds["parts"].value_type), type=kinds["parts"]
        ),
    ]
    rows = pa.StructArray.from_arrays(fields, fields=list(element))
    lists = list_of(_offsets(map(len, asked)), rows, type=_ARROW.value_type)
    return list_of(_offsets([len(page or ()) for page in pages]), lists, type=_ARROW, mask=pa.array([page is None for page in pages], pa.bool_()))


def _portions(html: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and number of the pages to be read together."""
    start = size = 0
    for at, length in enumerate(pc.utf8_length(html).to_pylist()):
        if at > start and (at - start == PAGES or size + (length or 0) > CHARACTERS):
            yield start, at - start
            start, size = at, 0
        size += length or 0
    yield start, len(html) - start


@F.arrow_udf(_ELEMENTS)
def select(html: pa.Array, asked: pa.Array) -> pa.Array:
    """The elements of each page for what is asked of it (JSON, as ``question`` gives it); null without content.

    Per asked selector the elements in page order; ``parts`` holds the texts of what was asked for inside each. A batch
    is read in portions, so that the objects of a few pages are held at a time, however many a batch has.
    """
    done = [_read(html.slice(start, n).to_pylist(), asked.slice(start, n).to_pylist()) for start, n in _portions(html)]
    return pa.concat_arrays(done)


def question(asked: list[tuple[list[str], list[str]]]) -> str:
    """What ``select`` is to look for: for each entry a chain of selectors, each inside the one before, and the parts to read."""

    def nested(selectors: list[str]) -> list[list[Compound]]:
        chains: list[list[Compound]] = [[]]
        for selector in selectors:
            chains = [outer + inner for outer in chains for inner in compile_selector(selector)]
        return chains

    return json.dumps([[nested(selectors), [compile_selector(part) for part in parts]] for selectors, parts in asked])
