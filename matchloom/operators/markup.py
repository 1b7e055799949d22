"""Elements of HTML pages, nested to any depth.

A page is cut at its tags. Per tag name the open elements say which end belongs to which
beginning, so an element may hold others of its own tag. ``rows`` gives a row for each element
that fits a selector, with what it asks of the elements in it; ``parsed`` gives an array for each
page, of the elements that selectors ask for, in order; an element is followed by those that
it holds, so what lies in it is a slice of the array. Pages are cut where they lie: nothing is
exchanged, and the work is in proportion to the page's length. ``rows`` reads a page in
stretches that no element it asks for goes beyond, and a page may come in pieces, so a task holds
no more of a long page than such a stretch; ``parsed`` holds a page at a time.

Markup that isn't well-formed: an end without a beginning is passed over, an element that is
never ended goes on to the end of its page, and comments, scripts and styles are no markup.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tags that hold nothing.
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"])
_TAG = re.compile(r"""(</?[A-Za-z][\w:-]*[^"'>]*+(?:(?:"[^"]*+"|'[^']*+')[^"'>]*+)*+>)""")
_NAME = re.compile(r"/?([A-Za-z][\w:-]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_OPAQUE = re.compile(r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>")
_HIDES = re.compile(r"<(?:!--|[sS][cC][rR]|[sS][tT][yY])")
_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
_PART = re.compile(r"""(?P<tag>^[a-zA-Z][\w-]*)|\.(?P<class>[\w-]+)|\[(?P<name>[\w-]+)(?:(?P<op>[*^]?)=["']?(?P<value>[^"'\]]*)["']?)?\]""")

_FIELDS = [("pos", pa.int32()), ("end", pa.int32()), ("at", pa.int32()), ("size", pa.int32()), ("parent", pa.int32()), ("opens", pa.list_(pa.string())), ("attributes", pa.map_(pa.string(), pa.string())), ("text", pa.string())]
_ELEMENT = "array<struct<pos: int, end: int, at: int, size: int, parent: int, opens: array<string>, attributes: map<string, string>, text: string>>"


def _plain(text: str) -> str:
    """Text without entities, words one space apart."""
    if "&" in text:
        for entity, char in _ENTITIES:
            text = text.replace(entity, char)
    return " ".join(text.split())


def selector(text: str) -> tuple[set[str], Callable[[str, dict], bool]]:
    """The attributes that a selector asks for (empty if a tag's name can be enough), and whether
    a tag (name, attributes) fits it. Selectors are separated by commas: a tag's name,
    ``.class``, ``[attribute]``, ``[attribute="value"]``, ``*=`` for a part of the value, ``^=``
    for its beginning, or several of these in one."""
    every, asked, bare = [], set(), False
    for one in text.split(","):
        tests, at, names = [], 0, set()
        for m in _PART.finditer(one.strip()):
            if m.start() != at:
                break
            at = m.end()
            value = m["value"]
            if m["tag"]:
                tests.append(lambda tag, has, want=m["tag"].lower(): tag == want)
                continue
            name = m["name"] or "class"
            names.add(name)
            if m["class"]:
                tests.append(lambda tag, has, want=m["class"]: want in has.get("class", "").split())
            elif m["op"] is None:
                tests.append(lambda tag, has, name=name: name in has)
            elif m["op"] == "*":
                tests.append(lambda tag, has, name=name, value=value: value in has.get(name, "\0"))
            elif m["op"] == "^":
                tests.append(lambda tag, has, name=name, value=value: has.get(name, "\0").startswith(value))
            else:
                tests.append(lambda tag, has, name=name, value=value: has.get(name) == value)
        if not tests or at != len(one.strip()):
            raise ValueError(f"not a selector: {one}")
        every.append(tests)
        asked |= names
        bare |= not names
    return set() if bare else asked, lambda tag, has: any(all(t(tag, has) for t in tests) for tests in every)


def by_test_id(ids: list[str], tag: str = "") -> str:
    return ", ".join(f'{tag}[data-testid="{x}"]' for x in ids)


_OPEN = 1 << 30
_REMEMBERED = 20_000
_BATCH_ROWS, _BATCH_CHARS = 5_000, 8_000_000
_STRETCH_TAGS, _STRETCH_CHARS = 2_000, 1 << 18


class _Tags(dict):
    """What a tag and the text behind it say, without the ``<``: whether it is an end, its name,
    the kinds that it fits, its attributes if it fits any, whether it can hold something, and the
    text. None where the first ``>`` isn't the tag's end, or what follows may be no markup.
    What recurs is read once."""

    def __init__(self, kinds: dict[str, str]):
        self.kinds = {name: selector(s) for name, s in kinds.items()}
        self.tags: dict[str, tuple] = {}
        asked = [names for names, _ in self.kinds.values()]
        self.needed = set().union(*asked) if all(asked) else None
        # Whether a tag fits depends on its name, these attributes' values, and whether it has those.
        tested = [m for s in kinds.values() for one in s.split(",") for m in _PART.finditer(one.strip()) if not m["tag"]]
        self.values = sorted({m["name"] or "class" for m in tested if not m["name"] or m["op"] is not None})
        self.present = sorted({m["name"] for m in tested if m["name"]} - set(self.values))
        self.fits: dict[tuple, tuple] = {}

    def __missing__(self, part: str) -> tuple | None:
        at = part.find(">") + 1
        raw = part[:at]
        tag = self.tags.get(raw)
        if tag is None:
            if not at or not _TAG.fullmatch("<" + raw) or _HIDES.match("<" + raw):
                return None
            tag = self.said(raw)
            if len(self.tags) < _REMEMBERED:
                self.tags[raw] = tag
        out = (*tag, part[at:])
        if len(self) < _REMEMBERED and len(part) < 200:
            self[part] = out
        return out

    def said(self, raw: str) -> tuple:
        name = _NAME.match(raw)
        tag, rest = name[1].lower(), raw[name.end() : -1]
        if raw[0] == "/":
            return True, tag, (), None, False
        has, opens = None, ()
        if self.needed is None or any(n in rest.lower() for n in self.needed):
            has = {a.lower(): x or y or z for a, x, y, z in _ATTRIBUTE.findall(rest)}
            like = (tag, *[has.get(n) for n in self.values], *[n in has for n in self.present])
            opens = self.fits.get(like)
            if opens is None:
                opens = tuple(name for name, (_, fits) in self.kinds.items() if fits(tag, has))
                if len(self.fits) < _REMEMBERED:
                    self.fits[like] = opens
        return False, tag, opens, has if opens else None, tag not in VOID and not rest.endswith("/")


def _stretches(pieces: Iterable[str]) -> Iterator[str]:
    """The text of the pieces, some of it at a time; at least one stretch, which may be empty."""
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece)
        if size >= 2 * _STRETCH_CHARS:
            text, size = "".join(held), 0
            yield from (text[k : k + _STRETCH_CHARS] for k in range(0, len(text), _STRETCH_CHARS))
            held = []
    yield "".join(held)


def _cut(pieces: Iterable[str], tags: _Tags) -> Iterator[list[tuple]]:
    """What the tags of a page say, in order, some of them at a time. A page is cut at each "<" as
    far as every tag ends with the first ">" behind it, and tag by tag from there on, where the
    rest of the page is held. What follows a tag is known once the next part is a tag, too, so the
    last part of a stretch waits for the next one."""
    stretches = _stretches(pieces)
    rest, plain = next(stretches), True
    for stretch in stretches:
        last = rest.rfind("<")
        said = list(map(tags.__getitem__, rest[:last].split("<")[1:])) if last > 0 else []
        if not all(said):
            rest, plain = "".join([rest, stretch, *stretches]), False
            break
        if len(said) > 1:
            yield said[:-1]
            rest = rest[rest.rindex("<", 0, last) :]
        rest += stretch
    if plain:
        said = list(map(tags.__getitem__, rest.split("<")[1:]))
        if all(said):
            yield said
            return
    text, said, tag = _OPAQUE.sub(" ", rest) if _HIDES.search(rest) else rest, [], None
    for after in _TAG.finditer(text):
        if tag:
            said.append((*tags.said(tag[0][1:]), text[tag.end() : after.start()]))
            if len(said) >= _STRETCH_TAGS:
                yield said
                said = []
        tag = after
    yield [*said, (*tags.said(tag[0][1:]), text[tag.end() :])] if tag else said


class _Page:
    """A page, or a stretch of it that no element which fits a kind goes beyond: the elements that
    fit one, by the places of their tags in the page."""

    def __init__(self, tags: _Tags, start: int, texts: list[str], ends: list[int]):
        self.tags, self.start, self.texts, self.ends = tags, start, texts, ends
        self.found: list[tuple] = []  # place, place of the tag around it, what the tag says
        self.kinds: dict[str, tuple[list[int], list[tuple]]] = {}

    def split(self, pos: int) -> _Page:
        """The page behind a tag, which is the last of this stretch from now on."""
        at = pos + 1 - self.start
        after = _Page(self.tags, pos + 1, self.texts[at:], self.ends[at:])
        del self.texts[at:], self.ends[at:]
        return after

    def listed(self) -> _Page:
        self.kinds = {name: ([], []) for name in self.tags.kinds}
        for element in self.found:
            for name in element[2][2]:
                at, own = self.kinds[name]
                at.append(element[0])
                own.append(element)
        return self

    def inside(self, kind: str, pos: int, end: int) -> list[tuple]:
        """The elements of a kind from a place up to another."""
        at, own = self.kinds[kind]
        first = bisect_left(at, pos)
        return own[first : bisect_left(at, end, first)] if first < len(at) and at[first] < end else []

    def end(self, pos: int) -> int:
        """The place of the tag that ends an element."""
        return self.ends[pos - self.start]

    def text(self, pos: int) -> str:
        return _plain(" ".join(filter(None, self.texts[pos - self.start : self.ends[pos - self.start] - self.start])))


def _read(pieces: Iterable[str], tags: _Tags, around: bool = True, whole: bool = True) -> Iterator[_Page]:
    """A page in stretches, or ``whole``. ``around``: whether the tag around an element is asked
    for; it is known if it lies in the same stretch."""
    opened: dict[str, list[int]] = {}
    stack: list[int] = []
    live: set[int] = set()  # elements that fit a kind and haven't ended
    page, pos, start = _Page(tags, 0, [], []), -1, 0
    texts, ends, found = page.texts, page.ends, page.found
    for said in _cut(pieces, tags):
        texts += [x[5] for x in said]
        ends += range(pos + 1, pos + 1 + len(said))
        for x in said:
            pos += 1
            tag = x[1]
            if x[0]:
                if mine := opened.get(tag):
                    at = mine.pop()
                    if at >= start:
                        ends[at - start] = pos
                        if at in live:
                            live.remove(at)
                            if not live and not whole and pos - start >= _STRETCH_TAGS:
                                after = page.split(pos)
                                yield page.listed()
                                page, start = after, after.start
                                texts, ends, found = page.texts, page.ends, page.found
                                stack.clear()
                continue
            if x[2]:
                if around:
                    while stack and ends[stack[-1] - start] != _OPEN:
                        stack.pop()
                found.append((pos, stack[-1] if stack else -1, x))
                if x[4]:
                    live.add(pos)
            if x[4]:
                ends[pos - start] = _OPEN
                if mine := opened.get(tag):
                    mine.append(pos)
                else:
                    opened[tag] = [pos]
                if around:
                    stack.append(pos)
    yield page.listed()


def _elements_of(html: str, tags: _Tags, without: dict[str, str]) -> list[dict]:
    """The elements of a page that fit a selector, in order."""
    (page,), out = _read([html], tags), []
    places = [pos for pos, *_ in page.found]
    for k, (pos, parent, (_, _, opens, has, *_)) in enumerate(page.found):
        end = page.end(pos)
        held = bisect_left(places, end, k + 1) - k - 1
        inner = [(x, page.end(x)) for gone in {without[o] for o in opens if o in without} for x, *_ in page.inside(gone, pos + 1, end)]
        text = page.text(pos) if not inner else _plain(" ".join(t for n, t in enumerate(page.texts[pos:end], pos) if not any(x <= n < stop for x, stop in inner)))
        out.append({"pos": pos, "end": end, "at": k, "size": held, "parent": parent, "opens": opens, "attributes": list(has.items()), "text": text})
    return out


def _pieces(batches: Iterable[pa.RecordBatch], read: Callable, pack: Callable) -> Iterable[pa.RecordBatch]:
    """Batches of bounded size: ``read`` gives the rows of a page, ``pack`` makes arrays of rows."""

    def packed(keys, at, out):
        arrays = {"key": keys.take(pa.array(at, pa.int64())), **pack(out)}
        return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    for batch in batches:
        keys, htmls = batch.columns
        at, out, chars = [], [], 0
        for k in range(len(htmls)):
            html = htmls[k].as_py() or ""
            chars += len(html)
            for row in read(html):
                at.append(k)
                out.append(row)
                if len(out) >= _BATCH_ROWS:
                    yield packed(keys, at, out)
                    at, out, chars = [], [], 0
            if chars >= _BATCH_CHARS and out:
                yield packed(keys, at, out)
                at, out, chars = [], [], 0
        yield packed(keys, at, out)


def _pages_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Scalar, Iterator[str]]]:
    """(key, pieces) of each page, of rows with a piece each."""

    def numbered():
        page, number, key = 0, 0, None
        for batch in batches:
            keys, numbers, htmls = batch.columns
            for k, n in enumerate(numbers.to_pylist()):
                if n == 1:
                    page, key = page + 1, keys[k]
                elif n != number + 1 or key is None or not keys[k].equals(key):
                    raise ValueError(f"piece {n} of page {keys[k]} doesn't follow the one before it")
                number = n
                yield page, key, htmls[k].as_py() or ""

    for _, rows in groupby(numbered(), lambda row: row[0]):
        first = next(rows)
        yield first[1], chain([first[2]], (row[2] for row in rows))


def _of_pieces(batches: Iterable[pa.RecordBatch], read: Callable, pack: Callable) -> Iterable[pa.RecordBatch]:
    """As ``_pieces`` of pages that come in pieces: ``read`` takes these one after the other."""
    keys, out = [], []

    def packed():
        arrays = {"key": pa.concat_arrays([pa.repeat(key, many) for key, many in keys]), **pack(out)}
        return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    for key, pieces in _pages_of(batches):
        done = len(out)
        for row in read(pieces):
            out.append(row)
            if len(out) >= _BATCH_ROWS:
                keys.append((key, len(out) - done))
                yield packed()
                keys, out, done = [], [], 0
        if len(out) > done:
            keys.append((key, len(out) - done))
    if out:
        yield packed()


def _by_page(pages: DataFrame, key: str, html: str, run: Callable, fields: str, number: str | None = None) -> DataFrame:
    rows = pages.select(F.col(key).alias("key"), *([F.col(number).cast("int").alias("number")] if number else []), F.col(html).alias("html"))
    schema = T.StructType([T.StructField("key", pages.schema[key].dataType), *T.StructType.fromDDL(fields).fields])
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def parsed(pages: DataFrame, key: str, selectors: dict[str, str], html: str = "html", without: dict[str, str] | None = None) -> DataFrame:
    """(key, toks) of each page: its elements that fit a selector, in order: pos and end, the
    places of its tags in the page; at, its place in the array, and size, the number of those
    behind it that it holds; parent, the place of the tag of the element right around it; opens,
    the names of the selectors; attributes; and text. ``without`` names selectors whose
    elements are left out of the text of others. A page without html has no element."""
    _Tags(selectors)  # a wrong selector is told here, not in a task
    left_out = dict(without or {})
    kind = pa.list_(pa.struct(_FIELDS))

    def run(batches):
        tags = _Tags(selectors)
        yield from _pieces(batches, lambda html: [_elements_of(html, tags, left_out)], lambda out: {"toks": pa.array(out, kind)})

    return _by_page(pages, key, html, run, f"toks {_ELEMENT}")


class Ask(NamedTuple):
    """What a row asks of the elements in it that fit a selector, itself included: their texts, or
    an attribute of theirs. ``inside`` is a selector: only what the first element that fits it
    holds, itself included, or not with ``below``. ``child``: only what lies right below the row.
    ``leaves``: only what holds no other that fits. ``first``: only the first of them. ``of``: only
    rows of this kind ask, others have an empty array. ``need``: rows that ask and find none are left out."""

    selector: str
    attribute: str = ""
    inside: str = ""
    below: bool = False
    child: bool = False
    leaves: bool = False
    first: bool = True
    of: str = ""
    need: bool = False

    def kinds(self, name: str) -> dict[str, str]:
        return {name: self.selector} | ({f"{name} inside": self.inside} if self.inside else {})

    def answer(self, page: _Page, name: str, pos: int, end: int) -> list[str]:
        if self.inside:
            outer = page.inside(f"{name} inside", pos, end)
            if not outer:
                return []
            pos = outer[0][0]
            end = max(page.end(pos), pos + 1)
        own = page.inside(name, pos + self.below, end)
        if self.child:
            own = [e for e in own if e[1] == pos]
        if self.leaves:  # the next that fits lies in it, or none does
            own = [e for e, after in zip(own, [*own[1:], None], strict=False) if after is None or after[0] >= page.end(e[0])]
        if self.first:
            own = own[:1]
        return [e[2][3].get(self.attribute, "") for e in own] if self.attribute else [page.text(e[0]) for e in own]


class Around(NamedTuple):
    """What a row asks of each element around it that fits a selector, the outermost first: the
    first of ``attributes`` that isn't empty, and the first text by ``title`` in it."""

    selector: str
    attributes: tuple[str, ...]
    title: str


def rows(pages: DataFrame, key: str, kinds: dict[str, str], asks: dict[str, Ask], of_page: dict[str, Ask] | None = None, around: Around | None = None, before: tuple[str, str] | None = None, html: str = "html", number: str | None = None) -> DataFrame:
    """A row for each element of ``kinds`` that can hold something: key, pos, kind (the names
    that it fits), and arrays by the names of ``asks``; arrays by the names of ``of_page`` hold
    the same for the page as a whole.

    ``around`` adds own and titles, arrays with a value for each element around the row that
    fits: the first of its attributes that isn't empty, and the text of the first title in it,
    NULL without one. ``before`` is a selector and a pattern, and adds the text of the last
    element before the row that fits and has the pattern, NULL without one.

    With ``number`` a row of ``pages`` is a piece of a page, numbered from 1. Pieces may end within
    a tag, and follow each other in one partition, as a window over them leaves them; anything else
    is an error."""
    of_page = of_page or {}
    texts = [*asks, *of_page]
    selectors = {f"row {n}": s for n, s in kinds.items()}
    for name, ask in (asks | of_page).items():
        selectors |= ask.kinds(name)
    if around:
        selectors |= {"around": around.selector, "title": around.title}
    if before:
        selectors["before"] = before[0]
    _Tags(selectors)

    parents = any(ask.child for ask in [*asks.values(), *of_page.values()])

    def answers(page: _Page, names: list[str], pos: int, end: int) -> list[list[str]] | None:
        out = []
        for name, ask in asks.items():
            out.append(ask.answer(page, name, pos, end) if not ask.of or ask.of in names else [])
            if ask.need and not out[-1] and (not ask.of or ask.of in names):
                return None
        return out

    def read(pieces: Iterable[str], tags: _Tags) -> Iterable[list]:
        last = None
        for page in _read(pieces, tags, parents, bool(of_page)):
            fits = sorted({(e[0], e[2][2]) for name in kinds for e in page.kinds[f"row {name}"][1]}) if len(kinds) > 1 else [(e[0], e[2][2]) for e in page.kinds[f"row {next(iter(kinds))}"][1]]
            whole = [ask.answer(page, name, 0, _OPEN) for name, ask in of_page.items()] if fits else []
            boxes, held, heads, told = page.kinds["around"][1] if around else [], [], page.kinds["before"][1] if before else [], {}
            b = h = 0
            for pos, opens in [*fits, (_OPEN, ())]:
                if before:
                    while h < len(heads) and heads[h][0] < pos:
                        text = page.text(heads[h][0])
                        if re.search(before[1], text, re.ASCII):
                            last = text
                        h += 1
                if pos == _OPEN or (end := page.end(pos)) <= pos:
                    continue
                names = [o[4:] for o in opens if o.startswith("row ")]
                if (answered := answers(page, names, pos, end)) is None:
                    continue
                row = [pos, names, *answered, *whole]
                if around:
                    while b < len(boxes) and boxes[b][0] < pos:
                        held.append(boxes[b])
                        b += 1
                    held = [x for x in held if page.end(x[0]) > pos]
                    for x, _, said in held:
                        if x not in told:
                            title = page.inside("title", x + 1, page.end(x))[:1]
                            told[x] = (next((v for a in around.attributes if (v := said[3].get(a))), None), page.text(title[0][0]) if title else None)
                    row += [[told[x[0]][0] for x in held], [told[x[0]][1] for x in held]]
                if before:
                    row.append(last)
                yield row

    strings = [*texts, *(["own", "titles"] if around else [])]

    def pack(out: list) -> dict[str, pa.Array]:
        columns = list(zip(*out, strict=True)) if out else [()] * (2 + len(strings) + bool(before))
        arrays = {"pos": pa.array(columns[0], pa.int32())}
        for name, column in zip(["kind", *strings], columns[1:], strict=False):
            offsets = [0]
            for values in column:
                offsets.append(offsets[-1] + len(values))
            arrays[name] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array([v for values in column for v in values], pa.string()))
        return arrays | ({"before": pa.array(columns[-1], pa.string())} if before else {})

    def run(batches):
        tags = _Tags(selectors)
        if number:
            yield from _of_pieces(batches, lambda pieces: read(pieces, tags), pack)
        else:
            yield from _pieces(batches, lambda html: read([html], tags), pack)

    fields = ", ".join(["pos int", *(f"`{n}` array<string>" for n in ["kind", *strings]), *(["before string"] if before else [])])
    return _by_page(pages, key, html, run, fields, number)


def elements(page: DataFrame, kind: str, *keep: str) -> DataFrame:
    """(keep, pos, toks) of each element of a kind that can hold something: itself, and the
    elements in it."""
    each = F.transform(F.filter(opening(F.col("toks"), kind), lambda o: o["end"] > o["pos"]), lambda o: F.struct(o["pos"].alias("pos"), within(F.col("toks"), o).alias("toks")))
    return page.select(*keep, F.inline(each))


def attribute(element: Column, name: str) -> Column:
    """The value of an attribute, empty without one."""
    return F.coalesce(F.try_element_at(element["attributes"], F.lit(name)), F.lit(""))


def within(toks: Column, of: Column) -> Column:
    """An element and those in it, of elements that follow each other."""
    return F.slice(toks, of["at"] - toks[0]["at"] + 1, of["size"] + 1)


def opening(toks: Column, kind: str) -> Column:
    """The elements of a kind."""
    return F.filter(toks, lambda t: F.array_contains(t["opens"], kind))


def first(toks: Column, kind: str) -> Column:
    """The first element of a kind and those in it, none without one."""
    return F.flatten(F.transform(F.slice(opening(toks, kind), 1, 1), lambda o: within(toks, o)))


def first_text(toks: Column, kind: str) -> Column:
    """The text of the first element of a kind, NULL without one."""
    return F.try_element_at(opening(toks, kind), F.lit(1))["text"]
