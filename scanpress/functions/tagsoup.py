"""A total reader of tag soup: no string makes it fail, and its time grows with the text.

:func:`tokens` cuts markup into start tags, end tags and text.  Its rules:

* a tag is ``<`` or ``</`` and a letter, up to the next ``>`` outside a quoted
  attribute value; a quote that never closes is an ordinary character, and a
  tag that never ends is text;
* a comment ends at ``-->``, a CDATA section at ``]]>``; every other ``<!``,
  ``<?`` or ``</`` construct, and a CDATA section that never closes, ends at
  the next ``>`` (without one it is text); a comment that never closes runs to
  the end.  All are passed over;
* scripts, styles and their like hold text up to their end tag, or to the end
  of the markup; a title or text area does where it has an end tag;
* every other ``<`` is text.

Searches that found nothing are remembered, so no tail is searched twice.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.entities import name2codepoint

START, END, TEXT = "start", "end", "text"

# Elements with text content, elements without an end tag, elements that end where one of their kind starts.
RAW_ELEMENTS = frozenset({"script", "style", "xmp", "iframe", "noembed", "noframes"})
RAW_IF_CLOSED = frozenset({"title", "textarea"})
VOID_ELEMENTS = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"})
TEXT_ELEMENTS = RAW_ELEMENTS | RAW_IF_CLOSED | {"plaintext"}
IMPLIED_END = frozenset({"p", "li", "td", "tr", "dt", "dd", "option"})

_SIMPLE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)>", re.ASCII)
_NAME = re.compile(r"[A-Za-z][^\s/>]*", re.ASCII)
_GAP = re.compile(r"[\s/]*", re.ASCII)
_ATTRIBUTE = re.compile(r"[^\s/>][^\s/>=]*", re.ASCII)
_EQUALS = re.compile(r"\s*=\s*", re.ASCII)
_UNQUOTED = re.compile(r"[^\s>]*", re.ASCII)
_REFERENCE = re.compile(r"&(?:#([0-9]+|[xX][0-9a-fA-F]+)|([A-Za-z][A-Za-z0-9]*))(;?)")


class _Searches:
    """``str.find`` that remembers which strings occur no more."""

    def __init__(self, text: str) -> None:
        self.text, self.gone = text, set()

    def find(self, what: str, at: int) -> int:
        if what in self.gone:
            return -1
        found = self.text.find(what, at)
        if found < 0:
            self.gone.add(what)
        return found

    def closer(self, name: str, at: int) -> int:
        """Where the end tag of a raw element begins, or -1."""
        if ("/", name) in self.gone:
            return -1
        found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE | re.ASCII).search(self.text, at)
        if found is None:
            self.gone.add(("/", name))
            return -1
        return found.start()


def _tag(search: _Searches, at: int, attributes: list | None) -> int:
    """The place after a tag whose name ends at ``at``, or -1 if it never ends; its attributes are added to the list."""
    text = search.text
    plain = search.find(">", at)
    if plain < 0:
        return -1
    if attributes is None and '"' not in (inner := text[at:plain]) and "'" not in inner:
        return plain + 1
    while True:
        at = _GAP.match(text, at).end()
        if at >= len(text):
            return -1
        if text[at] == ">":
            return at + 1
        name = _ATTRIBUTE.match(text, at)
        at, value = name.end(), None
        if equals := _EQUALS.match(text, at):
            at = equals.end()
            quote = text[at : at + 1]
            close = search.find(quote, at + 1) if quote in ("'", '"') else -1
            if close >= 0:
                value, at = text[at + 1 : close], close + 1
            else:
                bare = _UNQUOTED.match(text, at)
                value, at = bare.group(), bare.end()
        if attributes is not None:
            attributes.append((name.group().lower(), None if value is None else unescape(value)))


def tokens(text: str, with_attributes: bool = False) -> Iterator[tuple]:
    """(kind, name, from, to, attributes) of tags, and of text with ``None`` for a name.

    ``attributes`` is a list of (name, value) pairs where they are asked for."""
    search, at, n = _Searches(text), 0, len(text)
    simple = _SIMPLE.match
    while at < n:
        # Tags without attributes, which most are, take one match; the rules below read them the same.
        plain = simple(text, at)
        if plain is not None:
            closed, tag = plain.groups()
            tag = tag.lower()
            if closed or tag not in TEXT_ELEMENTS:
                end = plain.end()
                yield END if closed else START, tag, at, end, [] if with_attributes and not closed else None
                at = end
                continue
        lt = search.find("<", at)
        if lt < 0:
            yield TEXT, None, at, n, None
            return
        if lt > at:
            yield TEXT, None, at, lt, None
        at = lt
        after = text[at + 1 : at + 2]
        closing = after == "/"
        name = _NAME.match(text, at + 1 + closing)
        if name is not None:
            attributes = [] if with_attributes and not closing else None
            end = _tag(search, name.end(), attributes)
            if end > 0:
                tag = name.group().lower()
                yield END if closing else START, tag, at, end, attributes
                at = end
                if not closing and text[end - 2] != "/":
                    raw_end = -1
                    if tag == "plaintext":
                        raw_end = n
                    elif tag in RAW_ELEMENTS:
                        raw_end = search.closer(tag, at)
                        raw_end = n if raw_end < 0 else raw_end
                    elif tag in RAW_IF_CLOSED:
                        raw_end = search.closer(tag, at)
                    if raw_end > at:
                        yield TEXT, None, at, raw_end, None
                        at = raw_end
                continue
        elif after and after in "!?/":
            if text.startswith("<!--", at):
                end = search.find("-->", at + 2)
                end = n if end < 0 else end + 3
            else:
                end = search.find("]]>", at) + 3 if text.startswith("<![CDATA[", at) else 2
                if end == 2:
                    end = search.find(">", at) + 1
            if end > 0:
                at = end
                continue
        yield TEXT, None, at, at + 1, None
        at += 1


def decode_text(text: str) -> str:
    """Character references of text: HTML 4 names that end with ``;`` and numbers; any other stays as it is."""
    if "&" not in text:
        return text

    def one(found: re.Match) -> str:
        number, name, closed = found.groups()
        if name is not None:
            code = name2codepoint.get(name, -1) if closed else -1
        else:
            digits = number.lstrip("xX0") or "0"
            code = int(digits, 16 if number[0] in "xX" else 10) if len(digits) < 8 else -1
        return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code <= 0xDFFF else found.group()

    return _REFERENCE.sub(one, text)


class ExpansionError(ValueError):
    """Fields of nested articles that together are far longer than the markup."""


#: Fields may hold this many times the characters of the markup, and as many more as given.
EXPANSION, EXPANSION_LEAST = 64, 1 << 20


class _Element:
    """An article or field: where its content begins and ends, in the markup, in the texts and among its like."""

    __slots__ = ("content", "end", "last", "last_text", "shared", "tag", "text")

    def __init__(self, tag: str, content: int, text: int) -> None:
        self.tag, self.content, self.text = tag, content, text
        self.end = self.last = self.last_text = -1
        self.shared = 0


def _expanded() -> ExpansionError:
    return ExpansionError(f"fields of over {EXPANSION} times the markup")


def _elements(markup: str, wanted: frozenset[str], body: str, most: int) -> tuple[list[_Element], list[str]]:
    """The wanted elements in document order, and the stripped texts between tags.

    Bodies that are still open can only grow: reading ends with an error as soon as they hold over ``most`` characters.
    """
    found: list[_Element] = []
    texts: list[str] = []
    run: list[str] = []
    stack: list[tuple[str, _Element | None]] = []
    open_tags: Counter[str] = Counter()
    waiting: list[_Element] = []  # open articles without a body so far
    # Of the bodies that articles have: characters of the closed ones; number and places of the open ones.
    held = opened = places = 0

    def close(down_to: int, at: int) -> None:
        nonlocal held, opened, places
        while len(stack) > down_to:
            tag, element = stack.pop()
            open_tags[tag] -= 1
            if element is not None:
                element.end, element.last, element.last_text = at, len(found), len(texts)
                if waiting and waiting[-1] is element:
                    waiting.pop()
                if element.shared:
                    held += element.shared * (at - element.content)
                    opened -= element.shared
                    places -= element.shared * element.content

    for kind, tag, begin, end, _ in tokens(markup):
        if kind is TEXT:
            run.append(decode_text(markup[begin:end]))
            continue
        if run:
            text = "".join(run).strip()
            if text:
                texts.append(text)
            run.clear()
        if kind is END:
            if open_tags[tag]:
                at = len(stack) - 1
                while stack[at][0] != tag:
                    at -= 1
                close(at, begin)
            continue
        if tag in VOID_ELEMENTS:
            continue
        if tag in IMPLIED_END and stack and stack[-1][0] == tag:
            close(len(stack) - 1, begin)
        element = _Element(tag, end, len(texts)) if tag in wanted else None
        if element is not None:
            found.append(element)
            if tag == "article":
                waiting.append(element)
            elif tag == body and waiting:
                element.shared = len(waiting)
                opened += element.shared
                places += element.shared * end
                waiting.clear()
            if held + opened * begin - places > most:
                raise _expanded()
        stack.append((tag, element))
        open_tags[tag] += 1
        if markup[end - 2] == "/":
            close(len(stack) - 1, end)
    if run and (text := "".join(run).strip()):
        texts.append(text)
    close(0, len(markup))
    return found, texts


def read_articles(markup: str, text_fields: tuple[str, ...], body_field: str) -> list[dict[str, str | None]]:
    """Every ``<article>`` at any depth, in document order: the text of the first element of each text field below it,
    the markup inside the first body element; None where there is none."""
    left = EXPANSION * len(markup) + EXPANSION_LEAST
    elements, texts = _elements(markup, frozenset({"article", body_field, *text_fields}), body_field, left)
    places: dict[str, list[int]] = {}
    for place, element in enumerate(elements):
        places.setdefault(element.tag, []).append(place)
    before = [0]
    for text in texts:
        before.append(before[-1] + len(text))
    known: dict[int, str] = {}
    rows = []
    for own in places.get("article", []):
        row: dict[str, str | None] = {}
        for field in (*text_fields, body_field):
            of_field = places.get(field, [])
            at = bisect_right(of_field, own)
            if at == len(of_field) or of_field[at] >= elements[own].last:
                row[field] = None
                continue
            first = elements[of_field[at]]
            body = field == body_field
            left -= first.end - first.content if body else before[first.last_text] - before[first.text]
            if left < 0:
                raise _expanded()
            if of_field[at] not in known:
                known[of_field[at]] = markup[first.content : first.end] if body else "".join(texts[first.text : first.last_text])
            row[field] = known[of_field[at]]
        rows.append(row)
    return rows


def read_meta(html: str, lower_names: bool = True, head_only: bool = False) -> dict[str, str]:
    """name -> content of the ``<meta>`` tags that have both; a later one wins; in the head alone if asked."""
    meta: dict[str, str] = {}
    in_head = False
    for kind, tag, _, _, attributes in tokens(html, with_attributes=True):
        if kind is END:
            in_head = in_head and tag != "head"
        elif kind is START and tag in ("head", "body"):
            in_head = tag == "head"
        elif kind is START and tag == "meta" and (in_head or not head_only):
            found = dict(attributes)
            if found.get("name") is not None and found.get("content") is not None:
                meta[found["name"].lower() if lower_names else found["name"]] = found["content"]
    return meta
