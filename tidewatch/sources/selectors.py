"""CSS selectors compiled to one automaton over a page's stream of tags.

All selectors of a rule set are compiled together. A step of a selector is one bit; an open
element's state is two bit sets: the steps that it matches itself, and those that it or any
open ancestor matches. A new element then needs only its parent's state: a step matches if
the element fits it and its predecessor is in the ancestors' set (descendant) or in the
parent's own set (child). One pass over the tags finds every match of every selector, and
the open tags are all that is kept.

Open tags form a stack, as lenient parsers keep it: an end tag closes the nearest open
element of its name with all that are open inside it, and does nothing if there is none;
what is still open at the end ends there; void elements hold nothing.

Supported: ``tag``, ``*``, ``.class``, ``#id``, ``[attr]``, ``[attr=value]``, ``:not(...)``
with any of these, descendant (blank) and child (``>``) combinators, and lists (``,``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track",
        "wbr"}
NO_TEXT = {"script", "style", "template"}
KEEP_SPACE = {"pre", "textarea"}

_PART = re.compile(r"""(?P<tag>\*|[a-zA-Z][\w-]*)|\.(?P<class>[\w-]+)|\#(?P<id>[\w-]+)
                       |\[(?P<attr>[\w:-]+)(?:=(?P<quote>["']?)(?P<value>[^"'\]]*)(?P=quote))?\]
                       |:not\((?P<not>[^()]+)\)""", re.X)


@dataclass
class Compound:
    """Conditions on one element."""

    tag: str | None = None
    classes: set[str] = field(default_factory=set)
    attrs: list[tuple[str, str | None]] = field(default_factory=list)
    nots: list[Compound] = field(default_factory=list)

    def fits(self, tag: str, attrs: dict[str, str], classes: set[str]) -> bool:
        return ((self.tag is None or self.tag == tag) and self.classes <= classes
                and all(k in attrs and (v is None or attrs[k] == v) for k, v in self.attrs)
                and not any(n.fits(tag, attrs, classes) for n in self.nots))


def compound(text: str) -> Compound:
    out, at = Compound(), 0
    while at < len(text):
        m = _PART.match(text, at)
        if not m:
            raise ValueError(f"selector not understood: {text!r}")
        if m["tag"]:
            out.tag = None if m["tag"] == "*" else m["tag"].lower()
        elif m["class"]:
            out.classes.add(m["class"])
        elif m["id"]:
            out.attrs.append(("id", m["id"]))
        elif m["attr"]:
            out.attrs.append((m["attr"].lower(), m["value"]))
        else:
            out.nots.append(compound(m["not"].strip()))
        at = m.end()
    return out


def chains(selector: str) -> list[list[tuple[bool, Compound]]]:
    """The alternatives of a selector, each a list of (is a child step, condition)."""
    out = []
    for one in selector.split(","):
        steps, child = [], False
        for word in re.sub(r"\s*>\s*", " > ", one.strip()).split():
            if word == ">":
                child = True
            else:
                steps.append((child, compound(word)))
                child = False
        if not steps or child:
            raise ValueError(f"selector not understood: {selector!r}")
        out.append(steps)
    return out


class Automaton:
    """Several selectors; ``accept[i]`` is the set of final steps of the i-th.

    A selector may be given as a pair (outer, inner): elements that match ``inner`` below
    one that matches ``outer``."""

    def __init__(self, selectors: list[str | tuple[str, str]]):
        self.accept: list[int] = []
        self.by_tag: dict[str | None, list[tuple[int, int, bool, Compound]]] = {}
        n = 0
        for sel in selectors:
            outer = [[]] if isinstance(sel, str) else chains(sel[0])
            inner = chains(sel if isinstance(sel, str) else sel[1])
            final = 0
            for steps in ([*a, *b] for a in outer for b in inner):
                for k, (child, cond) in enumerate(steps):
                    before = 1 << n - 1 if k else 0
                    self.by_tag.setdefault(cond.tag, []).append((1 << n, before, child, cond))
                    n += 1
                final |= 1 << n - 1
            self.accept.append(final)
        self.any_tag = self.by_tag.get(None, [])

    def step(self, tag: str, attrs: dict[str, str], own: int, above: int) -> int:
        """The steps that an element matches, given its parent's two sets."""
        got, classes = 0, set((attrs.get("class") or "").split())
        for bit, before, child, cond in (*self.by_tag.get(tag, ()), *self.any_tag):
            if (not before or (own if child else above) & before) and cond.fits(tag, attrs, classes):
                got |= bit
        return got


class Element:
    """An open element: its state and its place in the page."""

    __slots__ = ("tag", "own", "above", "begin", "inner", "number", "muted", "opened", "record")

    def __init__(self, tag, own, above, begin, inner, number, muted):
        self.tag, self.own, self.above, self.begin, self.inner = tag, own, above, begin, inner
        self.number, self.muted, self.opened, self.record = number, muted, [], None


class Walker(HTMLParser):
    """Runs an automaton over a page. Subclasses get ``opened(element, attrs)``,
    ``closed(element, end, inner_end)`` and ``string(text)``."""

    def __init__(self, automaton: Automaton):
        super().__init__(convert_charrefs=True)
        self.automaton = automaton
        self.stack: list[Element] = []
        self.open_tags: dict[str, int] = {}
        self.data: list[str] = []
        self.count = 0

    def walk(self, html: str) -> None:
        self.html = html
        self.lines = [0, *(m.end() for m in re.finditer("\n", html))]
        self.feed(html)
        self.close()
        self.flush()
        while self.stack:
            self.pop(len(html), len(html))

    def place(self) -> int:
        line, col = self.getpos()
        return self.lines[line - 1] + col

    def flush(self) -> None:
        """The text since the last tag or comment is one string; one of white space alone
        counts as one blank or line break."""
        if self.data:
            text, self.data = "".join(self.data), []
            if not text.strip(" \n\t\f\r") and not any(e.tag in KEEP_SPACE for e in self.stack):
                text = "\n" if "\n" in text else " "
            if text and not any(self.open_tags.get(t) for t in NO_TEXT):
                self.string(text)

    def pop(self, end: int, inner_end: int) -> None:
        e = self.stack.pop()
        self.open_tags[e.tag] -= 1
        self.closed(e, end, inner_end)

    def handle_starttag(self, tag, attrs):
        self.flush()
        attrs = {k: v or "" for k, v in reversed(attrs)}  # the first of a repeated attribute
        own, above, muted = (self.stack[-1].own, self.stack[-1].above, self.stack[-1].muted) if self.stack else (0, 0, 0)
        begin = self.place()
        inner = begin + len(self.get_starttag_text())
        got = self.automaton.step(tag, attrs, own, above)
        e = Element(tag, got, above | got, begin, inner, self.count, muted)
        self.count += 1
        self.stack.append(e)
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1
        self.opened(e, attrs)
        if tag in VOID:
            self.pop(inner, inner)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            e = self.stack[-1]
            self.pop(e.inner, e.inner)

    def handle_endtag(self, tag):
        self.flush()
        if not self.open_tags.get(tag):
            return
        begin = self.place()
        while self.stack[-1].tag != tag:
            self.pop(begin, begin)  # closed by an ancestor's end tag
        close = self.html.find(">", begin)
        self.pop(close + 1 if close >= 0 else len(self.html), begin)

    def handle_data(self, data):
        self.data.append(data)

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def opened(self, element, attrs): ...

    def closed(self, element, end, inner_end): ...

    def string(self, text): ...


# -- fields -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Field:
    """How a field is read from a page.

    The text is that of the ``index``-th match of ``select`` (of all, joined by ``join``, if
    ``index`` is None): its strings without those below a match of ``drop``, concatenated,
    or trimmed and joined by ``sep`` without empty ones. ``strip`` trims the whole. With
    ``attr`` it is that attribute, with ``words`` = (n, k) the k-th word of a text of
    exactly n words, with ``count`` the number of matches. No match (or no such attribute
    or word) is null."""

    select: str
    index: int | None = 0
    attr: str | None = None
    drop: tuple[str, ...] = ()
    sep: str | None = None
    strip: bool = False
    join: str = " "
    words: tuple[int, int] | None = None
    count: bool = False


class Record:
    """The matches found for one row (or one page): how many of each field, and texts."""

    __slots__ = ("seen", "found")

    def __init__(self, n: int):
        self.seen = [0] * n
        self.found: list[list[str | None]] = [[] for _ in range(n)]


class FieldReader(Walker):
    """Reads the fields of a rule set in one pass: once for the page or, with ``row``, for
    each element that matches it, from what is below that element."""

    def __init__(self, rules: dict[str, Field], automaton: Automaton, row: bool = False):
        super().__init__(automaton)
        self.rules, self.row = list(rules.values()), row
        # open rows, the innermost last; captures: record, field, place of the match, strings
        self.records = [] if row else [Record(len(rules))]
        self.done: list[Record] = []
        self.capturing: list[tuple[Record, int, int, list[str]]] = []

    @staticmethod
    def compiled(rules: dict[str, Field], row: str | None = None) -> Automaton:
        """First the fields' selectors, then their drops, then the row's."""
        select = [(row, f.select) if row else f.select for f in rules.values()]
        drops = [(f.select, d) for f in rules.values() for d in f.drop]
        return Automaton([*select, *drops, *([row] if row else [])])

    def opened(self, element, attrs):
        accept, drop = self.automaton.accept, len(self.rules)
        record = self.records[-1] if self.records else None
        for k, rule in enumerate(self.rules):
            if record and element.own & accept[k]:
                at, record.seen[k] = record.seen[k], record.seen[k] + 1
                if not rule.count and (rule.index is None or at == rule.index):
                    record.found[k].append(attrs.get(rule.attr) if rule.attr else None)
                    if not rule.attr:
                        element.opened.append((record, k, len(record.found[k]) - 1, []))
            for _ in rule.drop:
                if element.own & accept[drop]:
                    element.muted |= 1 << k
                drop += 1
        self.capturing += element.opened
        if self.row and element.own & accept[drop]:
            element.record = Record(len(self.rules))
            self.records.append(element.record)
            self.done.append(element.record)  # in the order of their start tags

    def string(self, text):
        muted = self.stack[-1].muted if self.stack else 0
        for _, k, _, strings in self.capturing:
            if not muted >> k & 1:
                strings.append(text)

    def closed(self, element, end, inner_end):
        if element.record:
            self.records.pop()
        for record, k, at, strings in element.opened:
            rule = self.rules[k]
            text = ("".join(strings) if rule.sep is None
                    else rule.sep.join(s for s in map(str.strip, strings) if s))
            record.found[k][at] = text.strip() if rule.strip else text
        if element.opened:
            self.capturing = [c for c in self.capturing if not any(c is o for o in element.opened)]

    def values(self, record: Record) -> list[str | None]:
        out = []
        for rule, seen, found in zip(self.rules, record.seen, record.found, strict=True):
            texts = [t for t in found if t is not None]
            if rule.words:
                n, k = rule.words
                texts = [w[k] for w in map(str.split, texts) if len(w) == n]
            out.append(str(seen) if rule.count else rule.join.join(texts) if texts else None)
        return out


def walked(walker: Walker, html: str | None) -> bool:
    """Whether the page could be read: it is not null and the tokenizer takes it."""
    if html is None:
        return False
    try:
        walker.walk(html)
    except AssertionError:  # malformed markup declaration
        return False
    return True


def read_fields(html: str | None, rules: dict[str, Field], automaton: Automaton | None = None) -> list[str | None] | None:
    """The fields of a page in the order of ``rules``; None for a page that cannot be read."""
    reader = FieldReader(rules, automaton or FieldReader.compiled(rules))
    return reader.values(reader.records[0]) if walked(reader, html) else None


def read_rows(html: str | None, row: str, rules: dict[str, Field],
              automaton: Automaton | None = None) -> list[list[str | None]]:
    """The fields of each match of ``row``, in page order; none for a page that cannot be
    read. A field below two nested rows belongs to the inner one."""
    reader = FieldReader(rules, automaton or FieldReader.compiled(rules, row), row=True)
    return [reader.values(r) for r in reader.done] if walked(reader, html) else []


# -- spans ------------------------------------------------------------------------------

class SpanReader(Walker):
    """The place of every element: number in the order of start tags, its parent's number,
    depth, tag, id, classes, begin, inner begin, inner end, end and whether it matches."""

    def __init__(self, automaton: Automaton):
        super().__init__(automaton)
        self.rows: list[list] = []

    def opened(self, element, attrs):
        parent = self.stack[-2].number if len(self.stack) > 1 else None
        hit = any(element.own & a for a in self.automaton.accept)
        self.rows.append([element.number, parent, len(self.stack) - 1, element.tag, attrs.get("id"),
                          (attrs.get("class") or "").split(), element.begin, element.inner, None, None, hit])

    def closed(self, element, end, inner_end):
        # a tag that the page's end cuts off has no inner part
        self.rows[element.number][8:10] = [max(inner_end, element.inner), max(end, element.inner)]


def element_spans(html: str | None, automaton: Automaton) -> list[list] | None:
    """Rows of ``SpanReader``; None for a page that cannot be read."""
    reader = SpanReader(automaton)
    return reader.rows if walked(reader, html) else None


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the union of ``spans``, which are sorted by their begin."""
    out, at = [], 0
    for begin, end in spans:
        if begin > at:
            out.append(text[at:begin])
        at = max(at, end)
    return "".join([*out, text[at:]])
