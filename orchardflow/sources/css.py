"""HTML trees from the standard library's tokenizer, and CSS selectors over them.

Selectors: type, ``*``, ``#id``, ``.class``, ``[attr]``, ``[attr=v]`` and its ``~= |= ^= $= *=`` forms, ``:first-child``, ``:last-child``,
``:nth-child(n)``, ``:not(compound)``, descendant, ``>``, ``+``, ``~`` and comma.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SELF_ENDING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FENCES = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}


class Element:
    __slots__ = ("name", "attributes", "children", "parent")

    def __init__(self, name: str, attributes: dict[str, str], parent: Element | None) -> None:
        self.name, self.attributes, self.parent = name, attributes, parent
        self.children: list[Element | str] = []

    def elements(self) -> list[Element]:
        return [x for x in self.children if x.__class__ is Element]

    def walk(self) -> Iterator[Element]:
        """All elements below, in document order."""
        todo = self.elements()[::-1]
        while todo:
            item = todo.pop()
            yield item
            todo.extend(item.elements()[::-1])

    def text(self) -> str:
        """All text below, its pieces joined by spaces."""
        found, todo = [], list(reversed(self.children))
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                found.append(item)
            else:
                todo.extend(reversed(item.children))
        return " ".join(found)


class _Trees(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("", {}, None)
        self.at = self.root

    def updatepos(self, i: int, j: int) -> int:
        return j  # nobody asks for lines and columns

    def _close(self, names: tuple[str, ...], fences: tuple[str, ...]) -> None:
        node: Element | None = self.at
        while node is not None and node.parent is not None and node.name not in fences:
            if node.name in names:
                self.at = node.parent
                node = self.at
            else:
                node = node.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES_P:
            self._close(("p",), ("td", "th", "table", "button"))
        if tag in SELF_ENDING:
            self._close(SELF_ENDING[tag], FENCES[tag])
        found: dict[str, str] = {}
        for name, value in attrs:
            found.setdefault(name, value or "")
        node = Element(tag, found, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag: str) -> None:
        node: Element | None = self.at
        while node is not None and node.parent is not None:
            if node.name == tag:
                self.at = node.parent
                return
            if node.name in ("table", "td", "th") and tag not in ("table", "tr", "tbody"):
                return
            node = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(page: str | None) -> Element:
    trees = _Trees()
    trees.feed(page or "")
    trees.close()
    return trees.root


class SelectorError(ValueError):
    """The selector is not valid, or beyond what is supported."""


PART = re.compile(
    r"""(?P<type>\*|[a-zA-Z][\w-]*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)
    |\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~|^$*]?=)\s*(?:"(?P<q1>[^"]*)"|'(?P<q2>[^']*)'|(?P<bare>[\w./:#-]+)))?\s*\]
    |:(?P<pseudo>first-child|last-child)|:nth-child\(\s*(?P<nth>[0-9]+)\s*\)|:not\((?P<no>[^()]*)\)""",
    re.X,
)
COMBINATOR = re.compile(r"\s*([>+~])\s*|\s+")


class Selector:
    """A compiled selector."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.alternatives = [self._complex(x.strip()) for x in self._commas(source)]
        self._ends = [(_all(s[-1][1]), s if len(s) > 1 else None) for s in self.alternatives]

    @staticmethod
    def _commas(source: str) -> list[str]:
        return re.split(r""",(?=(?:[^"']|"[^"]*"|'[^']*')*$)(?![^\[]*\])(?![^(]*\))""", source)

    def _complex(self, text: str) -> list[tuple[str, list]]:
        """[(combinator, tests)] from left to right."""
        if not text:
            raise SelectorError(f"{self.source!r} is not a valid selector")
        at, steps, link = 0, [], " "
        while at < len(text):
            tests = []
            while (m := PART.match(text, at)) and m.end() > at and not (tests and m["type"]):
                tests.append(self._test(m))
                at = m.end()
            if not tests:
                raise SelectorError(f"{self.source!r} is not a valid selector, at {text[at:]!r}")
            steps.append((link, tests))
            if at < len(text):
                c = COMBINATOR.match(text, at)
                if not c or c.end() >= len(text):
                    raise SelectorError(f"{self.source!r} is not a valid selector, at {text[at:]!r}")
                link, at = c[1] or " ", c.end()
        return steps

    def _test(self, m: re.Match):
        if m["type"]:
            name = m["type"].lower()
            return (lambda e: True) if name == "*" else (lambda e: e.name == name)
        if m["id"]:
            return lambda e, v=m["id"]: e.attributes.get("id") == v
        if m["cls"]:
            return lambda e, v=m["cls"]: v in e.attributes.get("class", "").split()
        if m["attr"]:
            value = next((v for v in (m["q1"], m["q2"], m["bare"]) if v is not None), None)
            return lambda e, a=m["attr"].lower(), op=m["op"], v=value: a in e.attributes and (op is None or _compares(op, e.attributes[a], v))
        if m["no"] is not None:
            inner = self._complex(m["no"].strip())
            if len(inner) > 1:
                raise SelectorError(f"{self.source!r}: :not takes one compound")
            return lambda e: not all(t(e) for t in inner[0][1])
        nth = int(m["nth"]) if m["nth"] else 1
        last = m["pseudo"] == "last-child"

        def place(e: Element) -> bool:
            among = e.parent.elements() if e.parent else []
            return bool(among) and (among[-1] is e if last else len(among) >= nth and among[nth - 1] is e)

        return place

    def _fits(self, e: Element, steps: list, i: int) -> bool:
        return all(t(e) for t in steps[i][1]) and self._led(e, steps, i)

    def _led(self, e: Element, steps: list, i: int) -> bool:
        """Whether what the steps before ``i`` ask for stands where it must for ``e``, which fits step ``i``."""
        if i == 0:
            return True
        link = steps[i][0]
        if link == ">":
            return e.parent is not None and bool(e.parent.name) and self._fits(e.parent, steps, i - 1)
        if link in "+~":
            among = e.parent.elements() if e.parent else []
            place = next(k for k, x in enumerate(among) if x is e)
            before = among[max(0, place - 1) : place] if link == "+" else among[:place]
            return any(self._fits(x, steps, i - 1) for x in before)
        node = e.parent
        while node is not None and node.name:
            if self._fits(node, steps, i - 1):
                return True
            node = node.parent
        return False

    def matches(self, e: Element) -> bool:
        for fits, steps in self._ends:
            if fits(e) and (steps is None or self._led(e, steps, len(steps) - 1)):
                return True
        return False

    def all(self, root: Element) -> list[Element]:
        return [e for e in root.walk() if self.matches(e)]

    def first(self, root: Element) -> Element | None:
        return self.first_of(root.walk())

    def first_of(self, elements: Iterable[Element]) -> Element | None:
        """The first match among ``elements``, which are in document order."""
        for e in elements:
            if self.matches(e):
                return e
        return None


def _all(tests: list[Callable[[Element], bool]]) -> Callable[[Element], bool]:
    """The tests of a compound as one."""
    if len(tests) == 1:
        return tests[0]
    if len(tests) == 2:
        one, two = tests
        return lambda e: one(e) and two(e)
    return lambda e: all(t(e) for t in tests)


def _compares(op: str, have: str, want: str) -> bool:
    if op == "=":
        return have == want
    if op == "~=":
        return want in have.split()
    if op == "|=":
        return have == want or have.startswith(want + "-")
    if not want:
        return False
    return have.startswith(want) if op == "^=" else have.endswith(want) if op == "$=" else want in have
