"""Web pages as trees of block elements, and wrappers inferred from the trees of one host.

A page becomes a stream of block tags and texts; inline tags leave only their text. Closing
tags that are missing are supplied as browsers do for paragraphs and list items. A node is a
list ``[label, least, most, text, pages, kids]``:

    label   tag name with its class, id and role words, digits as 9; "#text" for a text; a
            "*a|b" node is a group of siblings that repeats as a whole
    least, most   how often the node occurs where it stands: 0..1 optional, 1..n repeated
    text    the text of a "#text" node that all pages share, or None for a slot
    pages   marks of up to ``EVIDENCE`` distinct pages that have the text (the least ones)
    kids    child nodes

Aligning a page with a wrapper turns differing texts into slots, siblings that occur on one
side only into optional nodes, and runs of equal siblings, or of equal sequences of siblings,
into repeated ones. Wrappers have no alternatives, so two of them align like a page and one.
"""

from __future__ import annotations

import html as _html
import json
import re
import zlib
from collections.abc import Generator

EVIDENCE = 5
GROUP_LENGTHS = (2, 3)

# Element names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr td th path g use picture source track".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "select", "title", "object", "canvas", "math")
SPACED = frozenset(("br", "td", "th", "img", "input", "wbr"))
CLOSED_BY_BLOCK = frozenset(("p",))
SELF_CLOSING = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"),
                "option": ("select",)}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(UNSEEN) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z|([^<]+|<)",
    re.S | re.I)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
SPACE = re.compile(r"\s+")
DIGITS = re.compile(r"\d+")


def _label(name: str, attributes: str) -> str:
    if not attributes:
        return name
    found = " ".join("".join(m) for m in NAMES.findall(attributes))
    return f"{name} {DIGITS.sub('9', found.lower())}".strip() if found else name


def page_tree(page: str) -> list:
    """The root node of a page."""
    root = ["", 1, 1, None, [], []]
    stack = [root]
    held: list[str] = []
    in_link = 0
    linked = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = SPACE.sub(" ", _html.unescape("".join(held))).strip()
            held.clear()
            if text:
                stack[-1][5].append(["#text", 1, 1, text, [linked], []])
            linked = 0

    for hidden, slash, name, attributes, text in TOKEN.findall(page):
        if text:
            held.append(text)
            if in_link:
                linked += len(text)
            continue
        if hidden or not name:
            continue
        name = name.lower()
        if name in INLINE or name == "br":
            if name == "a":
                in_link = 0 if slash else 1
            if name in SPACED:
                held.append(" ")
            continue
        flush()
        in_link = 0
        if slash:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0].split(" ", 1)[0] == name:
                    del stack[k:]
                    break
            continue
        while len(stack) > 1 and stack[-1][0].split(" ", 1)[0] in CLOSED_BY_BLOCK:
            stack.pop()
        if name in SELF_CLOSING:
            for k in range(len(stack) - 1, 0, -1):
                open_name = stack[k][0].split(" ", 1)[0]
                if open_name in SELF_CLOSING[name]:
                    break
                if open_name == name or (name in ("dt", "dd") and open_name in ("dt", "dd")):
                    del stack[k:]
                    break
        node = [_label(name, attributes), 1, 1, None, [], []]
        stack[-1][5].append(node)
        if name not in VOID and not attributes.endswith("/"):
            stack.append(node)
    flush()
    return root


def page_mark(page: str) -> int:
    return zlib.crc32(page.encode("utf-8", "surrogatepass"))


def _done(call: Generator):
    """The result of a recursive step written as a generator that yields its sub-steps: markup may nest
    deeper than Python's own calls may."""
    stack, value = [call], None
    while stack:
        try:
            call = stack[-1].send(value)
        except StopIteration as end:
            stack.pop()
            value = end.value
        else:
            stack.append(call)
            value = None
    return value


def as_wrapper(node: list, mark: int) -> list:
    """A wrapper that matches the page alone; runs of equal siblings are repeated nodes."""
    return _done(_as_wrapper(node, mark))


def _as_wrapper(node: list, mark: int) -> Generator:
    kids = []
    for k in node[5]:
        kids.append([*k[:4], [mark], []] if k[0] == "#text" else (yield _as_wrapper(k, mark)))
    return [node[0], 1, 1, node[3], [mark] if node[0] == "#text" else [], (yield _collapse(kids)) if kids else []]


def merge(a: list, b: list) -> list:
    """One node that matches what either matches, at the same place."""
    return _done(_merge(a, b))


def _joined(a: list, b: list, least: int, most: int) -> Generator:
    same = a[3] if a[3] == b[3] else None
    pages = sorted({*a[4], *b[4]})[:EVIDENCE] if same is not None else []
    return [a[0], least, most, same, pages, (yield _align(a[5], b[5])) if a[5] or b[5] else []]


def _merge(a: list, b: list) -> Generator:
    return _joined(a, b, min(a[1], b[1]), max(a[2], b[2]))


def _follow(a: list, b: list) -> Generator:
    """One node for two equal siblings that follow each other."""
    return _joined(a, b, a[1] + b[1], a[2] + b[2])


def _collapse(kids: list[list]) -> Generator:
    """Siblings with runs of equal labels, and of equal sequences of labels, as repeated nodes."""
    out: list[list] = []
    for kid in kids:
        if out and out[-1][0] == kid[0]:
            out[-1] = yield _follow(out[-1], kid)
        else:
            out.append(kid)
    for n in GROUP_LENGTHS:
        k = 0
        while k + 2 * n <= len(out):
            names = [x[0] for x in out[k:k + n]]
            times = 1
            while [x[0] for x in out[k + times * n:k + (times + 1) * n]] == names:
                times += 1
            if times > 1 and len(set(names)) > 1:
                group = out[k:k + n]
                for t in range(1, times):
                    for i, other in enumerate(out[k + t * n:k + (t + 1) * n]):
                        group[i] = yield _merge(group[i], other)
                out[k:k + times * n] = [["*" + "|".join(names), times, times, None, [], group]]
            k += 1
    return out


def _grouped(kids: list[list], groups: list[str]) -> list[list]:
    """Siblings with single occurrences of the other side's groups wrapped, so that they align."""
    for group in groups:
        names = group[1:].split("|")
        k = 0
        while k + len(names) <= len(kids):
            if [x[0] for x in kids[k:k + len(names)]] == names:
                kids = [*kids[:k], [group, 1, 1, None, [], kids[k:k + len(names)]], *kids[k + len(names):]]
            k += 1
    return kids


def _align(a: list[list], b: list[list]) -> Generator:
    """Two lists of siblings as one: the longest common sequence of labels is merged, the rest is optional."""
    out: list[list] = []
    if [x[0] for x in a] == [x[0] for x in b]:
        for x, y in zip(a, b):
            out.append((yield _merge(x, y)))
        return out
    a = _grouped(a, [x[0] for x in b if x[0][:1] == "*"])
    b = _grouped(b, [x[0] for x in a if x[0][:1] == "*"])
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(m - 1, -1, -1):
            row[j] = below[j + 1] + 1 if a[i][0] == b[j][0] else max(below[j], row[j + 1])
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append((yield _merge(a[i], b[j])))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], 0, *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], 0, *b[j][2:]])
            j += 1
    # Optional nodes may now stand beside an equal one.
    merged: list[list] = []
    for kid in out:
        if merged and merged[-1][0] == kid[0]:
            merged[-1] = yield _follow(merged[-1], kid)
        else:
            merged.append(kid)
    return merged


def to_json(wrapper: list) -> str:
    """Flat form: one entry per node in reading order, with the number of its kids in place of them."""
    flat, stack = [], [wrapper]
    while stack:
        node = stack.pop()
        flat.append([*node[:5], len(node[5])])
        stack += reversed(node[5])
    return json.dumps(flat, ensure_ascii=False)


def from_json(body: str) -> list:
    stack: list[list] = []
    for *node, n in reversed(json.loads(body)):
        stack.append([*node, [stack.pop() for _ in range(n)]])
    return stack[0]


def expression(node: list) -> str:
    """The wrapper as a regular expression over tags and texts, for people."""
    return _done(_expression(node))


def _expression(node: list) -> Generator:
    if node[0] == "#text":
        body = "#PCDATA" if node[3] is None else repr(node[3])
    else:
        parts = []
        for k in node[5]:
            parts.append((yield _expression(k)))
        inner = " ".join(parts)
        body = f"( {inner} )" if node[0][:1] == "*" else f"<{node[0]}> {inner} </>".replace("  ", " ") if node[0] else inner
    sign = {(True, False): "?", (False, True): "+", (True, True): "*"}.get((node[1] == 0, node[2] > 1), "")
    return f"({body}){sign}" if sign else body
