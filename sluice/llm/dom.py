"""A small forgiving HTML tree and its collapsed form for alignment."""

from __future__ import annotations

import html
import re
from math import isqrt

import numpy as np

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template svg".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var wbr".split())
SCOPE = set("article aside body div footer form header html main nav section table td th".split())
ITEMS = set("blockquote dd dt li option p pre td th tr".split())      # kinds that come in rows
CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
                  "th": {"tr", "table"}, "option": {"select"}}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"<]*"|'[^'<]*'|[^>])*+)>|<[!?][^>]*>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TABLE_CELLS = 4096          # tables up to here are plain lists, larger ones arrays by rows


class Node:
    __slots__ = ("tag", "attributes", "children", "parent")

    def __init__(self, tag: str, attributes: dict, parent) -> None:
        self.tag, self.attributes, self.children, self.parent = tag, attributes, [], parent


def parse(source: str) -> Node:
    root = Node("#root", {}, None)
    here, at = root, 0
    for_end = {}
    while True:
        found = TAG.search(source, at)
        if found is None:
            break
        if found.start() > at:
            here.children.append(html.unescape(source[at:found.start()]))
        at = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if found[1]:
            node = here
            while node is not root and node.tag != name and not (
                    (name in INLINE or name == "p") and node.tag in SCOPE):
                node = node.parent
            if node is not root and node.tag == name:
                here = node.parent
            continue
        if name not in INLINE and name not in VOID:
            node = here             # a block ends an open paragraph
            while node is not root and node.tag not in SCOPE and node.tag != "p":
                node = node.parent
            if node.tag == "p":
                here = node.parent
        if name in CLOSED_BY_SAME or name in ("dt", "dd"):
            same = {"dt", "dd"} if name in ("dt", "dd") else {"td", "th"} if name in ("td", "th") else {name}
            node = here
            while node is not root and node.tag not in same and node.tag not in CLOSED_BY_SAME[name]:
                node = node.parent
            if node.tag in same:
                here = node.parent
        attributes = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(found[3])} if found[3] else {}
        node = Node(name, attributes, here)
        here.children.append(node)
        if name in RAW:
            if name not in for_end:
                for_end[name] = re.compile(rf"</{name}\b[^>]*>", re.I)
            end = for_end[name].search(source, at)
            at = end.end() if end else len(source)
        elif name not in VOID and not found[3].endswith("/"):
            here = node
    if at < len(source):
        here.children.append(html.unescape(source[at:]))
    return root


class Slot:
    """An element, or items in a row of one kind (tag and class) as one node."""

    __slots__ = ("kind", "nodes", "children", "number")

    def __init__(self, kind: str, nodes: list[Node]) -> None:
        self.kind, self.nodes, self.children, self.number = kind, nodes, [], 0


def kind(node: Node) -> str:
    label = node.attributes.get("class") or node.attributes.get("id") or ""
    return f"{node.tag}.{re.sub('[0-9]+', '0', ' '.join(sorted(label.split())))}" if label else node.tag


def collapse(root: Node) -> Slot:
    """The tree of slots; inline elements belong to the slot around them. Slots
    are numbered in preorder."""
    top = Slot("#root", [root])
    todo = [top]
    while todo:
        slot = todo.pop()
        inner = [c for n in slot.nodes for c in n.children if isinstance(c, Node) and c.tag not in INLINE and c.tag not in RAW]
        for child in inner:
            k = kind(child)
            if child.tag in ITEMS and slot.children and slot.children[-1].kind == k:
                slot.children[-1].nodes.append(child)
            else:
                slot.children.append(Slot(k, [child]))
        todo += slot.children
    number, todo = 0, [top]
    while todo:
        slot = todo.pop()
        slot.number, number = number, number + 1
        todo += reversed(slot.children)
    return top


def own_text(slot: Slot) -> str:
    """Text that stands in the slot itself, inline elements included."""
    parts = []
    for node in slot.nodes:
        todo = list(reversed(node.children))
        while todo:
            c = todo.pop()
            if isinstance(c, str):
                parts.append(c)
            elif c.tag in INLINE:
                todo += reversed(c.children)
        parts.append(" ")
    return " ".join("".join(parts).split())


class Shapes:
    """Trees ``(kinds, parents)`` in preorder, with one number for all subtrees
    of one shape, and the sizes of the best matchings of two shapes."""

    def __init__(self) -> None:
        self.number: dict[tuple, int] = {}
        self.shapes: list[tuple[int, tuple[int, ...], int]] = []      # kind, shapes of the children, nodes
        self.matched: dict[tuple[int, int], int] = {}

    def add(self, kinds: list, parents: list[int]) -> tuple[list[int], list[list[int]]]:
        """Shape and children of each node."""
        children: list[list[int]] = [[] for _ in kinds]
        for node, parent in enumerate(parents):
            if parent >= 0:
                children[parent].append(node)
        shape = [0] * len(kinds)
        for node in range(len(kinds) - 1, -1, -1):
            key = (kinds[node], tuple(shape[c] for c in children[node]))
            if key not in self.number:
                self.number[key] = len(self.shapes)
                self.shapes.append((*key, 1 + sum(self.shapes[c][2] for c in key[1])))
            shape[node] = self.number[key]
        return shape, children

    def middle(self, x, y) -> tuple[int, int, list[int], list[int]]:
        """Lengths of the equal heads and tails of two rows of shapes, and the
        places between them that can have a partner. Equal subtrees at an end
        are partners in some best matching: no other gives them more."""
        n = min(len(x), len(y))
        head = next((k for k in range(n) if x[k] != y[k]), n)
        tail = next((k for k in range(n - head) if x[-1 - k] != y[-1 - k]), n - head)
        i, j = range(head, len(x) - tail), range(head, len(y) - tail)
        kinds_x, kinds_y = {self.shapes[x[k]][0] for k in i}, {self.shapes[y[k]][0] for k in j}
        return (head, tail, [k for k in i if self.shapes[x[k]][0] in kinds_y],
                [k for k in j if self.shapes[y[k]][0] in kinds_x])

    def value(self, p: int, q: int) -> int:
        if p == q:
            return self.shapes[p][2]
        return self.matched[p, q] if self.shapes[p][0] == self.shapes[q][0] else 0

    def match(self, a: int, b: int) -> None:
        """Fills ``matched`` for two shapes of one kind and all that they need."""
        todo = [(a, b)]
        while todo:
            p, q = todo[-1]
            if p == q or (p, q) in self.matched:
                todo.pop()
                continue
            x, y = self.shapes[p][1], self.shapes[q][1]
            head, tail, i, j = self.middle(x, y)
            by_kind: dict = {}
            for shape in {y[k] for k in j}:
                by_kind.setdefault(self.shapes[shape][0], []).append(shape)
            missing = [(s, t) for s in {x[k] for k in i} for t in by_kind.get(self.shapes[s][0], ())
                       if s != t and (s, t) not in self.matched]
            if missing:
                todo += missing
                continue
            ends = sum(self.shapes[s][2] for s in x[:head]) + sum(self.shapes[s][2] for s in x[len(x) - tail:])
            inner = int(self.rows([x[k] for k in i], [y[k] for k in j])(len(i))[len(j)]) if i else 0
            self.matched[p, q] = 1 + ends + inner
            todo.pop()

    def rows(self, x: list[int], y: list[int]):
        """The table of best matchings of the first ``i`` with the first ``j``
        shapes, as a function that gives row ``i``. Large tables keep every
        root-of-n-th row and the block last asked for: memory is in proportion
        to ``len(y) * sqrt(len(x))``."""
        if len(x) * len(y) <= TABLE_CELLS:
            best = [[0] * (len(y) + 1)]
            for p in x:
                above, row, left = best[-1], [0], 0
                for j, q in enumerate(y):
                    left = max(left, above[j + 1], above[j] + self.value(p, q))
                    row.append(left)
                best.append(row)
            return best.__getitem__
        distinct, place = np.unique(np.array(y, np.int64), return_inverse=True)
        distinct = distinct.tolist()
        block = isqrt(len(x)) + 1

        def below(above, p):
            values = np.array([self.value(p, q) for q in distinct], np.int64)[place]
            row = np.zeros_like(above)
            np.maximum.accumulate(np.maximum(above[1:], above[:-1] + values), out=row[1:])
            return row

        row = np.zeros(len(y) + 1, np.int64)
        kept = {0: row}
        for i, p in enumerate(x, 1):
            row = below(row, p)
            if i % block == 0:
                kept[i] = row
        held: dict[int, np.ndarray] = {len(x): row}

        def get(i):
            if i not in held:
                first = i - i % block
                held.clear()
                held[first] = kept[first]
                for k in range(first, i):
                    held[k + 1] = below(held[k], x[k])
            return held[i]

        return get


def align(a: tuple[list, list[int]], b: tuple[list, list[int]]) -> list[tuple[int, int]]:
    """Pairs of nodes of a best simple tree matching of two trees ``(kinds,
    parents)``, given in preorder: roots pair if they are alike, children of
    paired nodes are matched in order so that most nodes pair up. Exact at
    every size and depth."""
    if a[0][0] != b[0][0]:
        return []
    known = Shapes()
    (shape_a, below_a), (shape_b, below_b) = known.add(*a), known.add(*b)
    known.match(shape_a[0], shape_b[0])
    pairs, todo = [], [(0, 0)]
    while todo:
        p, q = todo.pop()
        if shape_a[p] == shape_b[q]:        # equal subtrees: node by node
            pairs += [(p + k, q + k) for k in range(known.shapes[shape_a[p]][2])]
            continue
        pairs.append((p, q))
        x, y = below_a[p], below_b[q]
        of_x, of_y = [shape_a[c] for c in x], [shape_b[c] for c in y]
        head, tail, i, j = known.middle(of_x, of_y)
        todo += zip(x[:head], y[:head])
        todo += zip(x[len(x) - tail:], y[len(y) - tail:])
        row = known.rows([of_x[k] for k in i], [of_y[k] for k in j])
        m, n = len(i), len(j)
        while m and n:
            here = row(m)
            if here[n] == here[n - 1]:
                n -= 1
            elif here[n] == row(m - 1)[n]:
                m -= 1
            else:
                m, n = m - 1, n - 1
                todo.append((x[i[m]], y[j[n]]))
    return pairs
