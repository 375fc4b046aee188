"""Pages as trees of blocks, in arrays.

Block-level elements are nodes; the text between them, with its inline
elements, is a leaf.  Nodes are numbered in page order, so a subtree is a
stretch of numbers, and sums over subtrees are differences of running sums
over a whole batch of pages at once.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np

# Fixed values of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style title template noscript svg math iframe object canvas audio video".split())
CONTROLS = frozenset("input button select textarea option".split())
# A start tag ends the open elements of the first set, up to one of the second.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MARK = re.compile(r"[.,;:!?]")
# Numbers of a node, in the columns of ``Tree.counts``.
WORDS, CHARS, LINKED, MARKS, LEAF, ITEM, CONTROL, ELEMENT = range(8)


def attribute_tokens(attrs) -> set[str]:
    """Words of the class, id and role of an element, lower case."""
    return {t.lower() for k, v in attrs if k in ("class", "id", "role") and v for t in _TOKEN.findall(v)}


class Tree(HTMLParser):
    """One page; ``label`` holds what ``told(tag, attrs, above)`` says of each node."""

    def __init__(self, html: str, told=None):
        super().__init__(convert_charrefs=True)
        self.parent, self.end, self.depth, self.tokens, self.counts, self.label = [], [], [], [], [], []
        self.texts: dict[int, list[str]] = {}
        self._told = told
        self._open: list[tuple[str, int]] = []  # tag and node (-1: inline)
        self._many: dict[str, int] = {}
        self._block, self._leaf, self._links, self._hidden = -1, -1, 0, []
        self.feed(html)
        self.close()
        while self._open:
            self._pop()
        for leaf, parts in self.texts.items():
            text = "".join(t for t, _ in parts)
            words = text.split()
            self.texts[leaf] = " ".join(words)
            linked = sum(len(t.split()) for t, link in parts if link)
            self.counts[leaf][:4] = len(words), sum(map(len, words)), linked, len(_MARK.findall(text))

    def _node(self, tokens, label, **counts) -> int:
        at = len(self.parent)
        self.parent.append(self._block)
        self.depth.append(self.depth[self._block] + 1 if self._block >= 0 else 0)
        self.tokens.append(tokens)
        self.label.append(label)
        self.end.append(at + 1)
        row = [0] * 8
        for k, v in counts.items():
            row[globals()[k]] = v
        self.counts.append(row)
        return at

    def _pop(self) -> str:
        tag, node = self._open.pop()
        self._many[tag] -= 1
        if node >= 0:
            self.end[node] = len(self.parent)
            self._block, self._leaf = self.parent[node], -1
        elif tag == "a":
            self._links -= 1
        return tag

    def handle_starttag(self, tag, attrs):
        if tag in HIDDEN:
            self._hidden.append(tag)
        if self._hidden:
            return
        if tag in ("br", "wbr"):
            if tag == "br" and self._leaf >= 0:
                self.texts[self._leaf].append((" ", False))
            return
        if tag in INLINE:
            self._open.append((tag, -1))
            self._many[tag] = self._many.get(tag, 0) + 1
            self._links += tag == "a"
            return
        if tag in VOID and tag not in CONTROLS and tag != "hr":
            return
        ends, stops = IMPLIED_END.get(tag, ((), ()))
        found = next((i for i in range(len(self._open) - 1, -1, -1)
                      if self._open[i][0] in ends or self._open[i][0] in stops), -1) if ends else -1
        while found >= 0 and self._open[found][0] in ends:
            while len(self._open) > found:
                self._pop()
            found -= 1
        if self._many.get("p"):  # a block ends an open paragraph
            at = next(i for i in range(len(self._open) - 1, -1, -1) if self._open[i][1] >= 0)
            if self._open[at][0] == "p":
                while len(self._open) > at:
                    self._pop()
        label = self._told(tag, attrs, self.label[self._block] if self._block >= 0 else None) if self._told else None
        node = self._node(attribute_tokens(attrs) | {f"<{tag}>"}, label, ELEMENT=1, ITEM=int(tag in ("li", "option")),
                          CONTROL=int(tag in CONTROLS))
        self._leaf = -1
        if tag not in VOID:
            self._open.append((tag, node))
            self._many[tag] = self._many.get(tag, 0) + 1
            self._block = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in HIDDEN:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self._hidden:
            if tag == self._hidden[-1]:
                self._hidden.pop()
            return
        if not self._many.get(tag):
            return
        if tag in INLINE:
            for i in range(len(self._open) - 1, -1, -1):
                if self._open[i][1] >= 0:
                    return
                if self._open[i][0] == tag:
                    break
        while self._pop() != tag:
            pass

    def handle_data(self, data):
        if self._hidden or not data:
            return
        if self._leaf < 0:
            if data.isspace():
                return
            self._leaf = self._node({"<text>"}, self.label[self._block] if self._block >= 0 else None, LEAF=1)
            self.texts[self._leaf] = []
        self.texts[self._leaf].append((data, self._links > 0))

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)

    def handle_comment(self, data):
        pass


class Forest:
    """The trees of several pages, one after another, in arrays."""

    def __init__(self, trees: list[Tree]):
        sizes = np.array([len(t.parent) for t in trees], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        n = int(self.first[-1])
        shift = np.repeat(self.first[:-1], sizes)
        flat = lambda name: np.array([x for t in trees for x in getattr(t, name)], np.int64)
        self.parent = flat("parent")
        self.parent = np.where(self.parent < 0, -1, self.parent + shift)
        self.end, self.depth = flat("end") + shift, flat("depth")
        counts = np.array([x for t in trees for x in t.counts], np.float64).reshape(n, 8)
        self.tokens = [x for t in trees for x in t.tokens]
        self.running = np.concatenate([np.zeros((1, 8)), np.cumsum(counts, axis=0)])
        self.total = self.running[self.end] - self.running[:-1]  # of the subtree
        order = np.argsort(self.depth, kind="stable")
        self.levels = np.split(order, np.searchsorted(self.depth[order], np.arange(1, int(self.depth.max(initial=0)) + 1)))

    def __len__(self) -> int:
        return len(self.parent)

    def statistics(self) -> np.ndarray:
        """Numbers of each node: subtree density, place, depth and siblings."""
        n = len(self)
        page = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        total = self.total
        words, elements = total[:, WORDS], total[:, ELEMENT]
        all_words = (self.running[self.first[1:]] - self.running[self.first[:-1]])[page, WORDS]
        before = self.running[:-1][:, WORDS] - self.running[self.first[:-1]][page, WORDS]
        # siblings: children of one parent are in page order; the top nodes of a page are siblings
        family = np.where(self.parent < 0, -1 - page, self.parent)
        sort = np.argsort(family, kind="stable")
        new = np.ones(n, bool)
        new[1:] = family[sort[1:]] != family[sort[:-1]]
        group = np.cumsum(new) - 1
        at = np.arange(n) - np.flatnonzero(new)[group] if n else group
        count = np.bincount(group, minlength=1)[group] if n else group
        mean = (np.bincount(group, words[sort])[group] / count) if n else words
        last = np.append(new[1:], True)[:n]
        ahead = np.where(new, -1, np.roll(words[sort], 1)) if n else words
        behind = np.where(last, -1, np.roll(words[sort], -1)) if n else words
        place, many, sibling, prev, following = (np.empty(n) for _ in range(5))
        for target, value in ((place, at), (many, count), (sibling, mean), (prev, ahead), (following, behind)):
            target[sort] = value
        above = np.where(self.parent >= 0, self.parent, np.arange(n))
        link = total[:, LINKED] / np.maximum(words, 1)
        return np.column_stack([
            total[:, LEAF], np.log1p(words), total[:, CHARS] / np.maximum(words, 1), link, total[:, MARKS] / np.maximum(words, 1),
            words / (1 + elements), words / np.maximum(all_words, 1), words / np.maximum(words[above], 1),
            np.minimum(self.depth, 30), place / np.maximum(many, 1), np.log1p(many), np.log1p(sibling),
            np.log1p(np.maximum(prev, 0)) - (prev < 0), np.log1p(np.maximum(following, 0)) - (following < 0),
            before / np.maximum(all_words, 1), words / np.maximum(total[:, LEAF], 1), total[:, ITEM] / np.maximum(elements, 1),
            total[:, CONTROL], link[above], np.log1p(words[above]), elements == 0]) if n else np.zeros((0, 21))

    def token_scores(self, own: dict[str, float], above: dict[str, float]) -> np.ndarray:
        """Sum, smallest and largest score of a node's tokens (``own``), and of the
        tokens of its parent and of all nodes above it (``above``)."""
        n = len(self)

        def scored(score):
            out = np.zeros((n, 3))
            for i, tokens in enumerate(self.tokens):
                found = [score[t] for t in tokens if t in score]
                if found:
                    out[i] = sum(found), min(found), max(found)
            return out

        mine, given = scored(own), scored(above)
        path, parent = np.zeros((n, 3)), np.zeros((n, 3))
        for rows in self.levels[1:]:
            up = self.parent[rows]
            parent[rows] = given[up]
            path[rows, 0] = path[up, 0] + given[up, 0]
            path[rows, 1] = np.minimum(path[up, 1], given[up, 1])
            path[rows, 2] = np.maximum(path[up, 2], given[up, 2])
        return np.concatenate([mine, parent, path], axis=1)

    def decode(self, gain: np.ndarray) -> np.ndarray:
        """The best choice of nodes in which a chosen node's parent is chosen too.

        ``gain`` is what a chosen node adds.  A subtree that adds nothing in
        sum is left out as a whole, so no node is chosen below one that is not.
        """
        below, best = np.zeros(len(self)), np.zeros(len(self))
        for rows in reversed(self.levels):
            best[rows] = np.maximum(gain[rows] + below[rows], 0)
            up = self.parent[rows]
            np.add.at(below, up[up >= 0], best[rows][up >= 0])
        chosen = best > 0
        for rows in self.levels[1:]:
            chosen[rows] &= chosen[self.parent[rows]]
        return chosen
