"""Generalised suffix automaton over words, for matching streams of words against a set of items."""

from __future__ import annotations

from collections.abc import Sequence


class ItemAutomaton:
    """Recognises windows: every run of ``width`` words of an item, and every whole item that is shorter.

    One automaton holds the substrings of all items. A stream of words is followed in it; the state and the longest
    matching length after each word tell whether a window ends there, and which items have it. States with a match of
    at least ``width`` words lead to the state of their last ``width`` words; a shorter item is found on the suffix
    links. All of this is computed once, when the items are known.
    """

    def __init__(self, items: dict[str, list[bytes]], width: int):
        self.width = width
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        names = sorted(items)
        coded = {n: [self.words.setdefault(w, len(self.words) + 1) for w in items[n]] for n in names}
        for n in names:
            last = 0
            for c in coded[n]:
                last = self._extend(last, c)
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        # The state that has the last ``width`` words of a longer match.
        self.window = [-1] * len(self.link)
        for v in order:
            if self.length[v] >= width:
                self.window[v] = self.window[self.link[v]] if self.length[self.link[v]] >= width else v
        self.items: dict[int, set[str]] = {}
        self.whole: dict[int, list[tuple[int, str]]] = {}
        for n in names:
            v = 0
            for i, c in enumerate(coded[n]):
                v = self.next[v][c]
                if i + 1 >= width:
                    self.items.setdefault(self.window[v], set()).add(n)
            if 0 < len(coded[n]) < width:
                self.whole.setdefault(v, []).append((len(coded[n]), n))
        # The nearest state on the suffix links, itself included, that is a whole short item.
        self.short = [-1] * len(self.link)
        for v in order:
            self.short[v] = v if v in self.whole else self.short[self.link[v]]
        lengths = [len(c) for c in coded.values() if c]
        self.least = min([width, *lengths]) if lengths else 0

    def _extend(self, last: int, c: int) -> int:
        """The state after ``last`` and one more word; a known continuation is shared with earlier items."""
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._split(last, c, q)
        new = len(link)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        """A state for the shorter substrings of ``q``."""
        nxt, link, length = self.next, self.link, self.length
        copy = len(link)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def follow(self, codes: Sequence[int], at: int, spans: list[tuple[int, int]], items: set[str]) -> None:
        """Add to ``spans`` the windows [from, to) that occur in ``codes``, whose first word is number ``at``."""
        nxt, link, length, window, short = self.next, self.link, self.length, self.window, self.short
        width = self.width
        v = matched = 0
        for i, c in enumerate(codes):
            while v and c not in nxt[v]:
                v = link[v]
                matched = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                matched += 1
            else:
                v = matched = 0
                continue
            end = at + i + 1
            if matched >= width:
                found = window[v] if length[v] >= width else -1
                if found != -1:
                    spans.append((end - width, end))
                    items |= self.items[found]
            s = short[v]
            if s == v and matched < length[v]:
                s = short[link[v]]
            while s > 0:
                for n, name in self.whole[s]:
                    spans.append((end - n, end))
                    items.add(name)
                s = short[link[s]]
