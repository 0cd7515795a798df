"""A trie over token sequences with failure links: finds all names of a dictionary in one walk over a text.

The last token of a name may go on in the text with digits ("rocket" is found in "rocket2"), so the trie holds the
sequences without their last token, and each node the last tokens that may follow there.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

Hit = tuple[int, int, int]  # (first token, number of tokens, choice)


class TokenAutomaton:
    """patterns: (id, choice, tokens). Of the sequences of one id the earliest in the text counts, then the smallest choice."""

    def __init__(self, patterns: Iterable[tuple[int, int, list[str]]]):
        self.next: list[dict[str, int]] = [{}]
        self.depth = [0]
        self.lasts: list[dict[str, list[tuple[int, int]]]] = [{}]
        for ident, choice, tokens in patterns:
            node = 0
            for token in tokens[:-1]:
                if token not in self.next[node]:
                    self.next[node][token] = len(self.next)
                    self.next.append({})
                    self.depth.append(self.depth[node] + 1)
                    self.lasts.append({})
                node = self.next[node][token]
            self.lasts[node].setdefault(tokens[-1], []).append((ident, choice))
        self._link()

    def _link(self) -> None:
        """fail: the longest proper suffix that is a node; ends: this node and those on its way to the root at which a name may end."""
        self.fail = [0] * len(self.next)
        self.ends: list[tuple[int, ...]] = [()] * len(self.next)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            self.ends[node] = ((node,) if self.lasts[node] else ()) + (self.ends[self.fail[node]] if node else ())
            for token, child in self.next[node].items():
                at = self.fail[node]
                while at and token not in self.next[at]:
                    at = self.fail[at]
                self.fail[child] = self.next[at].get(token, 0) if node else 0
                queue.append(child)

    def first_hits(self, tokens: list[str]) -> dict[int, Hit]:
        """id -> its first occurrence."""
        found: dict[int, Hit] = {}
        node = 0
        for i, token in enumerate(tokens):
            for end in self.ends[node]:
                bare = token
                while True:
                    for ident, choice in self.lasts[end].get(bare, ()):
                        depth = self.depth[end]
                        hit = (i - depth, depth + 1, choice)
                        if ident not in found or (hit[0], choice) < (found[ident][0], found[ident][2]):
                            found[ident] = hit
                    if not bare or bare[-1] not in "0123456789.":
                        break
                    bare = bare[:-1]
            while node and token not in self.next[node]:
                node = self.fail[node]
            node = self.next[node].get(token, 0)
        return found


def find(automaton: TokenAutomaton, text: str, token: re.Pattern[str], dropped: dict[int, None]) -> Iterator[tuple[int, str]]:
    """(id, matched tokens as written) of a text."""
    raw = token.findall(text)
    for ident, (i, n, _) in automaton.first_hits([w.lower().translate(dropped) for w in raw]).items():
        yield ident, " ".join(raw[i : i + n])
