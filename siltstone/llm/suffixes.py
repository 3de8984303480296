"""Suffix automata over sequences of words."""

from __future__ import annotations


class SuffixAutomaton:
    """Automaton of all runs of words of some passages of one text, with the place where each run first ends.

    Passages are added in the order in which they stand in the text.
    """

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first_end = [-1]

    def _copy(self, state: int, word: int, parent: int) -> int:
        """Split off the shorter runs of ``state`` that end with ``word`` after ``parent``."""
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(nxt[state].copy())
        link.append(link[state])
        length.append(length[parent] + 1)
        self.first_end.append(self.first_end[state])
        link[state] = clone
        while parent >= 0 and nxt[parent].get(word) == state:
            nxt[parent][word] = clone
            parent = link[parent]
        return clone

    def add(self, words: list[int], start: int) -> None:
        """A passage whose first word is number ``start`` of the text."""
        nxt, link, length, first_end = self.next, self.link, self.length, self.first_end
        last = 0
        for place, word in enumerate(words, start + 1):
            known = nxt[last].get(word)
            if known is not None:
                last = known if length[known] == length[last] + 1 else self._copy(known, word, last)
                continue
            state = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            first_end.append(place)
            parent = last
            while parent >= 0 and word not in nxt[parent]:
                nxt[parent][word] = state
                parent = link[parent]
            if parent >= 0:
                known = nxt[parent][word]
                link[state] = known if length[known] == length[parent] + 1 else self._copy(known, word, parent)
            last = state

    def first_starts(self, words: list[int], window: int) -> list[int]:
        """For every window of ``words``: where its words first start in the text, or -1.

        The state follows the longest run that ends here, its matching statistic, cut to the state that holds the run of
        ``window`` words.
        """
        nxt, link, length, first_end = self.next, self.link, self.length, self.first_end
        state = run = 0
        out = []
        for i, word in enumerate(words, 1):
            to = nxt[state].get(word)
            while to is None and state:
                state = link[state]
                run = length[state]
                to = nxt[state].get(word)
            if to is not None:
                state = to
                run += 1
                if run >= window:
                    while length[link[state]] >= window:
                        state = link[state]
                        run = length[state]
            if i >= window:
                out.append(first_end[state] - window if run >= window else -1)
        return out
