"""Minimal acyclic acceptors of word sets, and their composition with a one-edit transducer.

The transducer T has two states. In the first it copies code points; by one inserted, deleted or
replaced code point it goes to the second, the accepting one, where it copies again. In A o T o A the
acceptor A is deterministic, so before the edit both sides are in one state, and after it in a pair of
states, of which only those matter from which both can still accept the same rest.

Words are numbered in their order: an arc carries how many words of its state come before it, and the
sum along a path is the number of the word it spells. Pairs are enumerated as pairs of numbers.
"""

from __future__ import annotations

from collections.abc import Sequence


class Acceptor:
    """The minimal acceptor of sorted, distinct words.

    ``arcs[s]`` holds (label, target, words before) of state ``s`` in order of labels; targets have
    smaller numbers than their sources, the initial state has the largest.
    """

    def __init__(self, words: Sequence[str]):
        self.arcs: list[tuple[tuple[str, int, int], ...]] = []
        self.final: list[bool] = []
        self.words: list[int] = []  # how many words a state accepts
        known: dict[tuple, int] = {}
        path: list[list] = [[False, []]]  # the states of the last word: final, arcs so far
        labels = ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                state = self._add(known, *path.pop())
                path[-1][1].append((labels[len(path) - 1], state))

        for word in words:
            shared = 0
            for a, b in zip(labels, word):
                if a != b:
                    break
                shared += 1
            close(shared)
            path.extend([False, []] for _ in range(len(word) - shared))
            path[-1][0] = True
            labels = word
        close(0)
        self.initial = self._add(known, *path.pop())

    def _add(self, known: dict[tuple, int], final: bool, arcs: list[tuple[str, int]]) -> int:
        key = (final, tuple(arcs))
        state = known.get(key)
        if state is None:
            state = known[key] = len(self.arcs)
            before, numbered = int(final), []
            for label, target in arcs:
                numbered.append((label, target, before))
                before += self.words[target]
            self.arcs.append(tuple(numbered))
            self.final.append(final)
            self.words.append(before)
        return state


class OneEdit:
    """A o T o A: pairs of accepted words that differ by exactly one edit."""

    def __init__(self, acceptor: Acceptor):
        self.acceptor = acceptor
        self.rests: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def rest(self, p: int, q: int) -> list[tuple[int, int]]:
        """Numbers, from ``p`` and from ``q``, of the words that both states accept."""
        found = self.rests.get((p, q))
        if found is not None:
            return found
        arcs, final, rests = self.acceptor.arcs, self.acceptor.final, self.rests
        todo = [(p, q)]
        while todo:
            pair = todo[-1]
            if pair in rests:
                todo.pop()
                continue
            a, b = pair
            if a == b:
                rests[pair] = [(k, k) for k in range(self.acceptor.words[a])]
                continue
            there = {label: (t, before) for label, t, before in arcs[b]}
            steps = [(t, before, *there[label]) for label, t, before in arcs[a] if label in there]
            missing = [(t, u) for t, _, u, _ in steps if (t, u) not in rests]
            if missing:
                todo += missing
                continue
            out = [(0, 0)] if final[a] and final[b] else []
            for t, i, u, j in steps:
                out += [(i + x, j + y) for x, y in rests[t, u]]
            rests[pair] = out
        return rests[p, q]

    def pairs(self) -> list[tuple[int, int]]:
        """Each pair once, as numbers of words; two ways to the same pair give it twice."""
        arcs = self.acceptor.arcs
        near: list[list[tuple[int, int]]] = []
        for state, steps in enumerate(arcs):
            out = []
            for at, (_, t, i) in enumerate(steps):
                out += [(i + x, i + y) for x, y in near[t]]  # copied
                out += [(i + x, y) for x, y in self.rest(t, state)]  # deleted, or inserted
                for _, u, j in steps[at + 1 :]:
                    out += [(i + x, j + y) for x, y in self.rest(t, u)]  # replaced
            near.append(out)
        return near[self.acceptor.initial]


def one_edit_pairs(words: Sequence[str]) -> set[tuple[int, int]]:
    """Index pairs, the shorter (or smaller) word first, of sorted distinct words one edit apart."""
    found = OneEdit(Acceptor(words)).pairs()
    return {(x, y) if (len(words[x]), x) < (len(words[y]), y) else (y, x) for x, y in found}
