"""Suffix automaton of sequences of numbers, and matching statistics against it."""

from __future__ import annotations

from collections.abc import Iterable


class SuffixAutomaton:
    """Recognises every run of the sequences it was built from; no run goes over their ends."""

    def __init__(self, sequences: Iterable[list[int]]):
        self.steps: list[dict[int, int]] = [{}]
        self.links, self.lengths = [-1], [0]
        for sequence in sequences:
            self._add(sequence)

    def _add(self, sequence: list[int]) -> None:
        steps, links, lengths = self.steps, self.links, self.lengths
        last = 0
        for symbol in sequence:
            after = steps[last].get(symbol)
            if after is not None:  # the run is known from an earlier sequence
                if lengths[after] == lengths[last] + 1:
                    last = after
                else:
                    last = self._split(last, symbol, after)
                continue
            new = len(steps)
            steps.append({})
            links.append(0)
            lengths.append(lengths[last] + 1)
            at = last
            while at >= 0 and symbol not in steps[at]:
                steps[at][symbol] = new
                at = links[at]
            if at >= 0:
                after = steps[at][symbol]
                links[new] = after if lengths[after] == lengths[at] + 1 else self._split(at, symbol, after)
            last = new

    def _split(self, at: int, symbol: int, after: int) -> int:
        steps, links, lengths = self.steps, self.links, self.lengths
        twin = len(steps)
        steps.append(steps[after].copy())
        links.append(links[after])
        lengths.append(lengths[at] + 1)
        while at >= 0 and steps[at].get(symbol) == after:
            steps[at][symbol] = twin
            at = links[at]
        links[after] = twin
        return twin

    def matches(self, sequence: list[int]) -> list[int]:
        """For each place the length of the longest run that ends there and is recognised."""
        steps, links, lengths = self.steps, self.links, self.lengths
        at = length = 0
        out = []
        for symbol in sequence:
            after = steps[at].get(symbol)
            while after is None and at:
                at = links[at]
                length = lengths[at]
                after = steps[at].get(symbol)
            if after is None:
                length = 0
            else:
                at = after
                length += 1
            out.append(length)
        return out
