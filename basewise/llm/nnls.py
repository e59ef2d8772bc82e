"""How many sequences of which piece lengths to make: non-negative least squares on a histogram.

A pattern is a short list of lengths that fills a window exactly. How often each
pattern is used is found by least squares under the condition that no count is
negative: the histogram of lengths is to be used up. The unknowns are all patterns
of one to three lengths; they are never written out. Coordinate descent goes through
the lengths, takes for each the pattern of it that reduces the error most, and moves
that pattern's count to its exact minimum (not below zero); patterns in use are
revisited in each round. The least squares problem is convex, so this only ever
descends to the optimum. Everything here has the size of the window, not of the data.
"""

from __future__ import annotations

import numpy as np

ROUNDS = 60
# The descent ends when a round lowers the squared error by less than this share of it.
STILL = 1e-5


class Descent:
    """Counts of patterns that fit a histogram; ``left`` is the histogram minus what the counts use."""

    def __init__(self, histogram: np.ndarray) -> None:
        self.window = len(histogram)
        self.left = np.concatenate(([0.0], histogram.astype(float)))
        self.counts: dict[tuple[int, ...], float] = {}

    def move(self, pattern: tuple[int, ...]) -> None:
        """Set one pattern's count to where the squared error is least, zero at least."""
        slope = norm = 0.0
        for length in set(pattern):
            uses = pattern.count(length)
            slope += uses * self.left[length]
            norm += uses * uses
        old = self.counts.get(pattern, 0.0)
        new = max(0.0, old + slope / norm)
        if new != old:
            for length in pattern:
                self.left[length] -= new - old
            if new > 0:
                self.counts[pattern] = new
            else:
                del self.counts[pattern]

    def best_of(self, length: int) -> tuple[int, ...] | None:
        """The pattern with this length whose count should grow most, if any should."""
        rest = self.window - length
        if rest == 0:
            return (length,) if self.left[length] > 0 else None
        best, pattern = (self.left[length] + self.left[rest]) / (4 if length == rest else 2) ** 0.5, (length, rest)
        if rest > 1:
            # Pairs (a, rest - a): the reduction of the error is the squared slope over the squared norm.
            a = np.arange(1, rest // 2 + 1)
            b = rest - a
            gain = (self.left[length] + self.left[a] + self.left[b]) / np.sqrt(3.0 + 2.0 * ((a == b) * 1 + (a == length) + (b == length)))
            at = int(np.argmax(gain))
            if gain[at] > best:
                best, pattern = gain[at], (length, int(a[at]), int(b[at]))
        return tuple(sorted(pattern, reverse=True)) if best > 1e-9 else None

    def run(self, rounds: int = ROUNDS) -> None:
        """Descend until a round changes little."""
        error = float(self.left @ self.left)
        for _ in range(rounds):
            for length in range(self.window, 0, -1):
                if self.left[length] > 0:
                    pattern = self.best_of(length)
                    if pattern is not None:
                        self.move(pattern)
            for pattern in list(self.counts):
                self.move(pattern)
            before, error = error, float(self.left @ self.left)
            if before - error <= STILL * before:
                break


def fill_exactly(available: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Greedy patterns of any depth from ``available[length]`` pieces, longest lengths first.

    Each pattern takes the longest piece that still fits until the window is full;
    one that cannot be filled is given up together with its longest length. Changes
    ``available`` to what is left. Gives {length: uses} and how often it is repeated.
    """
    window, made = len(available) - 1, []
    given_up = np.zeros_like(available)
    while available.any():
        uses: dict[int, int] = {}
        gap = limit = window
        while gap > 0:
            fitting = np.flatnonzero(available[: min(gap, limit) + 1])
            if not len(fitting):
                break
            length = int(fitting[-1])
            uses[length] = int(min(available[length], gap // length))
            gap -= uses[length] * length
            limit = length - 1
        if gap == 0:
            repeats = int(min(available[length] // times for length, times in uses.items()))
            for length, times in uses.items():
                available[length] -= repeats * times
            made.append((uses, repeats))
        else:
            longest = next(iter(uses))
            given_up[longest], available[longest] = available[longest], 0
    available += given_up
    return made


def plan(histogram: np.ndarray) -> tuple[list[tuple[dict[int, int], int]], np.ndarray]:
    """Patterns and their repeats for ``histogram[length - 1]`` pieces, and how many pieces of each length no pattern takes.

    The least squares counts are rounded down, and used as far as pieces are there;
    what they leave is packed greedily. ``left[length]`` pieces stay.
    """
    descent = Descent(histogram)
    descent.run()
    available = np.concatenate(([0], histogram)).astype(np.int64)
    made: list[tuple[dict[int, int], int]] = []
    for pattern, count in sorted(descent.counts.items(), key=lambda c: (-c[1], c[0])):
        uses = {length: pattern.count(length) for length in pattern}
        repeats = int(min(int(count + 1e-6), *(available[length] // times for length, times in uses.items())))
        if repeats > 0:
            for length, times in uses.items():
                available[length] -= repeats * times
            made.append((uses, repeats))
    made += fill_exactly(available)
    return made, available
