"""A bidirectional FM-index over a set of words, searched for many patterns at once in numpy.

Each word is a circle closed by a delimiter, so one row of the index stands for each
letter and one for each word. Rows are sorted by the letters up to the delimiter, then
by the word's rank; rows that begin with the delimiter are therefore the words
themselves, in order. The same is kept for the reversed words. A pattern's state is
(first row forwards, first row backwards, number of rows): the two intervals have the
same size, and lengthening the pattern on either side updates both.

Rows' preceding letters are stored as a wavelet matrix: one array of running counts
per bit of a letter's number.
"""

from __future__ import annotations

import numpy as np

DELIMITER = 0


class Wavelet:
    """Ranks of letters in a sequence of letter numbers below ``size``."""

    def __init__(self, letters: np.ndarray, size: int) -> None:
        self.bits = max(1, int(size - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        current = letters
        for bit in range(self.bits - 1, -1, -1):
            one = (current >> bit) & 1
            counts = np.zeros(len(current) + 1, dtype=np.int32)
            np.cumsum(one == 0, out=counts[1:])
            self.zeros.append(counts)
            current = np.concatenate((current[one == 0], current[one == 1]))
        totals = np.bincount(letters, minlength=size)
        self.before = np.concatenate(([0], np.cumsum(totals)[:-1]))
        # Where each letter's stretch begins after the last level, which orders letters by their reversed bits.
        self.bottom = np.zeros(size, dtype=np.int64)
        present = np.flatnonzero(totals)
        reversed_bits = [int(format(c, f"0{self.bits}b")[::-1], 2) for c in present]
        at = 0
        for c in present[np.argsort(reversed_bits)]:
            self.bottom[c] = at
            at += totals[c]

    def follow(self, low: np.ndarray, high: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of intervals, those of one letter each: first row after the step, size, and how many rows have smaller letters."""
        smaller = np.zeros(len(low), dtype=np.int64)
        for level, counts in enumerate(self.zeros):
            one = ((letter >> (self.bits - 1 - level)) & 1).astype(bool)
            zero_low, zero_high = counts[low], counts[high]
            smaller += np.where(one, zero_high - zero_low, 0)
            low = np.where(one, counts[-1] + low - zero_low, zero_low)
            high = np.where(one, counts[-1] + high - zero_high, zero_high)
        return self.before[letter] + low - self.bottom[letter], high - low, smaller

    def branch(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All letters that occur in intervals: the interval's number, the letter, then as :meth:`follow`."""
        which = np.arange(len(low))
        letter = np.zeros(len(low), dtype=np.int64)
        smaller = np.zeros(len(low), dtype=np.int64)
        for counts in self.zeros:
            zero_low, zero_high = counts[low], counts[high]
            one_low, one_high = counts[-1] + low - zero_low, counts[-1] + high - zero_high
            left, right = zero_high > zero_low, one_high > one_low
            smaller = np.concatenate((smaller[left], (smaller + (zero_high - zero_low))[right]))
            letter = np.concatenate((letter[left] * 2, letter[right] * 2 + 1))
            which = np.concatenate((which[left], which[right]))
            low = np.concatenate((zero_low[left], one_low[right]))
            high = np.concatenate((zero_high[left], one_high[right]))
        return which, letter, self.before[letter] + low - self.bottom[letter], high - low, smaller


def padded(words: list[str], numbers: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of letter numbers (0 behind the end; -1 for letters without a number), and their lengths."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    seen, inverse = np.unique(codes, return_inverse=True)
    values = np.array([numbers.get(chr(c), -1) for c in seen], dtype=np.int64)
    width = int(lengths.max(initial=0)) + 2
    rows = np.zeros((len(words), width), dtype=np.int64)
    rows[np.arange(width)[None, :] < lengths[:, None]] = values[inverse] if len(codes) else []
    return rows, lengths


class BidirectionalIndex:
    """Index of distinct words; numbers of words are their places in code-point order."""

    def __init__(self, words: list[str]) -> None:
        self.words = sorted(words)
        self.letters = {c: i + 1 for i, c in enumerate(sorted(set("".join(self.words))))}
        self.size = len(self.letters) + 1
        self._tables: dict[bool, Wavelet] = {}

    def table(self, forwards: bool) -> Wavelet:
        """Letters that precede the rows, of the words or of the reversed words; built when first needed."""
        if forwards not in self._tables:
            words = self.words if forwards else sorted(w[::-1] for w in self.words)
            self._tables[forwards] = Wavelet(self._preceding(words), self.size)
        return self._tables[forwards]

    def _preceding(self, words: list[str]) -> np.ndarray:
        """The letters in front of all rows, in row order."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        text = "\0".join(words) + "\0" if words else ""
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        seen, inverse = np.unique(codes, return_inverse=True)
        values = np.array([0 if c == 0 else self.letters[chr(c)] for c in seen], dtype=np.int64)
        letter = values[inverse] if len(codes) else np.zeros(0, dtype=np.int64)
        n = len(letter)
        word = np.repeat(np.arange(len(words)), lengths)
        end = np.cumsum(lengths)
        left = end[word] - np.arange(n)
        # Keys of as many letters as fit into 63 bits, then of twice as many, until the longest word is covered.
        wide = max(1, self.size.bit_length())
        first = 63 // wide
        key = np.zeros(n, dtype=np.int64)
        for k in range(first):
            shifted = np.zeros(n, dtype=np.int64)
            shifted[: n - k] = letter[k:] + 1 if k < n else 0
            key = (key << wide) | np.where(k < left, shifted, 0)
        rank = np.unique(key, return_inverse=True)[1] + 1
        step, longest = first, int(lengths.max(initial=0))
        while step < longest:
            behind = np.zeros(n, dtype=np.int64)
            behind[: n - step] = rank[step:]
            key = rank * (n + 2) + np.where(step < left, behind, 0)
            rank = np.unique(key, return_inverse=True)[1] + 1
            step *= 2
        order = np.lexsort((word, rank))
        before = np.arange(n) - 1
        begins = np.zeros(n, dtype=bool)
        begins[end - lengths] = True
        before = np.where(begins, end[word] - 1, before)
        return letter[before[order]]

    def start(self, count: int) -> np.ndarray:
        """States of ``count`` patterns that are the delimiter alone: one row per word."""
        states = np.zeros((3, count), dtype=np.int64)
        states[2] = len(self.words)
        return states

    def extend(self, states: np.ndarray, letter: np.ndarray, right: bool) -> np.ndarray:
        """States of the patterns with one letter more, to the right or to the left; size 0 where there is none."""
        near, far = (1, 0) if right else (0, 1)
        known = (letter >= 0) & (states[2] > 0)
        out = np.zeros_like(states)
        use = np.flatnonzero(known)
        low = states[near][use]
        row, size, smaller = self.table(not right).follow(low, low + states[2][use], letter[use])
        out[near, use], out[2, use] = row, size
        out[far, use] = states[far][use] + smaller
        return out

    def branch(self, states: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every way to add a letter: the number of the state, the letter (delimiter included), the new state."""
        near, far = (1, 0) if right else (0, 1)
        low = states[near]
        which, letter, row, size, smaller = self.table(not right).branch(low, low + states[2])
        out = np.empty((3, len(which)), dtype=np.int64)
        out[near], out[far], out[2] = row, states[far][which] + smaller, size
        return which, letter, out

    def one_error(self, patterns: list[str], right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(pattern number, word number) of all words one insertion, deletion or replacement away, each pair once.

        With ``right`` the first half (the shorter, of an odd length) of a pattern
        stands unchanged and the error is behind it; otherwise the second half
        stands unchanged and the error is in front of it. Patterns have two letters
        at least.
        """
        if not patterns or not self.words:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        letters, lengths = padded(patterns if right else [p[::-1] for p in patterns], self.letters)
        halves = lengths // 2 if right else lengths - lengths // 2
        states, alive = self.start(len(patterns)), np.arange(len(patterns))
        owners: list[np.ndarray] = []
        places: list[np.ndarray] = []
        for at in range(int(lengths.max()) + 1):
            # ``alive`` patterns have their first ``at`` letters matched without an error.
            free = at >= halves[alive]
            here, mine = states[:, free], alive[free]
            which, letter, wrong = self.branch(here, right)
            owner = mine[which]
            # Of several places in a run of one letter, an insertion or deletion counts at the last.
            inserted = (letter != DELIMITER) & (letter != letters[owner, at])
            replaced = inserted & (at < lengths[owner])
            dropped = at < lengths[mine]
            dropped[dropped] = letters[mine[dropped], at] != letters[mine[dropped], at + 1]
            owner, found = self._finish(
                letters,
                lengths,
                np.concatenate((owner[replaced], owner[inserted], mine[dropped])),
                np.concatenate((wrong[:, replaced], wrong[:, inserted], here[:, dropped]), axis=1),
                np.repeat((at + 1, at, at + 1), (replaced.sum(), inserted.sum(), dropped.sum())),
                right,
            )
            owners.append(owner)
            places.append(found)
            going = at < lengths[alive]
            alive, states = alive[going], states[:, going]
            states = self.extend(states, letters[alive, at], right)
            going = states[2] > 0
            alive, states = alive[going], states[:, going]
            if not len(alive):
                break
        return np.concatenate(owners), np.concatenate(places)

    def _finish(
        self, letters: np.ndarray, lengths: np.ndarray, owner: np.ndarray, states: np.ndarray, at: np.ndarray, right: bool
    ) -> tuple[np.ndarray, np.ndarray]:
        """Match each pattern's letters from ``at`` on and the delimiter behind them; the words that are left."""
        owners: list[np.ndarray] = [np.zeros(0, dtype=np.int64)]
        places: list[np.ndarray] = [np.zeros(0, dtype=np.int64)]
        while len(owner):
            states = self.extend(states, letters[owner, at], right)
            at = at + 1
            going = states[2] > 0
            owner, states, at = owner[going], states[:, going], at[going]
            done = at > lengths[owner]
            owners.append(owner[done])
            places.append(states[0][done])
            owner, states, at = owner[~done], states[:, ~done], at[~done]
        return np.concatenate(owners), np.concatenate(places)
