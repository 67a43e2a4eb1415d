"""A bidirectional FM-index over delimited words, and a search with one error, for many words at once.

The words stand in one text, ``$`` before, between and after them. Two indexes, of the text and of the text read
backwards, hold the last column of their sorted suffixes as one bit vector per letter, with counts every 64
places. A pattern's occurrences are an interval of suffix ranks: `extend_left` adds a letter in front by the first index,
`extend_right` one at the end by the second.

Search scheme for one error: a word's halves can't both be changed by it. One search matches ``$`` and the first half
exactly and goes on to the right over the second half and ``$``, allowing one error there; the other matches the second
half and ``$`` exactly and goes on to the left. All words of a call move in step, as arrays of intervals.
"""

from __future__ import annotations

import numpy as np

#: Words that are searched in step.
STEP = 8_000


def sorted_suffixes(codes: np.ndarray) -> np.ndarray:
    """Where the suffixes of ``codes`` begin, in order, by doubling the sorted length. The end is the smallest."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    length = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: max(n - length, 0)] = rank[length:]
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.ones(n, dtype=np.int64)
        new[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(new)
        if n == 0 or rank[order[-1]] == n:
            return order
        length *= 2


class _Half:
    """One direction: backward search over a text of codes 1 (the delimiter) to ``letters`` - 1 and an end mark 0."""

    def __init__(self, codes: np.ndarray, letters: int):
        codes = np.append(codes, 0)
        n = len(codes)
        self.order = sorted_suffixes(codes).astype(np.int32)
        last = codes[self.order - 1]
        blocks = n // 64 + 1
        # One letter more, that nothing has, stands for all that the text lacks.
        self.bits = np.zeros((letters + 1, blocks), dtype=np.uint64)
        self.before = np.zeros((letters + 1, blocks), dtype=np.int32)
        places = np.arange(n)
        bit = np.uint64(1) << (places & 63).astype(np.uint64)
        np.bitwise_or.at(self.bits, (last, places >> 6), bit)
        held = np.bitwise_count(self.bits).astype(np.int32)
        np.cumsum(held[:, :-1], axis=1, out=self.before[:, 1:])
        totals = np.bincount(codes, minlength=letters + 1)
        self.first = (np.cumsum(totals) - totals).astype(np.int32)

    def rank(self, letter: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``letter`` stands in the last column before ``place``."""
        block = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[letter, block] + np.bitwise_count(self.bits[letter, block] & mask)

    def extend(self, low: np.ndarray, high: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = self.first[letter]
        return start + self.rank(letter, low), start + self.rank(letter, high)


class _Asked:
    """Words to search for, in the codes of an index."""

    def __init__(self, words: list[str], letters: np.ndarray):
        points = np.frombuffer(f"${'$'.join(words)}$".encode("utf-32-le"), dtype=np.uint32)
        place = np.minimum(np.searchsorted(letters, points), len(letters) - 1)
        self.codes = np.where(letters[place] == points, place, len(letters)) + 1
        self.lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.begins = np.cumsum(self.lengths + 1) - self.lengths

    def letter(self, word: np.ndarray, step: np.ndarray, to_right: bool) -> np.ndarray:
        """The letter at a step from the pattern's end, where step 0 is the delimiter."""
        place = step - 1 if to_right else self.lengths[word] - step
        return self.codes[self.begins[word] + place]


class Index:
    """Distinct words of letters (any characters after ``$`` in code-point order), none empty."""

    def __init__(self, words: list[str]):
        points = np.frombuffer(f"${'$'.join(words)}$".encode("utf-32-le"), dtype=np.uint32)
        self.letters, codes = np.unique(points, return_inverse=True)
        # The delimiter is the smallest, the end mark is 0.
        codes, size = codes + 1, len(self.letters) + 1
        self.n = len(codes)
        self.begins = np.flatnonzero(codes[:-1] == 1) + 1
        self.forward, self.backward = _Half(codes, size), _Half(codes[::-1], size)

    def extend_left(self, low, high, letter):
        return self.forward.extend(low, high, letter)

    def extend_right(self, low, high, letter):
        return self.backward.extend(low, high, letter)

    def _word_at(self, low: np.ndarray, to_right: bool) -> np.ndarray:
        """The word whose whole pattern, with both delimiters, has the suffix rank ``low``."""
        if to_right:
            closing = self.n - 1 - self.backward.order[low]
            return np.searchsorted(self.begins, closing, "right") - 1
        return np.searchsorted(self.begins, self.forward.order[low], "right")

    def _search(self, asked: _Asked, to_right: bool) -> tuple[np.ndarray, np.ndarray]:
        """All within one error, which lies in the half that is read last."""
        extend = self.extend_right if to_right else self.extend_left
        lengths = asked.lengths
        exact = (lengths // 2 if to_right else lengths - lengths // 2) + 1
        choices = np.arange(2, len(self.letters) + 1)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        # States are word, next step, and interval; without an error so far, and with one.
        n = len(lengths)
        clean = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.n + 1)
        spoilt = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
        while len(clean[0]) or len(spoilt[0]):
            made = [spoilt]
            late = clean[1] >= exact[clean[0]]
            if late.any():
                states = tuple(x[late] for x in clean)
                inside = states[1] <= lengths[states[0]]
                # The other word lacks this letter.
                word, step, low, high = (x[inside] for x in states)
                made.append((word, step + 1, low, high))
                # It has one letter more, or another one here.
                letter = np.tile(choices, len(states[0]))
                word, step, low, high = (np.repeat(x, len(choices)) for x in states)
                low, high = extend(low, high, letter)
                there = low < high
                word, step, low, high, letter = (x[there] for x in (word, step, low, high, letter))
                made.append((word, step, low, high))
                other = (step <= lengths[word]) & (asked.letter(word, step, to_right) != letter)
                made.append((word[other], step[other] + 1, low[other], high[other]))
            word, step, low, high = clean
            low, high = extend(low, high, asked.letter(word, step, to_right))
            # A clean pattern that is complete is the word itself.
            on = (low < high) & (step <= lengths[word])
            clean = word[on], step[on] + 1, low[on], high[on]

            word, step, low, high = (np.concatenate(x) for x in zip(*made))
            low, high = extend(low, high, asked.letter(word, step, to_right))
            there = low < high
            done = there & (step > lengths[word])
            found.append((word[done], self._word_at(low[done], to_right)))
            on = there & ~done
            spoilt = word[on], step[on] + 1, low[on], high[on]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = (np.concatenate(x) for x in zip(*found))
        return a, b

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of one of ``words`` and an indexed one that differ by one inserted, deleted or replaced letter.

        Places in ``words`` and in the index; each pair comes once.
        """
        total = len(self.begins)
        pairs = [np.zeros(0, dtype=np.int64)]
        for begin in range(0, len(words) if total else 0, STEP):
            asked = _Asked(words[begin : begin + STEP], self.letters)
            for to_right in (True, False):
                a, b = self._search(asked, to_right)
                pairs.append((a + begin) * total + b)
        both = np.unique(np.concatenate(pairs))
        return both // max(total, 1), both % max(total, 1)
