"""A bidirectional FM-index of a sorted list of words, and its search scheme for one error.

The words stand in one cyclic text, each after a delimiter. A pattern is known
by the interval of its rotations among all sorted rotations, and at once by the
interval of its reversal among those of the reversed text; a wavelet matrix of
either Burrows-Wheeler transform extends it to the left or to the right, for
many patterns together.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np

DELIMITER = 0
FEW = 8
"""Intervals of so many words are not extended further; their words are compared."""
AT_ONCE = 2048
"""Patterns that are extended together."""


def sorted_rotations(text: np.ndarray) -> np.ndarray:
    """Starts of the rotations of a text in their order, by prefix doubling. No rotation may repeat."""
    n, bits = len(text), max(1, int(text.max()).bit_length())
    key, known = text.astype(np.int64), 1
    while 2 * known * bits <= 60:
        key = (key << (known * bits)) | np.roll(key, -known)
        known *= 2
    while True:
        values, rank = np.unique(key, return_inverse=True)
        if len(values) == n:
            return np.argsort(rank)
        key = rank.astype(np.int64) * n + np.roll(rank, -known)
        known *= 2


class Ranks:
    """A wavelet matrix: occurrences of a symbol, and of smaller ones, in any stretch of a sequence."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.zeros = []
        for level in reversed(range(bits)):
            one = (symbols >> level) & 1
            self.zeros.append(np.concatenate([[0], np.cumsum(1 - one)]).astype(np.int32))
            symbols = np.concatenate([symbols[one == 0], symbols[one == 1]])
        every = np.arange(1 << bits)
        self.first = np.zeros(1 << bits, np.int64)
        self.first = self.stretch(every, np.zeros_like(every), np.zeros_like(every))[0]

    def stretch(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences before ``low``, those from there to ``high``, and how many smaller symbols stand between them."""
        smaller = np.zeros(len(symbol), np.int64)
        for level, zeros in enumerate(self.zeros):
            one = ((symbol >> (len(self.zeros) - 1 - level)) & 1).astype(bool)
            a, b, all_zeros = zeros[low], zeros[high], zeros[-1]
            smaller += np.where(one, b - a, 0)
            low, high = np.where(one, all_zeros + low - a, a), np.where(one, all_zeros + high - b, b)
        return low - self.first[symbol], high - low, smaller


class Patterns:
    """Patterns in search: the query of each, where its interval begins in either order, and its width."""

    def __init__(self, query: np.ndarray, begin: np.ndarray, mirrored: np.ndarray, width: np.ndarray):
        self.query, self.begin, self.mirrored, self.width = query, begin, mirrored, width

    def __len__(self) -> int:
        return len(self.query)

    def where(self, mask: np.ndarray) -> Patterns:
        return Patterns(self.query[mask], self.begin[mask], self.mirrored[mask], self.width[mask])

    def joined(self, *others: Patterns) -> Patterns:
        every = (self, *others)
        names = ("query", "begin", "mirrored", "width")
        return Patterns(*[np.concatenate([getattr(p, n) for p in every]) for n in names])


class WordIndex:
    """The index of distinct words in code-point order."""

    def __init__(self, words: Sequence[str]):
        self.words = list(words)
        letters = sorted(set().union(*self.words))
        # One code more than there are letters stands for a letter that no word has.
        self.codes = defaultdict(lambda: len(letters) + 1, {c: i + 1 for i, c in enumerate(letters)})
        self.letters = np.arange(1, len(letters) + 1)
        bits = (len(letters) + 1).bit_length()
        text = np.array([x for w in self.words for x in (DELIMITER, *[self.codes[c] for c in w])], np.int64)
        counts = np.bincount(text, minlength=1 << bits)
        self.smaller = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.size = len(text)
        self.left, self.right = (
            Ranks(t[sorted_rotations(t) - 1], bits) for t in (text, text[::-1].copy())
        )

    def extended(self, patterns: Patterns, symbol: np.ndarray, to_left: bool) -> Patterns:
        """The patterns with one symbol more on a side."""
        ranks, own, other = (self.left, patterns.begin, patterns.mirrored) if to_left else (self.right, patterns.mirrored, patterns.begin)
        before, width, smaller = ranks.stretch(symbol, own, own + patterns.width)
        own, other = self.smaller[symbol] + before, other + smaller
        found = Patterns(patterns.query, *((own, other) if to_left else (other, own)), width)
        return found.where(width > 0)

    def near(self, queries: Sequence[str], exact: Sequence[int]) -> Iterator[tuple[int, int]]:
        """Pairs of a query and a word that differ by one insertion, deletion or replacement behind the exact part.

        Yields the number of the query and that of the word, each pair once;
        ``exact`` is the length of the part of each query that words begin with.
        """
        by_shape = defaultdict(list)
        for i, q in enumerate(queries):
            by_shape[len(q), exact[i]].append(i)
        for (length, part), members in by_shape.items():
            for k in range(0, len(members), AT_ONCE):
                some = members[k : k + AT_ONCE]
                codes = np.array([[self.codes[c] for c in queries[i]] for i in some], np.int64).reshape(len(some), length)
                for q, word, shared in self._candidates(codes, part):
                    if shared < 0 or one_edit(queries[some[q]], self.words[word], shared):
                        yield some[q], word

    def _candidates(self, codes: np.ndarray, part: int) -> Iterator[tuple[int, int, int]]:
        """Query, word, and the length of the beginning that they share if they still are to be compared, else -1."""
        n, length = codes.shape
        start = np.zeros(n, np.int64)
        pure = Patterns(np.arange(n), start, start, np.full(n, self.size, np.int64))
        # The exact half is matched from the middle to the delimiter, then extended across the other half.
        for j in reversed(range(part)):
            pure = self.extended(pure, codes[pure.query, j], to_left=True)
        pure = self.extended(pure, np.full(len(pure), DELIMITER), to_left=True)
        nothing = pure.where(np.zeros(len(pure), bool))
        edited = nothing
        for j in range(part, length + 1):
            few = pure.width <= FEW
            for q, begin, width in zip(pure.query[few].tolist(), pure.begin[few].tolist(), pure.width[few].tolist(), strict=True):
                for word in range(begin, begin + width):  # rotations that begin with a delimiter are the words in their order
                    yield q, word, j
            pure = pure.where(~few)
            if not len(pure) and not len(edited):
                return
            repeat = np.repeat(np.arange(len(pure)), len(self.letters))
            letter = np.tile(self.letters, len(pure))
            if j < length:
                other = letter != codes[pure.query[repeat], j]
                repeat, letter = repeat[other], letter[other]
            changed = self.extended(pure.where(repeat), letter, to_left=False)
            edited = edited.joined(changed)  # a letter inserted before this one
            if j == length:
                edited = self.extended(edited, np.full(len(edited), DELIMITER), to_left=False)
                for q, word in zip(edited.query.tolist(), edited.begin.tolist(), strict=True):
                    yield q, word, -1
                return
            edited = self.extended(edited, codes[edited.query, j], to_left=False)
            # Of a run of equal letters the last is deleted, as the first was matched on the way.
            last = np.full(len(pure), True) if j + 1 == length else codes[pure.query, j] != codes[pure.query, j + 1]
            edited = edited.joined(changed, pure.where(last))
            pure = self.extended(pure, codes[pure.query, j], to_left=False)


def one_edit(a: str, b: str, shared: int = 0) -> bool:
    """Whether two words that share their first letters differ by exactly one edit."""
    longer, shorter = (a, b) if len(a) >= len(b) else (b, a)
    if len(longer) - len(shorter) > 1:
        return False
    i = shared
    while i < len(shorter) and longer[i] == shorter[i]:
        i += 1
    if len(longer) == len(shorter):
        return i < len(shorter) and longer[i + 1 :] == shorter[i + 1 :]
    return longer[i + 1 :] == shorter[i:]
