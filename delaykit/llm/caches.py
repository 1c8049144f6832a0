"""A bounded memo for values computed per word."""

from __future__ import annotations

from collections.abc import Callable


class WordMemo(dict):
    """``memo[word]`` computes a word once and forgets what has gone unused.

    Two generations: when the young one is full it becomes the old one, and words
    still in use move back on their next sight. At most ``2 * size`` words are held;
    words longer than ``longest`` are computed each time.
    """

    def __init__(self, compute: Callable, size: int = 400_000, longest: int = 48):
        super().__init__()
        self.compute, self.size, self.longest, self.old = compute, size, longest, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
        if len(word) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value
