"""Word and byte n-gram features of many texts at once, as numpy over one buffer."""

from __future__ import annotations

import numpy as np

SEP = 32


def separators(digits_are_letters: bool) -> np.ndarray:
    """Table byte -> kept byte, or SEP for what stands between words (ASCII only)."""
    keep = np.full(256, SEP, np.uint8)
    for lo, hi in ((97, 122), (48, 57)) if digits_are_letters else ((97, 122),):
        keep[lo:hi + 1] = np.arange(lo, hi + 1)
    keep[128:] = np.arange(128, 256)
    return keep


class Words:
    """Words of a list of texts: runs of kept bytes of the lower-cased UTF-8 text.

    ``data`` is every word followed by one separator, with a separator in front, so
    an n-gram that includes one or both neighbours of a word marks its edges.
    ``doc_words`` is the number of words of each text.
    """

    def __init__(self, texts: list[str | None], keep: np.ndarray):
        raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        b = keep[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
        inside = b != SEP
        before = np.concatenate(([False], inside[:-1]))
        doc_end = np.cumsum(size + 1)  # past the joining separator
        starts = np.cumsum(inside & ~before)
        upto = starts[doc_end - 1] if len(raw) else np.empty(0, np.int64)
        self.doc_words = np.diff(np.concatenate(([0], upto)))
        self.data = np.concatenate((np.array([SEP], np.uint8), b[inside | before]))
        self.sep = self.data == SEP
        self.word = np.cumsum(self.sep) - 1  # of the bytes between separators
        self.n = int(self.sep.sum()) - 1

    @classmethod
    def each(cls, words: list[bytes]) -> "Words":
        """Words given one by one, as runs of kept bytes."""
        self = cls.__new__(cls)
        self.data = np.frombuffer(b" " + b"".join(w + b" " for w in words), np.uint8)
        self.sep = self.data == SEP
        self.word = np.cumsum(self.sep) - 1
        self.n = len(words)
        self.doc_words = np.ones(self.n, np.int64)
        return self

    def grams(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, word number) of every ``width``-gram that crosses no word edge inside;
        ascending by word."""
        d = self.data.astype(np.uint64)
        m = len(d) - width + 1
        if m <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        ok = np.ones(m, bool)
        for i in range(1, width - 1):
            ok &= ~self.sep[i:m + i]
        if width <= 2:
            ok &= ~(self.sep[:m] & self.sep[width - 1:])
        h = np.full(m, width, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(width):
                h = (h ^ d[i:m + i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
        # a two-gram that ends a word belongs to it, any other gram to its second byte's
        at = 1 if width > 2 else 0
        word = self.word[at:m + at]
        if width <= 2:
            word = np.where(self.sep[:m], self.word[width - 1:][:m], word)
        return h[ok], word[ok]


def windows(doc_words: np.ndarray, width: int, hop: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, past-the-last word, text number) of every window of every text with
    words; a text's last window may be shorter than ``width``."""
    count = np.where(doc_words > 0, np.maximum(1, -(-(doc_words - width + hop) // hop)), 0)
    doc = np.repeat(np.arange(len(doc_words)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    base = np.cumsum(doc_words) - doc_words
    first = base[doc] + nth * hop
    return first, np.minimum(first + width, base[doc] + doc_words[doc]), doc


class Numbers(dict):
    """Numbers words in the order they first come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def numbered(texts: list[str | None], keep: np.ndarray, number: Numbers
             ) -> tuple[np.ndarray, np.ndarray]:
    """(words of each text, number of every word in text order)."""
    words = Words(texts, keep)
    each = words.data.tobytes().split()
    return words.doc_words, np.fromiter(map(number.__getitem__, each), np.int32, len(each))
