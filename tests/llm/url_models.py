"""The URL filter's character model in arrays, for URLs in memory: the reference of the tests."""

from __future__ import annotations

import numpy as np

from alertfold.llm.url_filter import ALPHABET, ORDER, flatten

BUCKETS = 1 << 18


class Markov:
    """The same model in arrays, for URLs in memory: hashed counts of (context, character),
    contexts and their kinds of characters."""

    def __init__(self):
        self.pair = np.zeros((ORDER + 1, BUCKETS), np.float32)
        self.total = np.zeros((ORDER + 1, BUCKETS), np.float32)
        self.kinds = np.zeros((ORDER + 1, BUCKETS), np.float32)

    @staticmethod
    def keys(codes: np.ndarray, start: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Per character the hashes of its context of that length and of both together.  A
        context does not reach over the URL's start."""
        context = np.full(len(codes), order, np.uint64)
        at = np.arange(len(codes))
        for back in range(1, order + 1):
            there = at - back
            before = np.where(there >= start, codes[np.maximum(there, 0)], np.uint64(ALPHABET))
            context = (context * np.uint64(0x9E3779B97F4A7C15) + before + np.uint64(1))
            context ^= context >> np.uint64(29)
        both = (context ^ (codes + np.uint64(7)) * np.uint64(0xBF58476D1CE4E5B9)) * np.uint64(0x94D049BB133111EB)
        return context, both ^ (both >> np.uint64(31))

    def fit(self, urls: list[str]) -> Markov:
        codes, start, _ = flatten(urls)
        for order in range(ORDER + 1):
            context, both = self.keys(codes, start, order)
            self.pair[order] = np.bincount(both % np.uint64(BUCKETS), minlength=BUCKETS)
            self.total[order] = np.bincount(context % np.uint64(BUCKETS), minlength=BUCKETS)
            _, first = np.unique(both, return_index=True)
            self.kinds[order] = np.bincount(context[first] % np.uint64(BUCKETS), minlength=BUCKETS)
        return self

    def log_likelihood(self, codes: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Per character."""
        p = np.full(len(codes), 1.0 / ALPHABET)
        for order in range(ORDER + 1):
            context, both = self.keys(codes, start, order)
            at = (context % np.uint64(BUCKETS)).astype(np.int64)
            kinds = self.kinds[order][at]
            seen = self.total[order][at]
            count = np.minimum(self.pair[order][(both % np.uint64(BUCKETS)).astype(np.int64)], seen)
            p = np.where(seen > 0, (count + kinds * p) / np.maximum(seen + kinds, 1), p)
        return np.log(p)


def ratio(models: tuple[Markov, Markov], urls: list[str]) -> np.ndarray:
    """Difference of log-likelihoods per character; 0 for an empty URL."""
    codes, start, sizes = flatten(urls)
    diff = models[0].log_likelihood(codes, start) - models[1].log_likelihood(codes, start)
    owner = np.repeat(np.arange(len(urls)), sizes)
    return np.bincount(owner, diff, minlength=len(urls)) / np.maximum(sizes, 1)
