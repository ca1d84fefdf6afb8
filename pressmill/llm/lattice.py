"""Marginal probability of words over all segmentations into pieces of an existing vocabulary.

A word is a first piece (which begins with the word mark), further pieces and a stop. Pieces keep
the vocabulary's order as a prior (weight falling with the rank that is their score) and are
re-estimated by expectation-maximisation; the forward recursion runs in log space over many words at once.
"""

import math

import numpy as np

from pressmill.llm.vocabulary import MARK

PRIOR = 1000.0  # pieces that the vocabulary's scores count for beside the corpus
LONGEST = 16
ALONE = 2048
_B, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SLOTS = 18
UNKNOWN = 1e-6  # weight of a character outside the vocabulary, spread over its bytes


STEPS = np.arange(1, LONGEST + 1)[:, None]


def _logsum(x):
    """Log of the sum of exponentials over the first axis."""
    top = x.max(axis=0)
    base = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return base + np.log(np.exp(x - base).sum(axis=0))


def _chain(weight):
    """The forward recursion over one long word, edge by edge: log sums at its size + 1 nodes."""
    length, begin = np.nonzero(weight > -np.inf)
    order = np.lexsort((length, begin))
    out = [-math.inf] * (weight.shape[1] + 1)
    out[0] = 0.0
    for a, b, w in zip(begin[order].tolist(), (begin + length + 1)[order].tolist(), weight[length, begin][order].tolist()):
        here, there = out[a] + w, out[b]
        if here > there:
            here, there = there, here
        if there > -math.inf:
            out[b] = there + math.log1p(math.exp(here - there))
    return out


class Lattice:
    def __init__(self, vocabulary, counts=None):
        pairs = [(p, s) for p, s in zip(vocabulary.pieces, vocabulary.scores) if p.strip(MARK) or p == MARK]
        self.pieces = [p for p, _ in pairs if len(p) <= LONGEST]
        scores = np.array([s for p, s in pairs if len(p) <= LONGEST])
        prior = 1 / (10 + np.minimum(-scores, 10 * len(scores)))
        self.first = np.array([p[0] == MARK for p in self.pieces])
        got = np.zeros(len(prior) + 1) if counts is None else counts  # the last counts the stops
        self.logp = np.empty(len(prior))
        start = prior * self.first / prior[self.first].sum() * PRIOR + got[:-1] * self.first
        later = prior * ~self.first / prior[~self.first].sum() * PRIOR * 3 + got[:-1] * ~self.first
        stop = PRIOR + got[-1]
        with np.errstate(divide="ignore"):
            self.logp = np.log(np.where(self.first, start / start.sum(), later / (later.sum() + stop)))
        self.stop = float(np.log(stop / (later.sum() + stop)))
        self.unknown = float(np.log(UNKNOWN * later.sum() / (later.sum() + stop)))
        # Two tables: the first piece of a slot, and the rest in order of hash.
        hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        slot = (hashes * _M) >> np.uint64(64 - _SLOTS)
        _, at = np.unique(slot, return_index=True)
        self.key, self.id = np.zeros(1 << _SLOTS, np.uint64), np.full(1 << _SLOTS, -1, np.int32)
        self.key[slot[at]], self.id[slot[at]] = hashes[at], at
        rest = np.setdiff1d(np.arange(len(hashes)), at)
        rest = rest[np.argsort(hashes[rest])]
        self.more_key, self.more_id = hashes[rest], rest.astype(np.int32)
        self.more = np.zeros(1 << _SLOTS, bool)
        self.more[slot[rest]] = True

    @staticmethod
    def _hash(piece):
        h = 0
        for ch in piece:
            h = (h * int(_B) + ord(ch) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _find(self, h):
        slot = (h * _M) >> np.uint64(64 - _SLOTS)
        found = np.where(self.key[slot] == h, self.id[slot], -1)
        if len(self.more_key):
            late = np.flatnonzero((found < 0) & self.more[slot])
            if len(late):
                k = np.minimum(np.searchsorted(self.more_key, h[late]), len(self.more_key) - 1)
                found[late] = np.where(self.more_key[k] == h[late], self.more_id[k], -1)
        return found

    def _edges(self, words):
        """Nodes and edges of the lattices of ``words`` (longest first): the first node of each word, its
        number of characters, and edge tables piece[l - 1, node] and weight[l - 1, node]."""
        text = "\n".join(MARK + w for w in words) + "\n"
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        end = np.flatnonzero(code == 10)
        start = np.r_[0, end[:-1] + 1]
        size = end - start
        piece = np.full((LONGEST, len(code)), -1, np.int32)
        at, h = np.flatnonzero(code != 10), np.zeros(len(code) - len(end), np.uint64)
        for n in range(LONGEST):
            alive = code[np.minimum(at + n, len(code) - 1)] != 10
            at, h = at[alive], h[alive]
            if not len(at):
                break
            h = h * _B + code[at + n] + np.uint64(1)
            piece[n, at] = self._find(h)
            at, h = at[at + n + 1 < len(code)], h[at + n + 1 < len(code)]
        weight = np.where(piece >= 0, self.logp[piece], -np.inf)
        begins = np.zeros(len(code), bool)
        begins[start] = True
        bare = (piece[0] < 0) & (code != 10) & ~begins
        width = 1 + (code[bare] > 0x7F) + (code[bare] > 0x7FF) + (code[bare] > 0xFFFF)
        weight[0, bare] = self.unknown - width * np.log(256)
        return start, size, piece, weight

    def _forward(self, start, size, weight):
        alpha = np.full(weight.shape[1], -np.inf)
        alpha[start] = 0.0
        long = int(np.searchsorted(-size, -ALONE, "left"))  # words of more characters go one by one
        for s, n in zip(start[:long].tolist(), size[:long].tolist()):
            alpha[s:s + n + 1] = _chain(weight[:, s:s + n])
        start, size = start[long:], size[long:]
        for e in range(1, int(size[0]) + 1 if len(size) else 0):
            node = start[: int(np.searchsorted(-size, -e, "right"))] + e
            step = STEPS[: min(e, LONGEST)]
            back = node - step
            alpha[node] = _logsum(alpha[back] + weight[step - 1, back])
        return alpha

    def _sorted(self, words):
        # A line feed can't be in a word, nor can the mark be told from a blank: it counts as unknown.
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        return order, [words[i].replace(MARK, "�") for i in order]

    def logprob(self, words):
        """Natural log of each word's marginal probability."""
        if not words:
            return np.zeros(0)
        order, ordered = self._sorted(words)
        start, size, _, weight = self._edges(ordered)
        alpha = self._forward(start, size, weight)
        out = np.empty(len(words))
        out[order] = alpha[start + size] + self.stop
        return out

    def expected(self, words, times):
        """Expected uses of every piece, and of the stop, over ``words`` counted ``times``."""
        order, ordered = self._sorted(words)
        start, size, piece, weight = self._edges(ordered)
        alpha = self._forward(start, size, weight)
        beta = np.full(weight.shape[1], -np.inf)
        last = start + size
        beta[last] = 0.0
        long = int(np.searchsorted(-size, -ALONE, "left"))
        for s, n in zip(start[:long].tolist(), size[:long].tolist()):
            turned = np.full((LONGEST, n), -np.inf)  # the same edges, read from the end
            for k in range(min(n, LONGEST)):
                turned[k, :n - k] = weight[k, s:s + n - k][::-1]
            beta[s:s + n + 1] = _chain(turned)[::-1]
        tails, sizes = last[long:], size[long:]
        for back in range(1, int(sizes[0]) + 1 if len(sizes) else 0):
            node = tails[: int(np.searchsorted(-sizes, -back, "right"))] - back
            step = STEPS[: min(back, LONGEST)]
            beta[node] = _logsum(weight[step - 1, node] + beta[node + step])
        whole = np.repeat(alpha[last], size + 1)  # by node, as the words follow each other
        count = np.repeat(np.asarray(times, float)[order], size + 1)
        out = np.zeros(len(self.pieces) + 1)
        for n in range(1, LONGEST + 1):
            at = np.flatnonzero(piece[n - 1] >= 0)
            at = at[at + n < len(beta)]
            use = np.exp(alpha[at] + weight[n - 1, at] + beta[at + n] - whole[at]) * count[at]
            out[:-1] += np.bincount(piece[n - 1, at], use, len(self.pieces))
        out[-1] = float(np.sum(times))
        return out
