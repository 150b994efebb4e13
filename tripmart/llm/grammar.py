"""Re-Pair grammars over arrays of token ids, in bulk rounds with numpy.

A round counts all adjacent pairs and replaces the frequent ones by nonterminals: of overlapping occurrences the one
with the more frequent pair goes first. Rounds go on until one saves too little. Pairs never reach over the end
of a document, so every document is a run of symbols of its own. A nonterminal's rule is the two
symbols it stands for; the lengths of the expansions tell in which symbol any token lies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: A pair must occur so often for a rule, and a round must save this share of the symbols for another one.
LEAST_COUNT = 8
LEAST_SAVING = 0.02
MOST_ROUNDS = 24
#: Pairs are counted in so many buckets; a table of that size stays in a core's cache.
BUCKET_BITS = 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Grammar:
    """``symbols`` from ``base`` on are rules, in order; a rule only uses symbols below its own.

    ``starts`` holds the first symbol of every document and the number of symbols, ``lengths`` the tokens of every rule.
    """

    base: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    starts: np.ndarray


def _chosen(symbols: np.ndarray, inner: np.ndarray, base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs to replace, none overlapping, and the number of each one's rule.

    Pairs are counted in hash buckets; of pairs that share one, one is served and the rest wait for the next round.
    """
    key = ((symbols[:-1] << 32) | symbols[1:]).view(np.uint64)
    bucket = ((key * _MULTIPLIER) >> np.uint64(64 - bits)).astype(np.int64)
    count = np.bincount(bucket, minlength=1 << bits)[bucket]
    # frequency decides, the bucket breaks ties, so that all occurrences of a pair compare alike
    weight = np.where(inner, (count << bits) | bucket, 0)
    wins = count >= LEAST_COUNT
    wins &= inner
    wins[1:] &= weight[1:] > weight[:-1]  # of a run of one pair the first
    wins[:-1] &= weight[:-1] >= weight[1:]
    at = np.flatnonzero(wins)
    owner = np.zeros(1 << bits, np.uint64)
    owner[bucket[at]] = key[at]
    at = at[owner[bucket[at]] == key[at]]
    times = np.bincount(bucket[at], minlength=1 << bits)
    ruled = times >= LEAST_COUNT
    at = at[ruled[bucket[at]]]
    number = np.cumsum(ruled) - 1
    return at, base + number[bucket[at]]


def compressed(ids: np.ndarray, ends: np.ndarray, base: int) -> Grammar:
    """The grammar of documents: ``ids`` below ``base``, one document after the other, and where each one ends."""
    symbols = ids.astype(np.int64)
    last = np.zeros(len(ids), bool)
    last[ends - 1] = True  # every document has its end token at least
    left, right, lengths, top = [], [], [], base
    bits = max(8, min(BUCKET_BITS, len(ids).bit_length()))
    for _ in range(MOST_ROUNDS):
        if len(symbols) < 2:
            break
        at, rule = _chosen(symbols, ~last[:-1], top, bits)
        if len(at) < max(1, LEAST_SAVING * len(symbols)):
            break
        new = int(rule.max()) + 1 - top
        pair = np.zeros((2, new), np.int64)
        pair[:, rule - top] = symbols[at], symbols[at + 1]
        known = np.concatenate((np.ones(base, np.int64), *lengths)) if lengths else np.ones(base, np.int64)
        left.append(pair[0])
        right.append(pair[1])
        lengths.append(known[pair[0]] + known[pair[1]])
        symbols[at] = rule
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, last, top = symbols[keep], last[keep], top + new
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right, lengths)]
    starts = np.concatenate(([0], np.flatnonzero(last) + 1))
    return Grammar(base, *joined, symbols, starts)


class Expander:
    """Decodes any symbols of a grammar: the expansion of every rule is laid out once."""

    def __init__(self, grammar: Grammar):
        g, base = grammar, grammar.base
        self.length = np.concatenate((np.ones(base, np.int64), g.lengths))
        self.at = np.concatenate((np.arange(base), base + np.cumsum(g.lengths) - g.lengths))
        self.flat = np.zeros(base + int(g.lengths.sum()), np.uint32)
        self.flat[:base] = np.arange(base, dtype=np.uint32)
        done = base
        while done < base + len(g.left):
            # the rules that use nothing but what is laid out already: at least the next one
            unknown = np.flatnonzero(np.maximum(g.left, g.right)[done - base :] >= done)
            upto = done + int(unknown[0]) if len(unknown) else base + len(g.left)
            rules = np.arange(done - base, upto - base)
            both = np.stack((g.left[rules], g.right[rules]), 1).ravel()
            start = self.at[done]
            filled = self(both)
            self.flat[start : start + len(filled)] = filled
            done = upto

    def __call__(self, symbols: np.ndarray) -> np.ndarray:
        size = self.length[symbols]
        ends = np.cumsum(size)
        shift = np.repeat(self.at[symbols] - ends + size, size)
        return self.flat[shift + np.arange(len(shift))]


def part(grammar: Grammar, expand: Expander, document: int, start: int, stop: int) -> np.ndarray:
    """Tokens ``start`` to ``stop`` of a document; only the symbols that hold them are expanded."""
    own = grammar.symbols[grammar.starts[document] : grammar.starts[document + 1]]
    ends = np.cumsum(expand.length[own])
    if not 0 <= start <= stop <= (int(ends[-1]) if len(ends) else 0):
        raise IndexError(f"document {document} has no tokens {start} to {stop}")
    if start == stop:
        return np.zeros(0, np.uint32)
    first, final = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
    before = int(ends[first] - expand.length[own[first]])
    return expand(own[first : final + 1])[start - before : stop - before]
